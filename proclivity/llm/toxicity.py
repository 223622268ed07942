"""Toxicity by a fuzzy lexicon and its context.

The lexicon is learned from labelled rows: words, and stems that many words
share, which are much more frequent in documents labelled toxic. Levenshtein
automata run over the lexicon's trie, so misspelled terms are found too; the
product is made deterministic state by state, as texts ask for it. A window
of words around each hit tells abuse from quotation. A logistic regression
over the hits gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proclivity.llm.common import map_batches, schema, sole, staged

#: Labelled rows that the model is fitted on, at most (chosen by hash).
FIT_ROWS = 12_000
#: Terms are in so many toxic documents at least, are so much likelier there
#: (natural logarithm of the odds' ratio), and tell so much (G squared).
TOXIC_DOCS = 6
LOG_ODDS = 2.0
LEAST_G2 = 30.0
STEM_SIZES = (4, 5, 6, 7, 8)
#: A stem is a term if this many different words start with it.
STEM_WORDS = 4
#: Lengths from which a word may be misspelled by one and two edits; stems
#: only from LONG_STEM on, by one.
ONE_EDIT, TWO_EDITS, LONG_STEM = 5, 9, 8
WINDOW = 6
QUOTING = frozenset(
    "said says quote quoted quoting wrote called word term slur insult "
    "dit écrit appelé cité sagte nannte zitat schrieb dijo llamó cita".split()
)
MARKS = frozenset("\"'“”„«»‘’")

FEATURES = ("exact", "misspelled", "quoted", "density")
NONE = (9, 0.0)
LETTERS = re.compile(r"[^\W\d_]+")
MEMO = 500_000

TERMS = schema("term string, stem boolean, word string, toxic long, clean long")
BY_TERM = schema("term string, stem boolean, toxic long, clean long")
SCORED = schema(
    "doc_id long, held_out boolean, exact double, misspelled double,"
    "quoted double, density double"
)


class Term(NamedTuple):
    text: str
    stem: bool
    weight: float


class FuzzyTrie:
    """Trie of terms, met by the Levenshtein automata of all of them.

    A state is the set of (node, edits) a word's letters can have led to. How
    many edits a term allows depends on its length; a word may go on after a
    stem.
    """

    def __init__(self, terms: list[Term]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.edits: list[int] = [-1]  # edits allowed below a node
        self.ends: list[list[tuple[int, bool, float]]] = [[]]
        for term in terms:
            n = len(term.text)
            allowed = (n >= ONE_EDIT) + (n >= TWO_EDITS)
            if term.stem:
                allowed = int(n >= LONG_STEM)
            node = 0
            for letter in term.text:
                self.edits[node] = max(self.edits[node], allowed)
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.edits.append(-1)
                    self.ends.append([])
                node = self.children[node][letter]
            self.edits[node] = max(self.edits[node], allowed)
            self.ends[node].append((allowed, term.stem, term.weight))
        self.letters = {c for x in self.children for c in x}
        self.start = self._closed({(0, 0)})
        self.moves: dict[tuple[frozenset, str], frozenset] = {}

    def _closed(self, state: set[tuple[int, int]]) -> frozenset:
        """Adds what skipping letters of terms reaches; keeps least edits."""
        best: dict[int, int] = {}
        todo = list(state)
        while todo:
            node, used = todo.pop()
            if best.get(node, 9) <= used or used > self.edits[node]:
                continue
            best[node] = used
            todo += [(x, used + 1) for x in self.children[node].values()]
        return frozenset(best.items())

    def _step(self, state: frozenset, letter: str) -> frozenset:
        key = state, letter if letter in self.letters else ""
        known = self.moves.get(key)
        if known is None:
            out = set()
            for node, used in state:
                out.add((node, used + 1))
                for c, x in self.children[node].items():
                    out.add((x, used + (c != letter)))
            known = self._closed(out)
            if len(self.moves) > MEMO:
                self.moves.clear()
            self.moves[key] = known
        return known

    def match(self, word: str) -> tuple[int, float] | None:
        """Fewest edits to a term that allows them, and its weight."""
        state, best = self.start, NONE
        for letter in word:
            state = self._step(state, letter)
            if not state:
                break
            best = min(best, self._end(state, True))
        else:
            best = min(best, self._end(state, False))
        return None if best is NONE else (best[0], -best[1])

    def _end(self, state: frozenset, going_on: bool) -> tuple[int, float]:
        return min(
            (
                (used, -weight)
                for node, used in state
                for allowed, stem, weight in self.ends[node]
                if used <= allowed and (stem or not going_on)
            ),
            default=NONE,
        )


class Scanner:
    """Features of texts for a lexicon; keeps what words have matched."""

    def __init__(self, terms: list[Term]) -> None:
        self.trie = FuzzyTrie(terms)
        self.memo: dict[str, tuple[int, float] | None] = {}

    def hit(self, word: str) -> tuple[int, float] | None:
        """Edits and weight of the best match of a word's letters."""
        found = map(self.trie.match, LETTERS.findall(word.lower()))
        return min((x for x in found if x), default=None)

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        found = (text or "").split()
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        exact = misspelled = quoted = 0.0
        new = set(found).difference(memo)
        for word in new:
            memo[word] = self.hit(word)
        hits = [(i, x) for i, w in enumerate(found) if (x := memo[w])]
        for word in new:
            if len(word) > 64:
                del memo[word]
        for i, (edits, weight) in hits:
            if self.is_quoted(found, i):
                quoted += weight
            elif edits:
                misspelled += weight
            else:
                exact += weight
        return (
            math.log1p(exact),
            math.log1p(misspelled),
            math.log1p(quoted),
            exact / max(1, len(found)) ** 0.5,
        )

    @staticmethod
    def is_quoted(found: list[str], i: int) -> bool:
        """Inside quotation marks, or shortly after a word of reporting."""
        before = found[max(0, i - WINDOW) : i]
        after = found[i + 1 : i + 1 + WINDOW]
        opened = found[i][0] in MARKS or any(w[0] in MARKS for w in before)
        closed = any(
            w.rstrip(".,;:!?")[-1:] in MARKS for w in [found[i], *after]
        )
        return (opened and closed) or any(
            w.strip(".,;:!?").lower() in QUOTING for w in before[-2:]
        )


@lru_cache(maxsize=2)
def _scanner(terms: tuple[Term, ...]) -> Scanner:
    return Scanner(list(terms))


def held_out() -> Column:
    """Rows that nothing is learned from: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(
        F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)
    )


def fit_rows(
    docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS
) -> DataFrame:
    """At most `most` labelled texts to learn from: text, toxic.

    Held-out rows, null ids and null labels are left out; a document with
    several labels counts as toxic if one says so. The rows are the first by
    hashed id, so the sample doesn't depend on the order of files. Copies and
    near copies are one row: they share the smallest hash of their five-word
    shingles.
    """
    chosen = (
        labels.where(
            F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
        )
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    # at most `most` rows of two numbers: a size that doesn't follow the data
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")
    )

    def run(cols: dict[str, list]) -> dict[str, list]:
        return cols | {"_key": [smallest_shingle(x) for x in cols["text"]]}

    keyed = map_batches(
        rows.select("doc_id", "text", "toxic"),
        run,
        schema("doc_id long, text string, toxic int, _key long"),
    )
    first = keyed.groupBy("_key", "toxic").agg(F.min_by("text", "doc_id"))
    return first.toDF("_key", "toxic", "text").select("text", "toxic")


def smallest_shingle(text: str | None) -> int:
    found = (text or "").encode().split()
    least = min(
        xxhash.xxh64_intdigest(b" ".join(found[i : i + 5]))
        for i in range(max(1, len(found) - 4))
    )
    return least - (1 << 63)


def counts(
    cols: dict[str, list], key_of: Callable[..., tuple]
) -> dict[str, list]:
    """Toxic and clean documents in a batch for each key of words' terms."""
    count: dict[tuple, list[int]] = {}
    for text, toxic in zip(cols["text"], cols["toxic"], strict=True):
        seen = set()
        for word in set(LETTERS.findall((text or "").lower())):
            if len(word) >= min(STEM_SIZES):
                seen.add(key_of(word, False, word))
            for n in STEM_SIZES:
                if len(word) > n:
                    seen.add(key_of(word[:n], True, word))
        for key in seen:
            count.setdefault(key, [0, 0])[0 if toxic else 1] += 1
    names = ("term", "stem", "word")
    keys = list(zip(*count, strict=True)) or [[], []]
    return dict(zip(names, map(list, keys), strict=False)) | {
        "toxic": [v[0] for v in count.values()],
        "clean": [v[1] for v in count.values()],
    }


def learn_terms(rows: DataFrame) -> list[Term]:
    """Words and stems that tell toxic texts from the others."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        """Documents of each (term, word that has it)."""
        return counts(cols, lambda term, stem, word: (term, stem, word))

    def by_term(cols: dict[str, list]) -> dict[str, list]:
        """Documents of each term; one with two words of a stem counts once."""
        return counts(cols, lambda term, stem, word: (term, stem))

    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad or not good:
        return []
    by_word = map_batches(rows, run, TERMS)
    t, c = F.col("toxic"), F.col("clean")
    odds = F.log((t + 0.5) / (bad - t + 0.5)) - F.log(
        (c + 0.5) / (good - c + 0.5)
    )

    def part(seen: Column, of: int) -> Column:
        """Share of G squared of the documents of one label."""
        expected = F.lit(of / (bad + good)) * (t + c)
        without = F.lit(of / (bad + good)) * (bad + good - t - c)
        rest = F.lit(of) - seen
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(
            0.0
        ) + F.when(rest > 0, rest * F.log(rest / without)).otherwise(0.0)

    found = (
        by_word.groupBy("term", "stem", "word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .groupBy("term", "stem")
        .agg(F.count_if(t > 0).alias("words"))
    )
    counted = (
        map_batches(rows, by_term, BY_TERM)
        .groupBy("term", "stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((t >= TOXIC_DOCS) & (odds > LOG_ODDS))
        .withColumn("odds", odds)
        .withColumn("g2", 2 * (part(t, bad) + part(c, good)))
        .where(F.col("g2") >= LEAST_G2)
    )
    told = (
        counted.join(found, ["term", "stem"])
        .where(~F.col("stem") | (F.col("words") >= STEM_WORDS))
        .orderBy(F.desc("g2"), "stem", "term")
        .collect()  # no more than what FIT_ROWS texts can hold
    )
    out: list[Term] = []
    for row in told:
        # what tells most stands for all terms that start with it or that it
        # starts with
        if not any(
            (x.stem and row["term"].startswith(x.text))
            or (row["stem"] and x.text.startswith(row["term"]))
            for x in out
        ):
            out.append(Term(row["term"], row["stem"], row["odds"]))
    return out


def features(
    docs: DataFrame, terms: list[Term], carry: bool = False
) -> DataFrame:
    """doc_id, held_out and the features of each document; `carry` adds its
    row as the struct _row."""
    lexicon = tuple(terms)

    def run(cols: dict[str, list]) -> dict[str, list]:
        scanner = sole(_scanner, lexicon)
        rows = [scanner.features(x) for x in cols["text"]]
        columns = list(zip(*rows, strict=True)) or [[] for _ in FEATURES]
        return {k: cols[k] for k in ("doc_id", "held_out")} | dict(
            zip(FEATURES, map(list, columns), strict=True)
        )

    rows = docs.select(
        F.col("doc_id").cast("long"),
        "text",
        held_out().alias("held_out"),
        *([F.struct(*docs.columns).alias("_row")] if carry else []),
    )
    return map_batches(rows, run, SCORED, "_row" if carry else None)


class Model(NamedTuple):
    terms: list[Term]
    weights: list[float]
    intercept: float


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Model:
    """Learn the lexicon and the weights; both kinds of label must occur."""
    rows = staged(fit_rows(docs, labels, most), "labelled")
    terms = learn_terms(rows)
    if not terms:
        return Model([], [0.0] * len(FEATURES), -30.0)
    scanner_terms = tuple(terms)

    def run(cols: dict[str, list]) -> dict[str, list]:
        scanner = sole(_scanner, scanner_terms)
        rows = [scanner.features(x) for x in cols["text"]]
        columns = list(zip(*rows, strict=True)) or [[] for _ in FEATURES]
        return {"label": cols["toxic"]} | dict(
            zip(FEATURES, map(list, columns), strict=True)
        )

    fields = ", ".join(f"{f} double" for f in FEATURES)
    measured = map_batches(rows, run, schema(f"label int, {fields}"))
    fitted = LogisticRegression(
        regParam=1e-4, standardization=False, maxIter=100
    ).fit(
        measured.select(
            F.col("label").cast("double").alias("label"),
            array_to_vector(F.array(*FEATURES)).alias("features"),
        )
    )
    return Model(terms, list(map(float, fitted.coefficients)), fitted.intercept)


def probability(model: Model) -> Column:
    """The model's score of a row of features."""
    margin = F.lit(model.intercept)
    for name, weight in zip(FEATURES, model.weights, strict=True):
        margin = margin + F.lit(weight) * F.col(name)
    return 1.0 / (1.0 + F.exp(-margin))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted.

    Only the text decides the score. A null or empty text has no hits, and
    so the score of a text without hits; a null doc_id stays null and counts
    as not held out; repeated rows stay; other columns are ignored.
    """
    value = probability(model)
    return features(docs, model.terms).select(
        "doc_id",
        "held_out",
        value.alias("score"),
        (value >= 0.5).cast("int").alias("predicted"),
        *FEATURES,
    )


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on labelled rows that are not held out, and score every row.

    Without labels of both kinds nothing is learned and every score is
    near 0.
    """
    return score(docs, fit(docs, labels))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` with a score below 0.5, with their own columns."""
    model = fit(docs, labels)
    scored = features(docs, model.terms, carry=True)
    return scored.where(probability(model) < 0.5).select("_row.*")
