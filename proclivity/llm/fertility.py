"""Quality by tokeniser fertility.

Public vocabularies encode the words of a text. Characters per token, the
share of tokens that fall back to single bytes, and the entropy of the tokens
tell prose in a known language from shouting, symbol soup and noise. The band
that is accepted for each measure is learned for each language over all its
documents, wider the fewer they are; a document outside one of its language's
bands is rejected.
"""

from __future__ import annotations

import base64
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proclivity.llm.common import map_batches, schema, sole, staged, words
from proclivity.llm.runs import Runs, cut_at

SYMBOLS = "#*$%&|<>"
#: White space between words.
BLANKS = "\t\n\v\f\r "
#: Texts whose words are looked up together.
TOGETHER = 256
MEMO_BYTES = 96 << 20
#: How many interquartile ranges beyond the quartiles a band reaches.
REACH = {
    "chars_per_token": 4.0,
    "multi_chars_per_token": 3.0,
    "entropy_share": 4.0,
    "byte_share": 4.0,
}
#: Added to every reach, so that a language of near-equal documents does not
#: reject honest ones.
LEAST = {"byte_share": 0.05}
LEAST_ELSE = 0.02
#: Measures of shorter documents scatter more: bands widen with the square
#: root of this many words over the document's.
STEADY_WORDS = 200
#: Quartiles of few documents are uncertain. At n documents a reach grows by
#: this many times itself over sqrt(n), and by this many times the measure's
#: scale (its median, or 1 for a share near 0) over n: bands of a few documents
#: accept nearly all, those of thousands are hardly wider.
UNSURE = 2.0
MIN_WORDS = 50

BASE = (
    "doc_id long, n_words long, word_chars long, n_symbols long,"
    "n_dup_lines long, n_repeat_words long"
)
MEASURES = tuple(REACH)
MEASURED = schema(
    BASE
    + ", _group string, chars_per_token double, entropy_share double,"
    "byte_share double, multi_chars_per_token double"
)


def repeat_words(numbers: np.ndarray) -> int:
    """Words in windows of three that occur twice or more, of a text given by
    equal numbers for equal words."""
    n = len(numbers)
    if n < 3:
        return 0
    kinds, seq = np.unique(numbers, return_inverse=True)
    # exact: a pair of word numbers is numbered again before the third
    pair = seq[:-1] * len(kinds) + seq[1:]
    if len(kinds) > 1_000_000:
        pair = np.unique(pair, return_inverse=True)[1]
    three = pair[:-1] * len(kinds) + seq[2:]
    order = np.argsort(three)
    ranked = three[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def plain_counts(text: str) -> tuple[int, int, int]:
    """word_chars, n_symbols, n_dup_lines."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
    )


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = words(text)
    ids: dict[bytes, int] = {}
    seq = [ids.setdefault(w, len(ids)) for w in found]
    return (
        len(found),
        *plain_counts(text or ""),
        repeat_words(np.array(seq, np.int64)),
    )


class Fertility:
    """Tokens of single words by two vocabularies, with a bounded memo."""

    def __init__(self, piece_model: str, rank_file: str, pattern: str) -> None:
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(
            model_file=piece_model
        )
        n = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(n)])
        with open(rank_file, "rb") as lines:
            ranks = {
                base64.b64decode(a): int(b)
                for a, b in (x.split() for x in lines if x.strip())
            }
        self.ranks = tiktoken.Encoding(
            "ranks",
            pat_str=pattern,
            mergeable_ranks=ranks,
            special_tokens={},
        )
        self.size_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.size_of[rank] = len(token)
        self.runs = Runs(self._runs_of, MEMO_BYTES)

    def _runs_of(
        self, found: list[bytes]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of each word, and its number of tokens by the ranks."""
        texts = [w.decode() for w in found]
        ids = self.pieces.encode(texts, num_threads=1)
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(
            chain.from_iterable(ids), np.uint32, int(length.sum())
        )
        return flat, length, self._rank_counts(found, texts)

    def _rank_counts(self, found: list[bytes], texts: list[str]) -> np.ndarray:
        """Tokens of each word after a space.

        The pattern starts a match at a space before a character that is no
        white space, so words without any are encoded as one text, cheaper
        than one by one, and its tokens are cut where the words end.
        """
        joined = " ".join(texts)
        if len(joined.split()) != len(texts):  # white space beyond ASCII
            return np.array(
                [len(self.ranks.encode_ordinary(f" {t}")) for t in texts],
                np.int64,
            )
        ids = np.array(self.ranks.encode_ordinary(f" {joined}"), np.int64)
        ends = np.cumsum([len(w) + 1 for w in found])
        return np.diff(cut_at(self.size_of[ids], ends), prepend=0)

    def measure(self, numbers: np.ndarray, chars: int) -> tuple:
        """chars_per_token, entropy_share, byte_share, and characters per
        token of the second vocabulary, of a text's words as `runs` numbers
        them; nulls for a text without words."""
        ids = self.runs.run(numbers)
        n = len(ids)
        if not n:
            return None, None, None, None
        count = np.unique(ids, return_counts=True)[1]
        share = count / n
        entropy = float(-(share * np.log2(share)).sum())
        second = int(self.runs.weight[numbers].sum())
        return (
            chars / n,
            entropy / np.log2(n + 1),
            float(self.is_byte[ids].sum() / n),
            chars / max(1, second),
        )

    def rows(self, texts: list[str | None]) -> list[tuple]:
        """Base counts and measures of each text."""
        out = []
        numbered = self.runs.numbers([words(x) for x in texts])
        for text, numbers in zip(texts, numbered, strict=True):
            counts = plain_counts(text or "")
            out.append(
                (
                    (len(numbers), *counts, repeat_words(numbers)),
                    self.measure(numbers, counts[0]),
                )
            )
        return out


@lru_cache(maxsize=1)
def _load(*paths: str) -> Fertility:
    return Fertility(*paths)


def script_of(text: str) -> str:
    """Script of most of the letters, by the first word of their names."""
    count: dict[str, int] = {}
    for c in set(text):
        if c.isalpha():
            name = unicodedata.name(c, "OTHER").split()[0]
            count[name] = count.get(name, 0) + text.count(c)
    return max(sorted(count), key=count.__getitem__, default="NONE").lower()


def measures(
    docs: DataFrame,
    piece_model: str,
    rank_file: str,
    pattern: str,
    carry: bool = False,
) -> DataFrame:
    """Base counts and fertility of each document; `carry` adds its row as
    the struct _row.

    `_group` is its language, or its script where lang is null or empty.
    Every word is encoded by itself, so a word has the same tokens in every
    text.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        model = sole(_load, piece_model, rank_file, pattern)
        langs, texts, rows = cols["lang"], cols["text"], []
        for at in range(0, len(texts), TOGETHER):
            part = texts[at : at + TOGETHER]
            for lang, text, (counts, values) in zip(
                langs[at : at + TOGETHER], part, model.rows(part), strict=True
            ):
                group = (
                    f"lang:{lang}" if lang else f"script:{script_of(text or '')}"
                )
                rows.append((*counts, group, *values))
        names = MEASURED.fieldNames()[1:]
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        return {"doc_id": cols["doc_id"]} | dict(
            zip(names, map(list, columns), strict=True)
        )

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    rows = docs.select(
        F.col("doc_id").cast("long"),
        "text",
        lang.cast("string").alias("lang"),
        *([F.struct(*docs.columns).alias("_row")] if carry else []),
    )
    return map_batches(rows, run, MEASURED, "_row" if carry else None)


def bands(measured: DataFrame) -> DataFrame:
    """Quartiles and reach of each measure for each group, from its documents
    of at least MIN_WORDS words, however few; one row per group.

    The reach shrinks smoothly as documents grow in number: no count switches
    a group from one kind of band to another.
    """
    quartiles = [
        F.percentile_approx(m, [0.25, 0.5, 0.75], 10_000).alias(f"_{m}")
        for m in MEASURES
    ]
    stats = (
        measured.where(F.col("n_words") >= MIN_WORDS)
        .groupBy(F.col("_group").alias("_own"))
        .agg(F.count(F.lit(1)).alias("_n"), *quartiles)
    )

    def low_high(m: str) -> list[Column]:
        q, n = F.col(f"_{m}"), F.col("_n")
        scale = F.lit(1.0) if m in LEAST else q[1]
        reach = (
            REACH[m] * (q[2] - q[0]) * (1 + UNSURE / F.sqrt(n))
            + LEAST.get(m, LEAST_ELSE)
            + UNSURE * scale / n
        )
        return [
            q[0].alias(f"_low_{m}"),
            q[2].alias(f"_high_{m}"),
            reach.alias(f"_reach_{m}"),
        ]

    return stats.select("_own", *[c for m in MEASURES for c in low_high(m)])


def _inside(measure: str) -> Column:
    value = F.col(measure)
    reach = F.col(f"_reach_{measure}") * F.sqrt(
        F.greatest(F.lit(1.0), F.lit(STEADY_WORDS) / F.greatest(F.col("n_words"), F.lit(1)))
    )
    low = F.col(f"_low_{measure}") - reach
    high = F.col(f"_high_{measure}") + reach
    if measure == "entropy_share":
        return value >= low  # only too little variety is a fault
    if measure == "byte_share":
        return value <= high
    return value.between(low, high)


def judge(measured: DataFrame) -> DataFrame:
    """Adds base_failed and kept to measured documents."""
    # groups are languages and scripts; the planner broadcasts what is small
    own = staged(bands(measured), "bands")
    rows = measured.join(own, measured["_group"] == own["_own"], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    inside = F.lit(True)
    for m in MEASURES:
        # without an estimate of its group a document passes
        inside = inside & F.coalesce(_inside(m), F.lit(True))
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & inside
    )


def rate(
    docs: DataFrame, piece_model: str, rank_file: str, pattern: str
) -> DataFrame:
    """Quality verdict of every document, one row per row of `docs`.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, and the measures. A null or empty text has no words,
    null measures, and is not kept; a null doc_id stays null; repeated rows
    stay; other columns are ignored. A measure that is null, or a group without
    bands, rejects nothing by itself. The paths name the
    vocabularies on each executor.
    """
    measured = staged(
        measures(docs, piece_model, rank_file, pattern), "measured"
    )
    return judge(measured).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "_group",
        *MEASURES,
    )


def accepted(
    docs: DataFrame, piece_model: str, rank_file: str, pattern: str
) -> DataFrame:
    """The rows of `docs` that `rate` keeps, with their own columns."""
    measured = staged(
        measures(docs, piece_model, rank_file, pattern, carry=True), "measured"
    )
    return judge(measured).where("kept").select("_row.*")
