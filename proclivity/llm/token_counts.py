"""Token counts of texts, kept in a digest cache.

The cache is a Parquet folder of (tokenizer, digest, n_tokens). `tokenizer` is
a digest of the tokeniser's file and its library's version; `digest` is one of
a text's normalised content, chosen so that equal digests have equal counts.
A call digests all texts, joins the digests to the cache, encodes one text of
each digest that is missing, appends the counts, and joins again. Texts only
move for digests that are missing, once a task and digest.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity.llm.chunks import LONGEST_KEPT, safe
from proclivity.llm.common import map_batches, schema, staged

LIMIT = 2048
#: Bytes of words, with what Python adds to each, that a worker remembers.
MEMO_BYTES = 120_000_000
OVERHEAD = 130
#: Stops that are a match of their own after a letter.
STOPS = ".,;:!?#$%&*"
#: Digests that a task remembers to have sent.
SEEN = 200_000
#: Characters, and words of a line, that go to the library at a time.
SLICE = 400_000
LINE = 2_000

# Fixed value: the split of public CLIP-like tokenisers. No match holds white
# space, so a text's count is the sum of its words' counts.
WORD_SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
)

CACHE = schema("tokenizer string, digest binary, n_tokens long")
KEYED = schema("doc_id long, n_bytes long, _digest binary")
TEXTS = schema("_digest binary, _text string")
COUNTED = schema("digest binary, n_tokens long")


def is_match(part: str) -> bool:
    """Whether letters are one match; this one gets a mark in lower case."""
    return safe(part) and "\u0130" not in part


class WordCounts(dict):
    """Counts of words; those it lacks are noted and count 0."""

    def __init__(self) -> None:
        self.unknown: list[bytes] = []
        self.free = MEMO_BYTES

    def __missing__(self, word: bytes) -> int:
        self.unknown.append(word)
        return 0

    def add(self, counts: dict[bytes, int]) -> None:
        for word, n in counts.items():
            if len(word) <= LONGEST_KEPT and word not in self:
                self.free -= len(word) + OVERHEAD
                self[word] = n


class Counter:
    """Counts tokens as the library of a tokeniser file does."""

    def __init__(self, path: str) -> None:
        self.by_words = self.folds_case = False
        self.specials: list[bytes] = []
        self.memo = WordCounts()
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encoded: Callable[[list[str]], list[int]] = lambda texts: [
                len(ids) for ids in pieces.encode(texts, num_threads=1)
            ]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.encoded = lambda texts: [
            len(e)
            for e in library.encode_batch_fast(
                texts, add_special_tokens=False
            )
        ]
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        plain = all(
            not (t["normalized"] or t["lstrip"] or t["rstrip"])
            and len(t["content"].split()) == 1
            for t in spec["added_tokens"]
        )
        self.specials = [
            t["content"].lower().encode() for t in spec["added_tokens"]
        ]
        steps = spec["pre_tokenizer"] or {}
        first = steps.get("pretokenizers", [steps])[0]
        self.by_words = (
            plain
            and first.get("type") == "Split"
            and first.get("behavior") == "Removed"
            and first.get("invert") is True
            and first.get("pattern") == {"Regex": WORD_SPLIT}
        )
        forms = spec["normalizer"] or {}
        kinds = [f["type"] for f in forms.get("normalizers", [forms]) if f]
        self.by_words &= set(kinds) <= {"NFC", "Replace", "Lowercase"}
        self.folds_case = self.by_words and "Lowercase" in kinds
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_words &= bool(suffix)
        if self.by_words:
            self.ends = np.zeros(library.get_vocab_size(), bool)
            for token, number in library.get_vocab().items():
                self.ends[number] = token.endswith(suffix)
        self.ids: Callable[[str], list[int]] = lambda text: (
            library.encode_batch_fast([text], add_special_tokens=False)[0].ids
        )

    def content(self, text: str) -> bytes:
        """What a text's count depends on.

        Where counts are sums over words: the words, joined by one space, in
        lower case if all are ASCII (composition of accents comes first, so
        the case of others matters). A text with an added token's string, in
        any case, stays as it is, and so does each text of other tokenisers.
        The first byte keeps the forms apart.
        """
        raw = text.encode()
        if not self.by_words:
            return b"r" + raw
        low = raw.lower()
        if any(s in low for s in self.specials):
            return b"r" + raw
        if self.folds_case and raw.isascii():
            raw = low
        return b"w" + b" ".join(raw.split())

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_words:
            return self._sliced(texts)
        memo = self.memo
        if memo.free < 0:
            memo.clear()
            memo.free = MEMO_BYTES
        totals, unknown = [], []
        for text in texts:
            memo.unknown = []
            totals.append(sum(map(memo.__getitem__, text.encode().split())))
            unknown.append(memo.unknown)
        new = set().union(*unknown)
        cut = {w: self._cut(w.decode()) for w in new}
        parts = {p for ps in cut.values() for p in ps}
        count = self._parts(list(parts))
        known = {w: sum(map(count.__getitem__, ps)) for w, ps in cut.items()}
        memo.add(known)
        return [
            n + sum(map(known.__getitem__, ws))
            for n, ws in zip(totals, unknown, strict=True)
        ]

    def _cut(self, word: str) -> list[str]:
        """Parts of a word whose counts add up to its own.

        Stops after a letter are a match of their own (letters of blocks
        whose classes no Unicode version changes); ASCII letters lose their
        case. A word with an added token's string stays whole.
        """
        low = word.lower().encode()
        if any(s in low for s in self.specials):
            return [word]
        stem = word.rstrip(STOPS)
        if not stem or not is_match(stem[-1]):
            stem = word
        tail = word[len(stem) :]
        if self.folds_case and stem.isascii():
            stem = stem.lower()
        return [stem, tail] if tail else [stem]

    def _parts(self, parts: list[str]) -> dict[str, int]:
        """Counts of parts: letters, one match each, go as lines of words
        that are cut after each token that ends a match; others alone."""
        out = {p: self.memo[p.encode()] for p in parts if p.encode() in self.memo}
        lines = [p for p in parts if p not in out and is_match(p)]
        for at in range(0, len(lines), LINE):
            line = lines[at : at + LINE]
            ends = np.flatnonzero(self.ends[self.ids(" ".join(line))])
            if len(ends) != len(line):
                raise AssertionError("a word is not one match")
            out.update(zip(line, np.diff(ends, prepend=-1).tolist(), strict=True))
        rest = [p for p in parts if p not in out]
        out.update(zip(rest, self._sliced(rest), strict=True))
        self.memo.add({p.encode(): n for p, n in out.items()})
        return out

    def _sliced(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        part: list[str] = []
        size = 0
        for text in texts:
            part.append(text)
            size += len(text) + 20
            if size > SLICE:
                out += self.encoded(part)
                part, size = [], 0
        return out + self.encoded(part) if part else out


@lru_cache(maxsize=2)
def load(path: str) -> Counter:
    """The counter of a tokeniser file, built once in each Python worker."""
    return Counter(path)


def version_of(path: str) -> str:
    """Digest of a tokeniser: its file, its library and that one's version.

    Executors must have the file and library version of the driver.
    """
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as file:
        body = hashlib.file_digest(file, "sha256").hexdigest()
    name = f"{library.__name__} {library.__version__} {body}"
    return hashlib.sha256(name.encode()).hexdigest()


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokeniser; none if there is no cache yet.

    Two writers may append the same digest: it counts once.
    """
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return (
        rows.where(F.col("tokenizer") == version)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )


def _digest(counter: Counter, text: str | None) -> bytes:
    return hashlib.sha256(counter.content(text or "")).digest()


def keyed(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and _digest of every row."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        counter = load(path)
        return {
            "doc_id": cols["doc_id"],
            "n_bytes": [len((t or "").encode()) for t in cols["text"]],
            "_digest": [_digest(counter, t) for t in cols["text"]],
        }

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_batches(rows, run, KEYED)


def texts_of(docs: DataFrame, path: str) -> DataFrame:
    """(_digest, _text), most digests only once a task.

    So a text that many rows hold is sent on by each task once, not by each
    row; which digests a task remembers changes nothing in the result.
    """
    names = TEXTS.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        seen: set[bytes] = set()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            digests = [_digest(counter, t) for t in texts]
            first: dict[bytes, str] = {}
            for digest, text in zip(digests, texts, strict=True):
                if digest not in seen:
                    first[digest] = text or ""
            if len(seen) > SEEN:
                seen.clear()
            seen.update(first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(first), pa.binary()),
                    pa.array(list(first.values()), pa.string()),
                ],
                names=names,
            )

    return docs.select("text").mapInArrow(run, TEXTS)


def _encode(path: str, cols: dict[str, list]) -> dict[str, list]:
    return {
        "digest": cols["_digest"],
        "n_tokens": load(path).counts(cols["_text"]),
    }


def fill(
    docs: DataFrame, digests: DataFrame, path: str, cache: str
) -> None:
    """Append the counts of the digests that the cache lacks.

    The append is one Spark write: a job that fails leaves nothing of it, a
    task that is repeated commits once.
    """
    version = version_of(path)
    known = cached(docs.sparkSession, cache, version)
    missing = (
        digests.select("_digest")
        .distinct()
        .join(known, F.col("_digest") == F.col("digest"), "left_anti")
    )
    # both sides are dealt by digest, and so is the last step
    wanted = (
        texts_of(docs, path)
        .join(missing, "_digest", "left_semi")
        .dropDuplicates(["_digest"])
    )
    counts = map_batches(wanted, partial(_encode, path), COUNTED)
    (
        counts.withColumn("tokenizer", F.lit(version))
        .write.mode("append")
        .partitionBy("tokenizer")
        .parquet(cache)
    )


def count(
    docs: DataFrame, path: str, cache: str, limit: int = LIMIT
) -> DataFrame:
    """Token counts of all texts, from the cache where it has them.

    One row per row of `docs`: doc_id, n_bytes (UTF-8), n_tokens, over_limit
    (n_tokens > limit). Null and empty texts have no bytes and no tokens; a
    null doc_id stays null; repeated rows stay and are encoded once; other
    columns are ignored; an empty table gives no rows. `path` names the
    tokeniser's file (.json or .model) on driver and executors, `cache` a
    folder that all of them see; it is made where it is missing.
    """
    rows = staged(keyed(docs, path), "digests")
    fill(docs, rows, path, cache)
    known = cached(docs.sparkSession, cache, version_of(path))
    return rows.join(
        known, F.col("_digest") == F.col("digest"), "left"
    ).select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
