"""Alignment of two tokenisers' tokens on the bytes of a text.

A is a byte-level BPE of `tokenizers`, B a sentencepiece model that puts a
space before a text; so A gets the text with a space before it. The libraries'
spans (character offsets of A; byte spans of B's proto) are coarse cuts: they
place whole characters. Tokens that are part of a character, and byte-fallback
tokens, are placed by their decoded bytes. Where an A and a B token both end,
a group ends; an A and a B token whose bytes overlap are linked.

No token of A or B goes on from a character into a space after it, nor from a
letter into stops, so a text is aligned in chunks cut there; chunks repeat, and
their alignments are kept in a memo. Corpus counts of linked id
pairs are a grouped sum. Each row's links then meet the counts: the most
frequent pairs (a fixed number) in the row's own task, all others by a join.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from typing import TYPE_CHECKING, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from proclivity.llm.common import schema, staged

if TYPE_CHECKING:
    from google.protobuf.message import Message
    from tokenizers import Encoding

SPACE = "▁"
#: Cuts before a space between two characters that are no white space, and
#: between a letter and stops.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
STOPS = ".,;:!?#$%&*"
AT_SPACES = re.compile(r"(?<=\S)(?= \S)")
AT_STOPS = f"(?<=[{LETTERS}])(?=[{STOPS}])"
#: Chunks that may stand in a line of others, and the chunks of a line.
JOINED = re.compile(r" \S(?s:.*)(?<=\S)\Z")
LINE = 500
#: Bytes of alignments that a worker remembers, and what Python adds to one.
MEMO_BYTES = 200_000_000
OVERHEAD = 420
LONGEST_KEPT = 64
#: Frequent pairs that every task holds; 17 bytes each.
FREQUENT = 100_000
#: Pairs that a task counts before it hands them on.
COUNTED = 1_000_000

ALIGNED = schema(
    "_row long, doc_id long, n_a long, n_b long, n_groups long,"
    "n_links long, groups_sha256 string, _pairs longs, _times longs"
)
PAIRS = schema("pair long, n long")
SCORED = schema(
    "_row long, doc_id long, n_a long, n_b long, n_groups long,"
    "n_links long, groups_sha256 string, _best long, _sum long,"
    "_pairs longs, _times longs"
)


class Part(NamedTuple):
    """A chunk's alignment: groups as text, and a pair number a link as
    little-endian 64-bit numbers."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: bytes


def byte_alphabet() -> dict[str, int]:
    """The character of each byte in byte-level vocabularies.

    Printable Latin-1 stands for itself; the others follow from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {
        chr(256 + i): b for i, b in enumerate(hidden)
    }


def refined(
    spans: Iterable[tuple[int, int]], made: list[bytes], total: int
) -> list[int] | None:
    """Byte ends of tokens, from their coarse spans and decoded bytes.

    A span as long as its token's bytes is a fixed cut. The ends of other
    tokens (parts of a character share its span) follow from the cut before
    them by their decoded lengths. None if the tokens don't tile the text.
    """
    ends: list[int] = []
    at = 0
    for (start, end), token in zip(spans, made, strict=True):
        size = len(token)
        if end - start != size:
            end = at + size
        elif start != at:
            return None
        ends.append(end)
        at = end
    return ends if at == total else None


def cut_parts(
    ids_a: list[int],
    ends_a: list[int],
    ids_b: list[int],
    ends_b: list[int],
    stops: list[int],
    width: int,
) -> list[Part]:
    """The alignment between each two stops; both sides end at every stop.

    Walks the cuts of both sides: between two neighbouring cuts of either
    side lies exactly one linked pair.
    """
    out: list[Part] = []
    groups: list[str] = []
    pairs: list[int] = []
    i = j = at_a = at_b = from_a = from_b = 0
    for stop in stops:
        end = -1
        while end < stop:
            pairs.append(ids_a[i] * width + ids_b[j])
            a, b = ends_a[i], ends_b[j]
            i += a <= b
            j += b <= a
            if a == b:
                end = a
                if i - at_a == 1 and j - at_b == 1:
                    groups.append(f"{ids_a[at_a]}|{ids_b[at_b]}")
                else:
                    left = ",".join(map(str, ids_a[at_a:i]))
                    right = ",".join(map(str, ids_b[at_b:j]))
                    groups.append(f"{left}|{right}")
                at_a, at_b = i, j
        if end != stop:
            raise AssertionError("a token crosses two chunks")
        out.append(
            Part(
                i - from_a,
                j - from_b,
                len(groups),
                ";".join(groups),
                array("q", pairs).tobytes(),
            )
        )
        groups, pairs, from_a, from_b = [], [], i, j
    return out


def without_first(part: Part) -> Part:
    """A part without its first group, one token of each side."""
    _, _, groups = part.groups.partition(";")
    return Part(
        part.n_a - 1, part.n_b - 1, part.n_groups - 1, groups, part.pairs[8:]
    )


class Aligner:
    """Aligns texts by two tokeniser files."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        self.bytes_a: dict[int, bytes] = {
            number: bytes(map(alphabet.__getitem__, token))
            if set(token) <= alphabet.keys()
            else token.encode()
            for token, number in self.a.get_vocab().items()
        }
        self.width = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(self.width)]
        self.bytes_b = [
            bytes([int(name[3:5], 16)])
            if self.b.is_byte(i)
            else name.replace(SPACE, " ").encode()
            for i, name in enumerate(names)
        ]
        # a cut is only taken where no piece of B crosses it
        self.cut = None
        if not any(re.search(f"[^{SPACE}]{SPACE}", n) for n in names):
            stops = re.compile(f"[{LETTERS}][{STOPS}]")
            self.cut = AT_SPACES
            if not any(map(stops.search, names)):
                self.cut = re.compile(f"{AT_SPACES.pattern}|{AT_STOPS}")
        self.memo: dict[str, Part | None] = {}
        self.free = MEMO_BYTES

    def align(self, chunks: list[str]) -> list[Part] | None:
        """Alignments of chunks that follow each other, each beginning with a
        space; None where a side does not give back the text's bytes."""
        text = "".join(chunks)
        a = self.a.encode_batch([text], add_special_tokens=False)[0]
        b = self.b.encode(text[1:], return_type="proto", num_threads=1)
        whole = text.encode()
        ids_a, spans_a = a.ids, a.offsets
        pieces = list(b.pieces)
        ids_b = [p.id for p in pieces]
        made_a = [self.bytes_a[i] for i in ids_a]
        made_b = [self.bytes_b[i] for i in ids_b]
        if b"".join(made_a) != whole or b"".join(made_b) != whole:
            return None
        if not text.isascii():
            # character offsets become byte offsets
            at = [0, *accumulate(len(c.encode()) for c in text)]
            spans_a = [(at[i], at[j]) for i, j in spans_a]
        # the bytes of B's spans begin after the space that it adds
        spans_b = [(p.begin + 1, p.end + 1) for p in pieces]
        spans_b[0] = (0, spans_b[0][1])
        ends_a = refined(spans_a, made_a, len(whole))
        ends_b = refined(spans_b, made_b, len(whole))
        if ends_a is None or ends_b is None:
            raise AssertionError("spans contradict the decoded bytes")
        stops = list(accumulate(len(c.encode()) for c in chunks))
        return cut_parts(ids_a, ends_a, ids_b, ends_b, stops, self.width)

    def chunks(self, text: str) -> list[str]:
        """Chunks of a text with its added space, which join to it; none of an
        empty text and of one that B can't give back."""
        if not text or SPACE in text:
            return []
        return self.cut.split(f" {text}") if self.cut else [f" {text}"]

    def parts(self, texts: list[str]) -> list[list[Part]]:
        """The alignments of each text's chunks; none of a text that a side
        does not give back."""
        found = [self.chunks(t) for t in texts]
        memo = self.memo
        if self.free < 0:
            memo.clear()
            self.free = MEMO_BYTES
        missing = list(set().union(*found).difference(memo))
        # a chunk without a space goes after a letter with one
        spaced = [c if c[0] == " " else f" a{c}" for c in missing]
        made: dict[str, Part | None] = {}
        joined = [c for c in set(spaced) if JOINED.match(c)]
        for at in range(0, len(joined), LINE):
            line = joined[at : at + LINE]
            aligned = self.align(line)
            if aligned is not None:
                made.update(zip(line, aligned, strict=True))
        for chunk, name in zip(missing, spaced, strict=True):
            if name not in made:
                alone = self.align([name])
                made[name] = alone[0] if alone else None
            part = made[name]
            if part is not None and name is not chunk:
                part = without_first(part)
            memo[chunk] = part
        out = [[memo[c] for c in chunks] for chunks in found]
        for chunk in missing:
            if len(chunk) > LONGEST_KEPT:
                del memo[chunk]
            else:
                self.free -= 12 * len(chunk) + OVERHEAD
        return [[] if None in parts else parts for parts in out]


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Aligner:
    """The aligner of two tokeniser files, built once a Python worker."""
    return Aligner(path_a, path_b)


def _mapped(df: DataFrame, fn, fields: StructType) -> DataFrame:
    """Map Arrow batches given as a list per column, in slices."""
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                out = fn(batch.slice(at, 1_000))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in arrow],
                    schema=arrow,
                )

    return df.mapInArrow(run, fields)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row: counts, digest, and the linked pairs with times."""

    def run(batch: pa.RecordBatch) -> dict:
        aligner = load(path_a, path_b)
        cols = batch.to_pydict()
        out: dict[str, list] = {n: [] for n in ALIGNED.fieldNames()}
        out["_row"], out["doc_id"] = cols["_row"], cols["doc_id"]
        for parts in aligner.parts([t or "" for t in cols["text"]]):
            n_a, n_b, n_groups, groups, linked = (
                zip(*parts, strict=True) if parts else ((),) * 5
            )
            pairs = np.frombuffer(b"".join(linked), np.int64)
            out["n_a"].append(sum(n_a))
            out["n_b"].append(sum(n_b))
            out["n_groups"].append(sum(n_groups))
            out["n_links"].append(len(pairs))
            out["groups_sha256"].append(
                hashlib.sha256(";".join(groups).encode()).hexdigest()
                if parts
                else ""
            )
            once, times = np.unique(pairs, return_counts=True)
            out["_pairs"].append(once)
            out["_times"].append(times)
        return out

    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long"),
        "text",
    )
    return _mapped(rows, run, ALIGNED)


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs, their times, and the row that each is of."""
    pairs, times = batch.column("_pairs"), batch.column("_times")
    sizes = np.diff(pairs.offsets.to_numpy())
    return (
        pairs.flatten().to_numpy(),
        times.flatten().to_numpy(),
        np.repeat(np.arange(len(pairs)), sizes),
    )


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, n: how many links of all rows hold an id pair.

    A task adds up its own rows first, in a bounded table.
    """
    names = PAIRS.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            more, times, _ = _lists(batch)
            every, at = np.unique(
                np.concatenate([pairs, more]), return_inverse=True
            )
            total = np.bincount(
                at, np.concatenate([n, times]), len(every)
            ).astype(np.int64)
            pairs, n = every, total
            if len(pairs) > COUNTED:
                yield pa.RecordBatch.from_arrays([pairs, n], names=names)
                pairs, n = pairs[:0], n[:0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(pairs), pa.array(n)], names=names
        )

    return (
        rows.select("_pairs", "_times")
        .mapInArrow(run, PAIRS)
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )


def marked(counts: DataFrame, width: int) -> DataFrame:
    """pair, n, and whether n is the highest of the pair's B id.

    The highest counts are one row a B id, at most the size of a vocabulary.
    """
    b = F.pmod("pair", F.lit(width))
    most = counts.groupBy(b.alias("_b")).agg(F.max("n").alias("_most"))
    return counts.join(most, b == F.col("_b")).select(
        "pair", "n", (F.col("n") == F.col("_most")).alias("best")
    )


def _frequent(table: DataFrame, most: int) -> tuple[np.ndarray, ...]:
    """The `most` most frequent pairs, by number: pairs, counts, best."""
    rows = table.orderBy(F.desc("n"), "pair").limit(most).toArrow()
    pairs = rows["pair"].to_numpy()
    order = np.argsort(pairs)
    return (
        pairs[order],
        rows["n"].to_numpy()[order],
        rows["best"].to_numpy()[order],
    )


def align(
    docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT
) -> DataFrame:
    """Aligned tokens of all texts, with the corpus counts of their links.

    One row per row of `docs`: doc_id, n_a, n_b (tokens), n_groups, n_links,
    n_best (links whose count is the highest of their B id, ties included),
    count_sum (counts of all links), groups_sha256 (of the groups
    `a1,a2|b1;a3|b2`). Texts that are null, empty, or not given back by both
    tokenisers have zeros and an empty digest; a null doc_id stays null;
    repeated rows stay, and all of them count; other columns are ignored; an
    empty table gives no rows. Both files lie on driver and executors.
    """
    width = load(path_a, path_b).width
    rows = staged(aligned(docs, path_a, path_b), "aligned")
    counts = staged(pair_counts(rows), "pairs")
    table = staged(marked(counts, width), "counts")
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(_frequent(table, frequent))

    def run(batch: pa.RecordBatch) -> dict:
        pairs, n, best = known.value
        found, times, row = _lists(batch)
        at = np.minimum(np.searchsorted(pairs, found), max(len(pairs) - 1, 0))
        here = pairs[at] == found if len(pairs) else np.zeros(len(found), bool)
        total = np.zeros(batch.num_rows, np.int64)
        np.add.at(total, row[here], times[here] * n[at[here]])
        top = np.zeros(batch.num_rows, np.int64)
        np.add.at(top, row[here], times[here] * best[at[here]])
        rest = np.flatnonzero(~here)
        cuts = np.searchsorted(row[rest], np.arange(1, batch.num_rows))
        return {n: batch.column(n) for n in ALIGNED.fieldNames()[:-2]} | {
            "_best": top,
            "_sum": total,
            "_pairs": np.split(found[rest], cuts),
            "_times": np.split(times[rest], cuts),
        }

    scored = staged(_mapped(rows, run, SCORED), "scored")
    rest = (
        scored.select("_row", F.explode(F.arrays_zip("_pairs", "_times")).alias("x"))
        .select("_row", F.col("x._pairs").alias("pair"), F.col("x._times").alias("t"))
        .join(table, "pair")
        .groupBy("_row")
        .agg(
            F.sum(F.col("t") * F.col("best").cast("long")).alias("_more_best"),
            F.sum(F.col("t") * F.col("n")).alias("_more_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return scored.join(rest, "_row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("_best") + F.coalesce("_more_best", zero)).alias("n_best"),
        (F.col("_sum") + F.coalesce("_more_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )
