"""Best-fit packing of documents into sequences, certified by lower bounds.

Pieces are dealt over partitions, each packed by best-fit decreasing. Dual
feasible functions give a lower bound for any packing of a partition's
lengths. A partition that meets its bound only gives back its loosest
sequence; one with a gap gives back every sequence that is not tight. What
they gave back is dealt anew, over fewer partitions, and packed again, until
one partition holds it, an exchange saves little, or ROUNDS are over.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.llm.chunks import UNCUT, chunks
from proclivity.llm.common import map_batches, schema, sole, staged
from proclivity.llm.runs import Runs, cut_at, gather

CAPACITY = 2048
#: Pieces that one task packs.
PER_PARTITION = 25_000
#: Exchanges at most; the last round keeps all.
ROUNDS = 6
#: A sequence with at most this many free tokens stays as it is.
TIGHT = 8
#: Texts whose chunks are looked up together; chunks encoded as one text, and
#: such texts encoded in one call.
TOGETHER = 4096
IN_TEXT = 64
AT_ONCE = 64
#: Latin letters, and marks that the split pattern takes apart from letters
#: before them, in any version of Unicode.
LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"
MARKS = ".,;:!?#*%&$"
MEMO_BYTES = 160 << 20

PIECES = schema(
    "doc_id long, piece int, start long, length long, ids_crc32 long"
)
PACKED = schema(
    "doc_id long, piece int, start long, length long, ids_crc32 long,"
    "_uid long, _part long, _bin long, offset long, _kept boolean"
)
RESULT = [*PIECES.fieldNames(), "sequence_id", "offset"]


class Encoder:
    """Ids of texts by a byte-level tokeniser, with a bounded memo of chunks."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # byte-level tokens are spelled with one character a byte
        self.size_of = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.size_of[number] = len(token)
        self.runs = Runs(self._runs_of, MEMO_BYTES)
        self.ends = Runs(self._ends_of, MEMO_BYTES >> 4)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(
            texts, add_special_tokens=False
        )
        return [np.array(x.ids, "<u4") for x in found]

    def _runs_of(
        self, parts: list[str]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunks with their space are encoded as few texts, cheaper than one
        by one, and the ids are cut where the chunks end."""
        texts = [
            " " + " ".join(parts[at : at + IN_TEXT])
            for at in range(0, len(parts), IN_TEXT)
        ]
        ids = np.concatenate(
            [
                x
                for at in range(0, len(texts), AT_ONCE)
                for x in self._encode(texts[at : at + AT_ONCE])
            ]
        )
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        length = np.diff(cut_at(self.size_of[ids], ends), prepend=0)
        return ids, length, np.zeros(len(parts), np.int64)

    def _ends_of(
        self, ends: list[str]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        runs = self._encode(ends)
        length = np.array([len(x) for x in runs], np.int64)
        return np.concatenate(runs), length, np.zeros(len(ends), np.int64)

    def _kinds(self, kinds: list[str]) -> tuple[np.ndarray, ...]:
        """The joined runs of kinds of chunks, where each starts, its length."""
        stems, ends = halves(kinds)
        (stem,) = self.runs.numbers([stems])
        (end,) = self.ends.numbers([ends])
        two = np.stack([self.runs.length[stem], self.ends.length[end]], 1)
        own = np.repeat(np.tile([True, False], len(kinds)), two.ravel())
        flat = np.empty(len(own), np.uint32)
        flat[own], flat[~own] = self.runs.run(stem), self.ends.run(end)
        length = two.sum(1)
        return flat, np.cumsum(length) - length, length

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        if not texts:
            return []
        heads, codes, kinds = cut_together([x or "" for x in texts])
        heads = self._encode(heads)
        runs = self._kinds(kinds)
        return [
            np.concatenate([head, gather(*runs, x)])
            for head, x in zip(heads, codes, strict=True)
        ]

    def of(self, text: str | None) -> list[bytes]:
        """The ids of one text as little-endian unsigned 32-bit numbers."""
        return [x.astype("<u4").tobytes() for x in self.ids([text])]


def halves(kinds: list[str]) -> tuple[list[str], list[str]]:
    """Each chunk as what is encoded apart from each other: the word and the
    marks after it if it is letters and marks, else the chunk and nothing."""
    whole = pa.array(kinds, pa.large_string())
    trimmed = pc.utf8_rtrim(whole, characters=MARKS)
    stems = pc.if_else(
        pc.match_substring_regex(trimmed, LETTERS), trimmed, whole
    )
    ends = [""] * len(kinds)
    marked = pc.not_equal(pc.binary_length(stems), pc.binary_length(whole))
    stems = stems.to_numpy(zero_copy_only=False).tolist()
    for i in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist():
        ends[i] = kinds[i][len(stems[i]) :]
    return stems, ends


def cut_together(
    texts: list[str],
) -> tuple[list[str], list[np.ndarray], list[str]]:
    """The first chunk of each text, the places of its other chunks among the
    kinds, and the kinds: all other chunks of the texts, each once."""
    hard = {i: chunks(x) for i, x in enumerate(texts) if UNCUT.search(x)}
    lists = pc.split_pattern(
        pa.array(
            ["" if i in hard else x for i, x in enumerate(texts)],
            pa.large_string(),
        ),
        " ",
    )
    ends = np.diff(lists.offsets.to_numpy())
    first = np.cumsum(ends) - ends
    parts = lists.flatten()
    heads = parts.take(pa.array(first)).to_pylist()
    rest = np.ones(len(parts), bool)
    rest[first] = False
    found = parts.filter(pa.array(rest)).dictionary_encode()
    kinds = found.dictionary.to_numpy(zero_copy_only=False).tolist()
    codes = np.split(
        found.indices.to_numpy(), np.cumsum(ends - 1)[:-1]
    )
    place = {x: i for i, x in enumerate(kinds)} if hard else {}
    for i, own in hard.items():
        heads[i] = own[0]
        codes[i] = np.array(
            [place.setdefault(x, len(place)) for x in own[1:]], np.int64
        )
    return heads, codes, list(place) or kinds


@lru_cache(maxsize=1)
def _memo(path: str) -> Encoder:
    return Encoder(path)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of each piece of n tokens; the first may be shorter."""
    first = min(n, (n - 1) % capacity + 1)
    return [(0, first)] + [
        (at, capacity) for at in range(first, n, capacity)
    ]


def pieces_of(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: its document, place, length and checksum of ids.

    A document is its text's ids and then id 0, so a null or empty text is
    one piece of one token. Repeated rows give repeated pieces; a null doc_id
    stays null. `path` names the tokeniser's JSON file on each executor.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        encoder = sole(_memo, path)
        out: dict[str, list] = {k: [] for k in PIECES.fieldNames()}
        texts = cols["text"]
        found = (
            ids
            for at in range(0, len(texts), TOGETHER)
            for ids in encoder.ids(texts[at : at + TOGETHER])
        )
        for doc_id, numbers in zip(cols["doc_id"], found, strict=True):
            ids = numbers.astype("<u4").tobytes() + bytes(4)
            for piece, (start, n) in enumerate(cut(len(ids) // 4)):
                out["doc_id"].append(doc_id)
                out["piece"].append(piece)
                out["start"].append(start)
                out["length"].append(n)
                out["ids_crc32"].append(
                    zlib.crc32(ids[4 * start : 4 * (start + n)])
                )
        return out

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_batches(rows, run, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each length; the longest go first, each where it fits closest."""
    bins = np.empty(len(lengths), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: a bin with r free tokens is open
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        fits = some >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            at = open_at[free].pop()
            if not open_at[free]:
                some ^= 1 << free
        else:
            free, at = capacity, made
            made += 1
        bins[i] = at
        left = free - n
        open_at[left].append(at)
        some |= 1 << left
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins any packing needs, by two families of dual feasible
    functions: lengths above `capacity - e` count as whole bins and those
    below e as none; or lengths are rounded to multiples of 1/k."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    many = np.concatenate([[0], np.cumsum(count)])
    total = np.concatenate([[0], np.cumsum(count * size)])
    e = np.arange(1, capacity // 2 + 1)
    whole = many[-1] - many[capacity - e + 1]
    between = total[capacity - e + 1] - total[e]
    best = int((-(-(whole * capacity + between) // capacity)).max())
    best = max(best, -(-int(total[-1]) // capacity))
    for k in range(1, 51):
        steps, exact = np.divmod((k + 1) * size, capacity)
        even = exact == 0
        plain = int((count * size)[even].sum())
        rounded = int((count * steps)[~even].sum())
        best = max(
            best, -(-(plain * k + rounded * capacity) // (capacity * k))
        )
    return best


def _pack(pdf: pd.DataFrame, last: bool) -> pd.DataFrame:
    """Pack a partition, and mark the sequences that it keeps."""
    lengths = pdf["length"].to_numpy(np.int64)
    bins = best_fit_decreasing(lengths, CAPACITY)
    made = int(bins.max()) + 1
    free = CAPACITY - np.bincount(bins, lengths, made).astype(np.int64)
    if last:
        keep = np.ones(made, bool)
    elif made == lower_bound(lengths, CAPACITY):
        keep = np.arange(made) != int(free.argmax())
        keep |= free <= TIGHT
    else:
        keep = free <= TIGHT
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    first = np.concatenate([[0], np.cumsum(CAPACITY - free)[:-1]])
    offset = np.empty(len(bins), np.int64)
    offset[order] = ends - lengths[order] - first[bins[order]]
    return pdf.assign(_bin=bins, offset=offset, _kept=keep[bins])[
        PACKED.fieldNames()
    ]


def _packer(last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda pdf: _pack(pdf, last)


def pack(pieces: DataFrame, per_partition: int = PER_PARTITION) -> DataFrame:
    """Place every piece in a sequence: adds sequence_id and offset.

    A piece of the full capacity is a sequence of its own. Others are packed
    in rounds; each round's table is written to the shared folder. Lengths
    beyond the capacity fail; an empty table gives an empty result.
    """
    rows = staged(
        pieces.withColumn("_uid", F.monotonically_increasing_id()), "pieces"
    )
    full = rows.where(F.col("length") == CAPACITY).select(
        *PIECES.fieldNames(),
        (-1 - F.col("_uid")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    out, todo = full, rows.where(F.col("length") < CAPACITY)
    n, turn, stuck = todo.count(), 0, False
    while n:
        parts = -(-n // per_partition)
        last = parts == 1 or stuck or turn == ROUNDS - 1
        dealt = todo.withColumn(
            "_part", F.pmod(F.xxhash64("_uid", F.lit(turn)), F.lit(parts))
        )
        done = staged(
            dealt.groupBy("_part").applyInPandas(_packer(last), PACKED),
            "packed",
        )
        out = out.unionByName(
            done.where("_kept").select(
                *PIECES.fieldNames(),
                (
                    F.lit((turn + 1) << 56)
                    + F.shiftleft(F.col("_part"), 24)
                    + F.col("_bin")
                ).alias("sequence_id"),
                "offset",
            )
        )
        todo = done.where("NOT _kept").select(*rows.columns)
        left = todo.count()
        stuck = left > 0.95 * n  # another exchange would save little
        n, turn = left, turn + 1
    return out.select(*RESULT)
