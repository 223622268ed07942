"""Removal of repeated word windows by repeated-phrase automata.

A window is WINDOW consecutive words. Its anchor is the phrase of PHRASE words
in it with the least hash, so equal windows have equal anchors at the same
place, and a run of neighbouring windows shares one anchor. Only anchors that
occur twice can lie in repeated windows: runs are grouped by their anchor and
content, and where one anchor has several contents the windows themselves are
counted. That confirms which passages recur.

The anchors of confirmed passages are then compiled into Aho-Corasick
automata over words, one for each shard of documents, holding only phrases
that the shard has. A document with such a passage streams through its shard's
automaton; at each phrase found the passages around it are compared word by
word, and the words of the occurrences are removed. Documents without one lose
nothing, and of repeated rows with a window nothing is left: both are mapped
row by row, so shards hold only different documents that have passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from proclivity.llm.common import (
    among,
    freeing,
    map_batches,
    mask_of,
    schema,
    staged,
    words,
)
from proclivity.llm.shingles import STEP, mix, word_hashes

WINDOW = 35
PHRASE = 8
#: Bytes of text a shard are this many runs of RUN_BYTES: four megabytes.
SHARD_RUNS = 50_000
RUN_BYTES = 80

#: Parts of a place: first window, distance of the anchor, and number of
#: windows.
START = "_place >> 16 AS _start"
AT = "(_place >> 8) & 255 AS _at"
SIZE = "_place & 255 AS _n"

RUNS = schema("_x long, _anchor long, _run long, _place long")
WINDOWS = schema("_anchor long, _run long, _w long, _off int, _count long")
ADDED = schema("n_words long, n_removed long, kept string")


def hashes_of(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all phrases and of all windows, by doubling lengths."""
    made = {1: word_hashes(found)}
    size = 1
    while size * 2 <= WINDOW:
        made[size * 2] = _joined(made[size], size)
        size *= 2
    return made[PHRASE], _joined(made[size], WINDOW - size)


def _joined(parts: np.ndarray, shift: int) -> np.ndarray:
    """Hashes of parts with the parts that start `shift` words later."""
    n = max(0, len(parts) - shift)
    return mix(parts[:n] * STEP + mix(parts[shift : shift + n]))


def anchors_of(phrases: np.ndarray, n: int) -> np.ndarray:
    """Place of each window's anchor: the first least phrase in it."""
    width = WINDOW - PHRASE + 1
    least, at = phrases, np.arange(len(phrases))
    size = 1
    while size < width:
        step = min(size, width - size)
        later = least[step:] < least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.where(later, least[step:], least[:-step])
        size += step
    return at[:n]


def runs_in(found: list[bytes]) -> tuple[np.ndarray, ...]:
    """Anchor, content, first window, number of windows, and the anchor's
    place, of each run of windows with one anchor; and all window hashes."""
    phrases, windows = hashes_of(found)
    at = anchors_of(phrases, len(windows))
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    end = np.concatenate([first[1:], [len(at)]])
    # the first and last windows of a run cover all its words
    content = mix(
        windows[first] * STEP
        + mix(windows[end - 1] + (end - first).astype(np.uint64))
    )
    return (
        phrases[at[first]].view(np.int64),
        content.view(np.int64),
        first,
        end - first,
        at[first],
        windows,
    )


def packed(start: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A place; its parts are START, AT and SIZE."""
    return start << 16 | (at - start) << 8 | n




def keyed(docs: DataFrame) -> DataFrame:
    """Adds _x, a hash of a document's number and text; null texts are empty
    ones."""
    return docs.withColumn(
        "_x",
        F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit(""))),
    )


def runs_of_documents(docs: DataFrame) -> DataFrame:
    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in RUNS.fieldNames()}
        for x, text in zip(cols["_x"], cols["text"], strict=True):
            found = words(text)
            if len(found) < WINDOW:
                continue
            anchor, content, first, n, at, _ = runs_in(found)
            out["_x"].append(np.full(len(first), x))
            out["_anchor"].append(anchor)
            out["_run"].append(content)
            out["_place"].append(packed(first, at, n))
        return {k: np.concatenate(v) if v else [] for k, v in out.items()}

    return map_batches(docs.select("_x", "text"), run, RUNS)


def windows_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Window hashes of wanted runs (one occurrence of each), with the run's
    number of occurrences."""
    parts = ("_start", "_n", "_anchor", "_run", "_count")
    lists = (
        wanted.selectExpr(*parts[2:], "_x", START, SIZE)
        .groupBy("_x")
        .agg(F.collect_list(F.struct(*parts)).alias("_runs"))
    )
    # only texts with such runs are shuffled
    once = among(
        docs.select("_x", "text"), "_x", mask_of(wanted, "_x")
    ).dropDuplicates(["_x"])
    rows = once.join(lists, "_x").select(
        "text", *[F.col("_runs").getField(n).alias(n) for n in parts]
    )

    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in WINDOWS.fieldNames()}
        for i, text in enumerate(cols["text"]):
            _, windows = hashes_of(words(text))
            windows = windows.view(np.int64)
            starts = np.array(cols["_start"][i])
            n = np.array(cols["_n"][i])
            ends = np.cumsum(n)
            off = np.arange(ends[-1]) - np.repeat(ends - n, n)
            out["_w"].append(windows[np.repeat(starts, n) + off])
            out["_off"].append(off)
            for name in ("_anchor", "_run", "_count"):
                out[name].append(np.repeat(np.array(cols[name][i]), n))
        return {
            k: np.concatenate(v) if v else [] for k, v in out.items()
        }

    return map_batches(rows, run, WINDOWS)


def confirmed(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """(_anchor, _run, _mask): bit i is set if window i of the run recurs."""
    kinds = staged(
        runs.groupBy("_anchor", "_run").agg(
            F.sum("_count").alias("_count"),
            F.min("_x").alias("_x"),
            F.min_by("_place", "_x").alias("_place"),
        ),
        "kinds",
    )
    # counted in each task first: a common anchor is one row a task
    several = kinds.groupBy("_anchor").agg(
        F.count(F.lit(1)).alias("_kinds")
    )
    again = staged(kinds.join(several, "_anchor"), "again")
    whole = again.where("_kinds = 1").select(
        "_anchor",
        "_run",
        F.expr("shiftleft(1L, cast(_place & 255 AS int)) - 1").alias("_mask"),
    )
    found = staged(
        windows_of(docs, again.where("_kinds > 1")), "windows"
    )
    twice = (
        found.groupBy("_anchor", "_w")
        .agg(F.sum("_count").alias("_total"))
        .where("_total > 1")
    )
    part = (
        found.join(twice, ["_anchor", "_w"])
        .groupBy("_anchor", "_run")
        .agg(F.bit_or(F.expr("shiftleft(1L, _off)")).alias("_mask"))
    )
    return whole.unionByName(part)


class Passages:
    """The automaton of a shard: phrases of word numbers, and for each the
    passages around it as (words before it, length) to sets of numbers."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.around: dict[tuple, dict[tuple[int, int], set]] = {}

    def numbered(self, found: list[bytes]) -> tuple[int, ...]:
        numbers = self.numbers
        return tuple(
            [numbers.setdefault(w, len(numbers)) for w in found]
        )

    def add(self, text: tuple, start: int, at: int, mask: int) -> None:
        """Passages of a run: its stretches of confirmed windows."""
        around = self.around.setdefault(text[at : at + PHRASE], {})
        i = 0
        while mask >> i:
            if not mask >> i & 1:
                i += 1
                continue
            j = i
            while mask >> j & 1:
                j += 1
            first, size = start + i, j - i + WINDOW - 1
            around.setdefault((at - first, size), set()).add(
                text[first : first + size]
            )
            i = j

    def compile(self) -> None:
        self.automaton = ahocorasick.Automaton(
            ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE
        )
        for phrase, around in self.around.items():
            self.automaton.add_word(phrase, list(around.items()))
        if self.around:
            self.automaton.make_automaton()

    def covered(self, text: tuple) -> np.ndarray:
        """Which words every occurrence of the passages covers."""
        out = np.zeros(len(text), bool)
        if not self.around or len(text) < WINDOW:
            return out
        for end, around in self.automaton.iter(text):
            for (before, size), passages in around:
                first = end + 1 - PHRASE - before
                if first >= 0 and text[first : first + size] in passages:
                    out[first : first + size] = True
        return out


def _cleaned(
    docs: pa.Table, passages: pa.Table, fields: pa.Schema
) -> pa.Table:
    """A shard's documents with their counts and kept words."""
    column = docs.column("text").to_pylist()
    first = dict(zip(docs.column("_x").to_pylist(), column, strict=True))
    found = {t: words(t) for t in dict.fromkeys(column)}
    shard = Passages()
    numbered = {t: shard.numbered(w) for t, w in found.items()}
    for row in passages.to_pylist():
        text = numbered[first[row["_x"]]]
        at = row["_start"] + row["_at"]
        shard.add(text, row["_start"], at, row["_mask"])
    shard.compile()
    done = {}
    for t, here in found.items():
        gone = shard.covered(numbered.pop(t))
        kept = [w for w, x in zip(here, gone.tolist(), strict=True) if not x]
        done[t] = len(here), int(gone.sum()), b" ".join(kept).decode()
    added = {
        n: pa.array([done[t][i] for t in column], fields.field(n).type)
        for i, n in enumerate(ADDED.fieldNames())
    }
    columns = [
        added[n] if n in added else docs.column(n).cast(fields.field(n).type)
        for n in fields.names
    ]
    return pa.Table.from_arrays(columns, schema=fields)


def _straight(docs: pa.RecordBatch, fields: pa.Schema) -> pa.RecordBatch:
    """Documents that lose all words (repeated rows) or none."""
    column = docs.column("text").to_pylist()
    copies = docs.column("_copies").to_pylist()
    n, gone, kept = [], [], []
    for text, again in zip(column, copies, strict=True):
        found = words(text)
        n.append(len(found))
        gone.append(len(found) if again else 0)
        kept.append("" if again else b" ".join(found).decode())
    added = dict(zip(ADDED.fieldNames(), (n, gone, kept), strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(added[f.name], f.type)
            if f.name in added
            else docs.column(f.name).cast(f.type)
            for f in fields
        ],
        schema=fields,
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Adds n_words, n_removed and kept (the words left, joined by a space).

    One row per row of `docs`, all columns kept; a column named as one of the
    three is replaced. Every word in a window that occurs anywhere else, in
    the same document or a repeated row too, is removed. Null, empty and
    short texts have no window; a null doc_id is allowed. Other columns may
    have any name.
    """
    own = [c for c in docs.columns if c not in ADDED.fieldNames()]
    rest = [c for c in own if c not in ("doc_id", "text")]
    if not rest:
        return _removed(docs.select(*own))
    done = _removed(
        docs.select(F.struct(*rest).alias("_row"), "doc_id", "text")
    )
    return done.select(
        *[F.col("_row")[c].alias(c) if c in rest else c for c in own],
        *ADDED.fieldNames(),
    )


def _removed(docs: DataFrame) -> DataFrame:
    """`remove_repeats` of doc_id, text and at most a struct `_row`."""
    own = [c for c in docs.columns if c not in ADDED.fieldNames()]
    rows = keyed(docs.select(*own))
    runs = staged(runs_of_documents(rows), "runs")
    # an anchor that occurs once lies in no repeated window
    twice = runs.groupBy("_anchor").count().where("count > 1")
    again = staged(runs.join(twice, "_anchor", "left_semi"), "again")
    here = staged(
        again.groupBy("_anchor", "_run").agg(
            F.count(F.lit(1)).alias("_count"),
            F.min("_x").alias("_x"),
            F.min_by("_place", "_x").alias("_place"),
        ),
        "here",
    )
    found = staged(confirmed(rows, here), "confirmed")
    touched = staged(again.join(found, ["_anchor", "_run"]), "touched")
    # each row has one run from its first word on
    marks = staged(
        touched.groupBy("_x").agg(
            F.sum(F.expr("int(_place >> 16 = 0)")).alias("_rows")
        ),
        "marks",
    )
    # texts are dealt to shards at once: only rows that seem to be repeated
    # are joined with their counts, the exact way to tell
    held = mask_of(marks, "_x")
    again_held = mask_of(marks.where("_rows > 1"), "_x")
    some = among(rows, "_x", held)
    doubtful = among(some, "_x", again_held).join(marks, "_x", "left")
    single = among(some, "_x", again_held, "left_anti").unionByName(
        doubtful.where("_rows IS NULL OR _rows <= 1").drop("_rows")
    )
    with freeing(docs.sparkSession):
        size = single.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // (SHARD_RUNS * RUN_BYTES)))
    shard = F.pmod("_x", F.lit(shards)).cast("int")
    passages = (
        touched.join(marks.where("_rows <= 1"), "_x", "left_semi")
        .withColumn("_shard", shard)
        .groupBy("_anchor", "_run", "_shard")
        .agg(
            F.min("_x").alias("_x"),
            F.min_by("_place", "_x").alias("_place"),
            F.first("_mask").alias("_mask"),
        )
        .selectExpr("_shard", "_x", START, AT, "_mask")
    )
    fields = StructType(
        [*docs.select(*own).schema.fields, *ADDED.fields]
    )
    arrow = to_arrow_schema(fields)

    def clean(left: pa.Table, right: pa.Table) -> pa.Table:
        return _cleaned(left, right, arrow)

    def pass_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _straight(batch, arrow)

    cleaned = (
        single.withColumn("_shard", shard)
        .groupBy("_shard")
        .cogroup(passages.groupBy("_shard"))
        .applyInArrow(clean, fields)
    )
    others = (
        among(rows, "_x", held, "left_anti")
        .select(*own, F.lit(False).alias("_copies"))
        .unionByName(
            doubtful.where("_rows > 1").select(
                *own, F.lit(True).alias("_copies")
            )
        )
    )
    return cleaned.unionByName(others.mapInArrow(pass_on, fields))


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with each text replaced by its kept words, n_chars following."""
    new = {"text": F.col("kept"), "n_chars": F.length("kept")}
    rest = [c for c in docs.columns if c not in new]
    done = remove_repeats(
        docs.select(F.struct(*rest).alias("_row"), "doc_id", "text")
    )
    return done.select(
        *[
            new[c].cast(kind).alias(c) if c in new else F.col("_row")[c].alias(c)
            for c, kind in docs.dtypes
        ]
    )
