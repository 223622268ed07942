"""Hard negatives from an inverted multi-index.

The components of a vector are split in two halves with a codebook each; a
cell is a pair of codewords. A query's half-score with every member of a
codeword is at most its inner product with the codeword plus its length times
the codeword's radius, so the sum of two half bounds holds for a cell. The
multi-sequence heap yields the cells by this bound, highest first, and a search
stops as soon as no window can gain from what is left: it has all rows it wants
above the bound, or ends above it.

Cells lie in blocks of bounded size. A search first visits the blocks of the
best cells, and so learns a floor for each window; then all blocks with a cell
that reaches a floor. Blocks walk their own cells by the same heap and give
each window only its best rows above the floor. Results are exact: the sample
that the codebooks are fitted on decides only how much is visited.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from proclivity.llm.common import map_batches, schema, staged

#: Codewords of a half; the cells are their pairs.
CODEWORDS = 24
#: Rows (by hash) that the codebooks are fitted on, and rounds of the fit.
SAMPLE = 4_000
ROUNDS = 8
#: Components of the vectors of a block.
BLOCK = 500_000
#: Components of the queries that meet a block at a time.
ASKED = 2_000_000
#: Rows in the cells that a search visits first.
FIRST = 2_000
#: Rows that a block scores at a time.
STEP = 512
#: Added to bounds, relative to their size, against rounding.
SLACK = 1e-9

#: Beyond all scores.
FAR = 1 << 62

PLACED = schema(
    "_label long, _ids longs, _vec longs, _one int, _two int,"
    "_far1 double, _far2 double"
)
QUERY = schema(
    "anchor_id long, _label long, _vec longs, _w longs, _low longs,"
    "_high longs, _floor longs"
)
VISITS = schema("anchor_id long, _blocks longs")
FOUND = schema("anchor_id long, _w long, vec_id long, score long")
RESULT = schema(
    "anchor_id long, positive_id long, rank int, negative_id long,"
    "positive_score long, negative_score long"
)


class Index(NamedTuple):
    """What is known of all cells: at most CODEWORDS squared of them."""

    half: int
    one: np.ndarray  # codewords (n, half), as doubles
    two: np.ndarray
    far1: np.ndarray  # radius of each codeword over all rows
    far2: np.ndarray
    rows: dict[tuple[int, int], int]  # rows of each cell that has some
    blocks: dict[tuple[int, int], range]  # blocks of each of these cells


def bounds(
    query: np.ndarray, words: np.ndarray, far: np.ndarray
) -> np.ndarray:
    """The highest half-score that a member of each codeword can have."""
    size = np.sqrt(query @ query)
    most = np.abs(words) @ np.abs(query) + size * far
    return words @ query + size * far + SLACK * most + 1e-6


def multi_sequence(
    one: np.ndarray, two: np.ndarray
) -> Iterator[tuple[float, int, int]]:
    """All (sum, i, j) of two lists, the highest sums first.

    (i, j) of the sorted lists enters the heap when it is next in a row or
    column whose earlier pairs have left it.
    """
    if not (len(one) and len(two)):
        return
    by1, by2 = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    high1, high2 = one[by1].tolist(), two[by2].tolist()
    by1, by2 = by1.tolist(), by2.tolist()
    heap = [(-(high1[0] + high2[0]), 0, 0)]
    next_of = [0] * len(high1)  # pairs of each row that left the heap
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, by1[i], by2[j]
        next_of[i] = j + 1
        if i + 1 < len(high1) and next_of[i + 1] == j:
            heapq.heappush(heap, (-(high1[i + 1] + high2[j]), i + 1, j))
        if j + 1 < len(high2) and (i == 0 or next_of[i - 1] > j + 1):
            heapq.heappush(heap, (-(high1[i] + high2[j + 1]), i, j + 1))


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, _label, _vec of the rows that take part.

    Left out: null ids, labels or vectors, null or non-finite components, and
    vectors of another length than most have. A repeated vec_id counts once,
    with its least label and vector. Every seventh id gets the next label of
    ten; components become floor(256 x).
    """
    taken = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("_label"),
        F.col("embedding").cast(ArrayType(DoubleType())).alias("_x"),
    ).where(
        F.col("vec_id").isNotNull()
        & F.col("_label").isNotNull()
        & F.col("_x").isNotNull()
        & F.forall(
            "_x",
            lambda x: x.isNotNull()
            & ~F.isnan(x)
            & (F.abs(x) < float("inf")),
        )
    )
    size = (
        taken.groupBy(F.size("_x").alias("n"))
        .count()
        .orderBy(F.desc("count"), "n")
        .take(1)
    )
    return (
        taken.where(F.size("_x") == (size[0]["n"] if size else 0))
        .groupBy("vec_id")
        .agg(F.min(F.struct("_label", "_x")).alias("_row"))
        .select(
            "vec_id",
            F.when(
                F.col("vec_id") % 7 == 0, (F.col("_row._label") + 1) % 10
            )
            .otherwise(F.col("_row._label"))
            .alias("_label"),
            F.transform("_row._x", lambda x: F.floor(x * 256)).alias("_vec"),
        )
    )


def classes_of(rows: DataFrame, most: int) -> DataFrame:
    """Equal labels and vectors as one row, with their `most` least ids.

    No window wants more ids of equal rows. The limit is applied in each task
    before the shuffle.
    """
    same = Window.partitionBy("_label", "_vec").orderBy("vec_id")
    return (
        rows.withColumn("_n", F.row_number().over(same))
        .where(F.col("_n") <= most)
        .groupBy("_label", "_vec")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("_ids"))
    )


def codebook(points: np.ndarray) -> np.ndarray:
    """Codewords of the sampled halves, by Lloyd's rounds."""
    words = np.unique(points, axis=0)
    words = words[:: max(1, -(-len(words) // CODEWORDS))]
    for _ in range(ROUNDS):
        near = _nearest(points, words)
        total = np.zeros_like(words)
        np.add.at(total, near, points)
        n = np.bincount(near, minlength=len(words))[:, None]
        words = np.where(n > 0, total / np.maximum(n, 1), words)
    return words


def _nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words * words).sum(1) - 2 * points @ words.T, 1)


def _fitted(classes: DataFrame) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Codebooks of both halves from SAMPLE rows; none without rows."""
    picked = (
        classes.select("_vec")
        .orderBy(F.xxhash64("_vec", "_label"), "_vec", "_label")
        .limit(SAMPLE)
        .collect()  # at most SAMPLE vectors
    )
    if not picked:
        return None
    points = np.array([r["_vec"] for r in picked], np.float64)
    half = points.shape[1] // 2
    return half, codebook(points[:, :half]), codebook(points[:, half:])


def placed(
    classes: DataFrame, half: int, one: np.ndarray, two: np.ndarray
) -> DataFrame:
    """Each class with its cell and its distances from both codewords."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        if not cols["_vec"]:
            return {n: [] for n in PLACED.fieldNames()}
        points = np.array(cols["_vec"], np.float64)
        out: dict[str, list] = dict(cols)
        sides = ((one, points[:, :half]), (two, points[:, half:]))
        for (words, part), cell, far in zip(
            sides, ("_one", "_two"), ("_far1", "_far2"), strict=True
        ):
            near = _nearest(part, words)
            out[cell] = near
            out[far] = np.sqrt(((part - words[near]) ** 2).sum(1))
        return out

    return map_batches(
        classes.select("_label", "_ids", "_vec"), run, PLACED
    )


def index_of(
    rows: DataFrame, half: int, one: np.ndarray, two: np.ndarray
) -> Index:
    """Sizes, radii and blocks of all cells (CODEWORDS squared at most).

    Neighbouring cells share a block until it is full; a cell beyond a block
    has several.
    """
    cells = sorted(
        rows.groupBy("_one", "_two")
        .agg(F.count(F.lit(1)), F.max("_far1"), F.max("_far2"))
        .collect()
    )
    far1, far2 = np.zeros(len(one)), np.zeros(len(two))
    most = max(1, BLOCK // max(1, one.shape[1] + two.shape[1]))
    sizes, blocks = {}, {}
    block = used = 0
    for i, j, n, a, b in cells:
        far1[i], far2[j] = max(far1[i], a), max(far2[j], b)
        if used and used + n > most:
            block, used = block + 1, 0
        sizes[i, j] = n
        blocks[i, j] = range(block, block + -(-n // most))
        if n > most:
            block, used = block + len(blocks[i, j]), 0
        else:
            used += n
    return Index(half, one, two, far1, far2, sizes, blocks)


def visited(
    index: Index, query: np.ndarray, floor: int, high: int
) -> tuple[list[int], list[int]]:
    """The blocks that a query visits first, and the rest of those with a cell
    that reaches its floor. Cells surely above all its windows are skipped."""
    one, two = query[: index.half], query[index.half :]
    best = (bounds(one, index.one, index.far1), bounds(two, index.two, index.far2))
    least = (
        -bounds(-one, index.one, index.far1),
        -bounds(-two, index.two, index.far2),
    )
    first: dict[int, None] = {}
    rest: dict[int, None] = {}
    rows = 0
    for bound, i, j in multi_sequence(*best):
        if bound < floor:
            break
        n = index.rows.get((i, j), 0)
        if n and least[0][i] + least[1][j] <= high:
            (first if rows < FIRST else rest).update(
                dict.fromkeys(index.blocks[i, j])
            )
            rows += n
    return list(first), [b for b in rest if b not in first]


def visits(queries: DataFrame, index: Index, later: bool) -> DataFrame:
    """(anchor_id, _block) of the first visits, or of the later ones."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        found = []
        for vec, low, high, floor in zip(
            cols["_vec"],
            cols["_low"],
            cols["_high"],
            cols["_floor"],
            strict=True,
        ):
            query = np.array(vec, np.float64)
            # the same first blocks as before the floors were known
            first, rest = visited(index, query, min(low), max(high))
            if later:
                both = visited(index, query, min(floor), max(high))
                rest = [b for part in both for b in part if b not in first]
            found.append(rest if later else first)
        return {"anchor_id": cols["anchor_id"], "_blocks": found}

    return map_batches(queries, run, VISITS).select(
        "anchor_id", F.explode("_blocks").alias("_block")
    )


class Block:
    """The rows of a block, by cell."""

    def __init__(self, rows: pd.DataFrame, index: Index) -> None:
        rows = rows.sort_values(["_one", "_two"], kind="stable")
        self.vec = np.array(rows["_vec"].tolist(), np.int64)
        self.label = rows["_label"].to_numpy()
        self.ids = rows["_ids"].tolist()
        self.n = np.fromiter(map(len, self.ids), np.int64, len(rows))
        one, two = rows["_one"].to_numpy(), rows["_two"].to_numpy()
        self.by1, at1 = np.unique(one, return_inverse=True)
        self.by2, at2 = np.unique(two, return_inverse=True)
        self.words = index.one[self.by1], index.two[self.by2]
        # radii of this block's members only
        self.far = np.zeros(len(self.by1)), np.zeros(len(self.by2))
        np.maximum.at(self.far[0], at1, rows["_far1"].to_numpy())
        np.maximum.at(self.far[1], at2, rows["_far2"].to_numpy())
        code = at1 * len(self.by2) + at2
        cells, start = np.unique(code, return_index=True)
        ends = [*start[1:].tolist(), len(rows)]
        self.rows = {
            divmod(c, len(self.by2)): (a, b)
            for c, a, b in zip(cells.tolist(), start.tolist(), ends, strict=True)
        }
        self.half = index.half
        # inner products of doubles are exact below 2 ** 53
        most = np.abs(self.vec.astype(np.float64)).max(initial=0.0)
        self.exact = 2.0**53 / max(1.0, most * self.vec.shape[1])
        self.real = self.vec.astype(np.float64)

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        real = query.astype(np.float64)
        if np.abs(real).max(initial=0.0) < self.exact:
            return (self.real[at] @ real).astype(np.int64)
        return self.vec[at] @ query

    def search(
        self,
        anchor: int,
        label: int,
        query: np.ndarray,
        windows: list[tuple[int, int, int, int]],
        want: int,
        same: bool,
    ) -> Iterator[tuple[int, int, int]]:
        """(window, vec_id, score): each window's first `want` rows here.

        A window is (name, low, high, floor). The walk stops where no cell
        that is left reaches the least of the windows' floors, each the score
        of its want-th row so far (one more, as the anchor may be among them).
        """
        real = query.astype(np.float64)
        one, two = real[: self.half], real[self.half :]
        best = (
            bounds(one, self.words[0], self.far[0]),
            bounds(two, self.words[1], self.far[1]),
        )
        least = (
            -bounds(-one, self.words[0], self.far[0]),
            -bounds(-two, self.words[1], self.far[1]),
        )
        floors = {w: floor for w, _, _, floor in windows}
        top = max(high for _, _, high, _ in windows)
        held = np.zeros(0, np.int64)
        score = np.zeros(0, np.int64)
        pending: list[np.ndarray] = []
        waiting = 0

        def meet() -> None:
            nonlocal held, score
            at = np.concatenate(pending)
            mine = self.label[at] == label
            at = at[mine if same else ~mine]
            found = self.scores(at, query)
            keep = (found >= min(floors.values())) & (found <= top)
            held = np.concatenate([held, at[keep]])
            score = np.concatenate([score, found[keep]])
            order = np.argsort(-score, kind="stable")
            held, score = held[order], score[order]
            for w, _, high, _ in windows:
                inside = np.flatnonzero((score >= floors[w]) & (score <= high))
                known = np.cumsum(self.n[held[inside]])
                last = int(np.searchsorted(known, want + same))
                if last < len(inside):
                    floors[w] = int(score[inside[last]])

        for bound, i, j in multi_sequence(*best):
            short = bound < min(floors.values())
            if (short or waiting >= STEP) and pending:
                meet()
                pending, waiting = [], 0
            if bound < min(floors.values()):
                break
            if (i, j) in self.rows and least[0][i] + least[1][j] <= top:
                a, b = self.rows[i, j]
                pending.append(np.arange(a, b))
                waiting += b - a
        if pending:
            meet()
        for w, _, high, _ in windows:
            inside = np.flatnonzero((score >= floors[w]) & (score <= high))
            rows = sorted(
                (-s, x)
                for s, at in zip(
                    score[inside].tolist(), held[inside].tolist(), strict=True
                )
                for x in self.ids[at]
                if x != anchor
            )
            for s, x in rows[:want]:
                yield w, int(x), -s


def met(
    rows: DataFrame, index: Index, queries: DataFrame, calls: DataFrame,
    want: int, same: bool,
) -> DataFrame:
    """What each query finds in the blocks that it visits.

    A block with many queries meets them in parts, so both sides of a group
    are bounded.
    """
    spark = rows.sparkSession
    cells = spark.createDataFrame(
        [(i, j, b[0], len(b)) for (i, j), b in index.blocks.items()],
        "_one int, _two int, _first long, _parts long",
    )
    dealt = rows.join(cells, ["_one", "_two"]).withColumn(
        "_block",
        F.col("_first") + F.pmod(F.xxhash64("_label", "_vec"), "_parts"),
    )
    calls = staged(calls, "visits")
    size = 8 + index.one.shape[1] + index.two.shape[1]
    turns = staged(
        calls.groupBy("_block").agg(
            F.ceil(F.count(F.lit(1)) * size / ASKED).alias("_turns")
        ),
        "turns",
    )
    asked = (
        calls.join(turns, "_block")
        .withColumn("_turn", F.pmod(F.xxhash64("anchor_id"), "_turns"))
        .join(queries, "anchor_id")
        .drop("_turns")
    )
    dealt = dealt.join(turns, "_block").withColumn(
        "_turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_turns") - 1))
    ).drop("_turns")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            block = Block(left, index)
            for q in right.itertuples(index=False):
                # names that begin with a line are numbered in the tuple
                anchor, label, vec, w, low, high, floor = q
                windows = list(
                    zip(*(map(int, x) for x in (w, low, high, floor)), strict=True)
                )
                out += [
                    (anchor, *x)
                    for x in block.search(
                        anchor, label, np.array(vec, np.int64), windows, want, same
                    )
                ]
        return pd.DataFrame(out, columns=FOUND.fieldNames())

    keys = ("_block", "_turn")
    return (
        dealt.groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInPandas(
            lambda left, right: run(left, right[QUERY.fieldNames()]), FOUND
        )
    )


def first_of(found: DataFrame, want: int) -> DataFrame:
    """The first `want` rows of each window, with their rank."""
    order = Window.partitionBy("anchor_id", "_w").orderBy(
        F.desc("score"), "vec_id"
    )
    return found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= want
    )


def search(
    rows: DataFrame, index: Index, queries: DataFrame, want: int, same: bool
) -> DataFrame:
    """anchor_id, _w, vec_id, score, rank: each window's first `want` rows,
    of the anchor's label or of all others."""
    seeds = staged(
        met(rows, index, queries, visits(queries, index, False), want, same),
        "seeds",
    )
    full = (
        first_of(seeds, want)
        .groupBy("anchor_id", "_w")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_least"))
        .where(F.col("_n") == want)
        .groupBy("anchor_id")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("_w", "_least"))
            ).alias("_known")
        )
    )
    floored = staged(
        queries.join(full, "anchor_id", "left").withColumn(
            "_floor",
            F.transform(
                F.arrays_zip("_w", "_floor"),
                lambda x: F.coalesce(F.col("_known")[x["_w"]], x["_floor"]),
            ),
        ).drop("_known"),
        "floors",
    )
    later = met(
        rows, index, floored, visits(floored, index, True), want, same
    )
    return first_of(seeds.union(later), want)


def mine(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10
) -> DataFrame:
    """Hard negatives of each anchor and positive.

    Anchors are the rows whose vec_id is divisible by `every`. Scores are
    integer inner products; higher come first, ties by smaller vec_id. An
    anchor's positives are its first `positives` other rows of its label; the
    negatives of a positive its first `negatives` rows of other labels with
    30 positive_score <= 100 negative_score <= 90 positive_score. Returns
    anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score. What `usable` leaves out takes no part; zero vectors do;
    repeated ids count once; other columns are ignored; an empty table gives
    no rows. Scores are 64-bit numbers; components beyond them are cut to
    their range.
    """
    spark = vectors.sparkSession
    known = staged(usable(vectors), "usable")
    classes = staged(
        classes_of(known, max(positives + 1, negatives)), "classes"
    )
    fitted = _fitted(classes)
    if fitted is None:
        return spark.createDataFrame([], RESULT)
    rows = staged(placed(classes, *fitted), "placed")
    index = index_of(rows, *fitted)
    anchors = known.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("anchor_id"), "_label", "_vec"
    )

    def one(value: int) -> Column:
        return F.array(F.lit(value).cast("long"))

    queries = staged(
        anchors.select(
            "*",
            one(0).alias("_w"),
            one(-FAR).alias("_low"),
            one(FAR).alias("_high"),
            one(-FAR).alias("_floor"),
        ),
        "anchors",
    )
    near = staged(
        search(rows, index, queries, positives, True).select(
            "anchor_id",
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    # positives of one score share a window, which their score names
    low = F.expr("(3 * w + pmod(-3 * w, 10L)) div 10")
    high = F.expr("(9 * w - pmod(9 * w, 10L)) div 10")
    windows = (
        near.select("anchor_id", F.col("positive_score").alias("w"))
        .distinct()
        .select("anchor_id", "w", low.alias("low"), high.alias("high"))
        .where("low <= high")
        .groupBy("anchor_id")
        .agg(F.sort_array(F.collect_list(F.struct("w", "low", "high"))).alias("x"))
        .select(
            "anchor_id",
            F.col("x.w").alias("_w"),
            F.col("x.low").alias("_low"),
            F.col("x.high").alias("_high"),
            F.col("x.low").alias("_floor"),
        )
    )
    asked = staged(anchors.join(windows, "anchor_id"), "windows")
    hard = search(rows, index, asked, negatives, False).select(
        "anchor_id",
        F.col("_w").alias("positive_score"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return near.join(hard, ["anchor_id", "positive_score"]).select(
        *RESULT.fieldNames()
    )
