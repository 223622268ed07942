"""Nearest neighbours by multiprobe p-stable hashing.

A table cuts a few Gaussian projections of the unit vectors into cells; a
bucket is a combination of cells. A query visits its own bucket and then
those that differ by one cell in some projections, in the order of their
estimated chance to hold a neighbour: small steps over near borders first.
Buckets are kept in blocks of bounded size that Spark groups, each with a
bounded part of its queries; a block gives each query only its best candidates,
so no pair is ever a row. How many
buckets are visited is fitted on a bounded sample, for a target recall.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructType

from proclivity.llm.common import schema, staged

FUNCTIONS = 8
TABLES = 6
WIDTH = 2.5
SEED = 20_11
#: Fewest visited buckets a table that reach TARGET on the sample are taken;
#: the last are all that one step a projection leads to.
PROBES = (1, 10, 20, 40, 80, 160, 320, 640, 1280, 2560, 3**FUNCTIONS)
TARGET = 0.97
SAMPLE = 2_000
SAMPLE_QUERIES = 100
#: Vectors of a block.
BLOCK = 20_000
#: Keys and components, together, of the queries that meet a block at a time.
ASKED = 4_000_000

DOUBLES = ArrayType(DoubleType())
INDEX = schema("_class long, _ids longs, _keys longs").add("_vec", DOUBLES)
PROBE = schema("query_id long, _keys longs")
FOUND = schema("query_id long, vec_id long, score double")
#: Products of unit vectors this close to the k-th are scored exactly.
NEAR = 1e-9


class Tables(NamedTuple):
    """Projections of all tables: a (dim, tables, functions), b alike."""

    a: np.ndarray
    b: np.ndarray

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells, and places within them (0 to 1), of unit vectors."""
        n = len(unit)
        flat = self.a.reshape(self.a.shape[0], -1)
        at = (unit @ flat).reshape(n, *self.b.shape) / WIDTH + self.b
        cell = np.floor(at)
        return cell.astype(np.int16), at - cell


@lru_cache(maxsize=4)
def tables_for(dim: int) -> Tables:
    draws = np.random.default_rng(SEED)
    return Tables(
        draws.normal(size=(dim, TABLES, FUNCTIONS)),
        draws.uniform(size=(TABLES, FUNCTIONS)),
    )


@lru_cache(maxsize=8)
def steps(most: int) -> tuple[tuple[int, ...], ...]:
    """Sets of border ranks to step over, the likeliest first.

    Rank j is the j-th nearest of a query's 2 x FUNCTIONS borders. The
    expected squared distances of uniform places order the sets; the ranks j
    and 2 x FUNCTIONS + 1 - j are the two borders of one projection and never
    go together.
    """
    m = FUNCTIONS
    low = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    high = [
        1 - i / (m + 1) + i * (i + 1) / (4 * (m + 1) * (m + 2))
        for i in range(m, 0, -1)
    ]
    cost = [0.0, *low, *high]
    out: list[tuple[int, ...]] = [()]
    heap = [(cost[1], (1,))]
    while heap and len(out) < most:
        total, ranks = heapq.heappop(heap)
        if len({min(j, 2 * m + 1 - j) for j in ranks}) == len(ranks):
            out.append(ranks)
        last = ranks[-1]
        if last < 2 * m:
            more = total + cost[last + 1]
            heapq.heappush(heap, (more, (*ranks, last + 1)))
            heapq.heappush(heap, (more - cost[last], (*ranks[:-1], last + 1)))
    return tuple(out)


@lru_cache(maxsize=8)
def _step_matrix(most: int) -> np.ndarray:
    """One row per set of steps: 1 at the ranks that it steps over."""
    sets = steps(most)
    out = np.zeros((len(sets), 2 * FUNCTIONS), np.int8)
    for i, ranks in enumerate(sets):
        out[i, [j - 1 for j in ranks]] = 1
    return out


def keys_of(cells: np.ndarray) -> list[int]:
    """A number for each row (table, cells) of cells of all tables."""
    return [
        xxhash.xxh64_intdigest(row.tobytes(), seed=t) - (1 << 63)
        for t, table in enumerate(cells)
        for row in table
    ]


def probed(cell: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    """Cells (table, probe, function) that one query visits."""
    near = np.concatenate([place, 1 - place], 1)
    rank = np.argsort(np.argsort(near, 1, kind="stable"), 1)
    over = _step_matrix(most)[:, rank].transpose(1, 0, 2)
    step = over[:, :, FUNCTIONS:] - over[:, :, :FUNCTIONS]
    return cell[:, None, :] + step.astype(np.int16)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and _vec of the rows that take part.

    Null ids, null or empty vectors, null or non-finite components, all
    zeros, and vectors of another length than most have are left out.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("embedding").cast(DOUBLES).alias("_vec"),
    ).where(
        F.col("vec_id").isNotNull()
        & F.col("_vec").isNotNull()
        & F.forall(
            "_vec",
            lambda x: x.isNotNull()
            & ~F.isnan(x)
            & (F.abs(x) < float("inf")),
        )
        & F.exists("_vec", lambda x: x != 0.0)
    )
    size = (
        rows.groupBy(F.size("_vec").alias("n"))
        .count()
        .orderBy(F.desc("count"), "n")
        .take(1)
    )
    return rows.where(F.size("_vec") == (size[0]["n"] if size else 0))


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """Equal vectors as one row: _class, _ids (the k + 1 smallest), _vec.

    A query needs no more of a class than its k smallest ids besides its own.
    The limit is applied in each task before the shuffle.
    """
    same = Window.partitionBy("_class").orderBy("vec_id")
    return (
        rows.withColumn("_class", F.xxhash64("_vec"))
        .dropDuplicates(["_class", "vec_id"])
        .withColumn("_n", F.row_number().over(same))
        .where(F.col("_n") <= k + 1)
        .groupBy("_class")
        .agg(
            F.sort_array(F.collect_list("vec_id")).alias("_ids"),
            F.min_by("_vec", "_n").alias("_vec"),
        )
    )


def fitted_probes(classes: DataFrame, k: int) -> int:
    """Buckets a table to visit, by recall on SAMPLE vectors (by hash).

    0 if no number of PROBES reaches TARGET: then no bucket is worth a visit
    and every query takes the exact scan.
    """
    picked = (
        classes.select("_class", "_vec")
        .orderBy(F.xxhash64("_class", F.lit(1)), "_class")
        .limit(SAMPLE)
        .collect()  # at most SAMPLE vectors
    )
    if len(picked) <= k + 1:
        return PROBES[-1]
    unit = unit_rows(np.array([r["_vec"] for r in picked]))
    n = min(SAMPLE_QUERIES, len(unit))
    near = unit[:n] @ unit.T
    near[np.arange(n), np.arange(n)] = -2
    best = np.argsort(-near, 1, kind="stable")[:, :k]
    cells, places = tables_for(unit.shape[1]).cells(unit)
    for most in PROBES:
        hit = 0
        for q in range(n):
            visits = probed(cells[q], places[q], most)
            for x in best[q]:
                hit += (visits == cells[x][:, None, :]).all(2).any()
        if hit >= TARGET * best.size:
            return most
    return 0


def _arrow_map(df: DataFrame, fn, fields: StructType) -> DataFrame:
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in arrow],
                    schema=arrow,
                )

    return df.mapInArrow(run, fields)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def indexed(classes: DataFrame) -> DataFrame:
    """Each class with the keys of its buckets, one a table."""

    def run(batch: pa.RecordBatch) -> dict:
        unit = unit_rows(_matrix(batch.column("_vec")))
        cells, _ = tables_for(unit.shape[1]).cells(unit)
        return {k: batch.column(k) for k in ("_class", "_ids", "_vec")} | {
            "_keys": [keys_of(c[:, None, :]) for c in cells]
        }

    return _arrow_map(classes.select("_class", "_ids", "_vec"), run, INDEX)


def probes(queries: DataFrame, most: int) -> DataFrame:
    """Each query with the keys of the buckets that it visits."""

    def run(batch: pa.RecordBatch) -> dict:
        unit = unit_rows(_matrix(batch.column("_vec")))
        cells, places = tables_for(unit.shape[1]).cells(unit)
        return {
            "query_id": batch.column("query_id"),
            "_keys": [
                keys_of(probed(c, p, most))
                for c, p in zip(cells, places, strict=True)
            ],
        }

    return _arrow_map(queries.select("query_id", "_vec"), run, PROBE)


def best_in_block(
    rows: pd.DataFrame, asked: pd.DataFrame, k: int
) -> pd.DataFrame:
    """Each query's k nearest among the buckets it visits in a block; among
    all rows of the block where queries name no buckets."""
    names = FOUND.fieldNames()
    if rows.empty or asked.empty:
        return pd.DataFrame({n: [] for n in names})
    vec = np.stack(rows["_vec"].to_numpy())
    norm = np.sqrt((vec * vec).sum(1))
    unit = vec / norm[:, None]
    members: dict[int, np.ndarray] = {}
    keys_of_asked = [None] * len(asked)
    if "_keys" in asked:
        at: dict[int, list[int]] = {}
        for i, key in enumerate(rows["_key"]):
            at.setdefault(key, []).append(i)
        members = {key: np.array(x) for key, x in at.items()}
        keys_of_asked = asked["_keys"]
    classes = rows["_class"].to_numpy()
    ids = rows["_ids"].to_numpy()
    every = np.arange(len(rows))
    out = []
    for query, keys, q in zip(
        asked["query_id"], keys_of_asked, asked["_vec"], strict=True
    ):
        found = every
        if keys is not None:
            buckets = [members[x] for x in keys if x in members]
            if not buckets:  # a part of a bucket may hold no row
                continue
            found = np.concatenate(buckets)
            # a class can be here by several tables
            _, first = np.unique(classes[found], return_index=True)
            found = found[first]
        size = np.sqrt((q * q).sum())
        near = unit[found] @ (q / size)
        # one class may be the query's own; ties with the last are kept
        most = min(k + 1, len(found))
        last = np.partition(near, len(found) - most)[len(found) - most]
        top = found[near >= last - NEAR]
        # the exact measure, added up in the same order for every pair
        score = (vec[top] * q).sum(1) / (norm[top] * size)
        nearest = sorted(
            (-float(x), int(i))
            for row, x in zip(top, score, strict=True)
            for i in ids[row]
            if i != query
        )
        out += [(query, i, -x) for x, i in nearest[:k]]
    return pd.DataFrame(out, columns=names)


def query_parts(asked: DataFrame) -> DataFrame:
    """(_block, _turns) of the blocks whose queries are beyond ASKED."""
    size = F.size("_keys") + F.size("_vec")
    return (
        asked.groupBy("_block")
        .agg(F.ceil(F.sum(size) / ASKED).alias("_turns"))
        .where("_turns > 1")
    )


def _turns() -> Column:
    return F.coalesce("_turns", F.lit(1).cast("long"))


def nearest(
    vectors: DataFrame, every: int = 50, k: int = 5
) -> DataFrame:
    """The k nearest found of each query: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by `every`; candidates are
    all rows with another vec_id; a query that meets fewer than k of them in
    its buckets is compared with all. The measure is the cosine, in double
    precision on the original vectors; ties go to the smaller vec_id. Rows
    that `usable` leaves out take no part; repeated rows count once; other
    columns are ignored; an empty table gives no rows.
    """
    rows = usable(vectors)
    classes = staged(classes_of(rows, k), "classes")
    # a query's vector is the smallest where its id is repeated
    queries = staged(
        rows.where(F.col("vec_id") % every == 0)
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min("_vec").alias("_vec")),
        "queries",
    )
    most = fitted_probes(classes, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def first_of(found: DataFrame) -> DataFrame:
        return (
            found.groupBy("query_id", "vec_id")
            .agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score")
        )

    if not most:
        return first_of(scanned(classes, queries, k))
    near = staged(first_of(probed_rows(classes, queries, most, k)), "near")
    # too few met: all other vectors are candidates, in exact blocks
    ids = classes.select(F.explode("_ids").alias("vec_id"))
    wanted = min(k, ids.distinct().limit(k + 1).count() - 1)
    met = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
    lacking = staged(
        queries.join(met, "query_id", "left")
        .where(F.coalesce("_n", F.lit(0)) < wanted)
        .select("query_id", "_vec"),
        "lacking",
    )
    if lacking.isEmpty():
        return near
    return near.join(lacking, "query_id", "left_anti").union(
        first_of(scanned(classes, lacking, k))
    )


def scanned(classes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k nearest of a few queries in each block of all vectors.

    Every query meets every block, in bounded parts; a block gives k rows a
    query. For queries that the buckets leave short.
    """
    blocks = max(1, -(-classes.count() // BLOCK))
    components = queries.agg(F.sum(F.size("_vec"))).first()[0] or 0
    turns = max(1, -(-components // ASKED))
    index = classes.withColumn(
        "_block", F.pmod(F.xxhash64("_class"), F.lit(blocks))
    ).withColumn("_turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    asked = queries.withColumn(
        "_turn", F.pmod(F.xxhash64("query_id"), F.lit(turns)).cast("int")
    ).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return _met(
        index.select(
            F.col("_block").cast("long"), "_turn", "_class", "_ids", "_vec"
        ),
        asked.select(F.col("_block").cast("long"), "_turn", "query_id", "_vec"),
        k,
    )


def _met(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return best_in_block(left, right, k)

    return (
        index.groupBy("_block", "_turn")
        .cogroup(asked.groupBy("_block", "_turn"))
        .applyInPandas(best, FOUND)
    )


def probed_rows(
    classes: DataFrame, queries: DataFrame, most: int, k: int
) -> DataFrame:
    """The k nearest of each query in each block of buckets that it visits."""
    n = classes.count()
    blocks = max(1, -(-n * TABLES // BLOCK))
    index = indexed(classes).select(
        "_class", "_ids", "_vec", F.explode("_keys").alias("_key")
    )
    # buckets beyond a block are dealt over several
    sizes = staged(
        indexed(classes)
        .select(F.explode("_keys").alias("_key"))
        .groupBy("_key")
        .agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_parts")),
        "buckets",
    )
    large = sizes.where("_parts > 1")

    def block(part: Column) -> Column:
        return F.pmod(F.xxhash64("_key", part), F.lit(blocks))

    placed = index.join(large, "_key", "left").withColumn(
        "_block",
        block(F.pmod(F.col("_class"), F.coalesce("_parts", F.lit(1).cast("long")))),
    )
    visits = staged(
        probes(queries, most)
        .select("query_id", F.explode("_keys").alias("_key"))
        .join(sizes, "_key")
        .select(
            "query_id",
            "_key",
            F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_p"),
        )
        .withColumn("_block", block(F.col("_p").cast("long")))
        .groupBy("query_id", "_block")
        .agg(F.collect_set("_key").alias("_keys")),
        "visits",
    )
    asked = visits.join(queries, "query_id")
    # a block with many queries meets them in parts, by the query
    turns = staged(query_parts(asked), "turns")
    asked = (
        asked.join(turns, "_block", "left")
        .withColumn(
            "_turn", F.pmod(F.xxhash64("query_id", F.lit(5)), _turns())
        )
        .select("_block", "_turn", "query_id", "_keys", "_vec")
    )
    placed = placed.join(turns, "_block", "left").withColumn(
        "_turn", F.explode(F.sequence(F.lit(0).cast("long"), _turns() - 1))
    )

    return _met(
        placed.select("_block", "_turn", "_class", "_ids", "_vec", "_key"),
        asked,
        k,
    )
