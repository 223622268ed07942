"""Reading, staging and Arrow helpers of the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

from proclivity.session import shared_folder

#: Spark's own setting: free a query's shuffle files when it has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

KINDS = {
    "long": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
    "binary": BinaryType(),
    "boolean": BooleanType(),
    "longs": ArrayType(LongType()),
    "ints": ArrayType(IntegerType()),
}


def schema(fields: str) -> StructType:
    """A schema from "name kind, name kind"; needs no session."""
    out = StructType()
    for field in fields.split(","):
        name, kind = field.split()
        out = out.add(name, KINDS[kind])
    return out


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; none for null.

    bytes.split() without arguments cuts at exactly 0x20 and 0x09-0x0D.
    """
    return text.encode().split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "staged") -> DataFrame:
    """Write a table once to the shared folder and read it back.

    Later passes don't repeat the work before it, and a lost executor loses
    nothing of it. The shuffle files of that work are freed at its end.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, label)
    with freeing(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Actions inside free their shuffle files at their end."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


#: Rows of 64 bits that a mask has at most: some megabytes in each task.
MASK_ROWS = 1 << 18


def mask_of(wanted: DataFrame, key: str) -> DataFrame:
    """A table of bits, one for each hash that a key of `wanted` has."""
    hashed = F.xxhash64(key)
    bit = F.expr(f"shiftleft(1L, int(shiftrightunsigned(xxhash64({key}), 40) & 63))")
    return staged(
        wanted.select(F.pmod(hashed, F.lit(MASK_ROWS)).alias("_cell"), bit.alias("_bit"))
        .groupBy("_cell")
        .agg(F.bit_or("_bit").alias("_bits")),
        "mask",
    )


def among(
    rows: DataFrame, key: str, mask: DataFrame, how: str = "left_semi"
) -> DataFrame:
    """Rows whose key is among the mask's, and few others: wide rows that a
    join would drop are not shuffled for it. `left_anti` gives the rest.

    The mask is sent to all tasks, as its size is bounded by MASK_ROWS. If it
    is nearly full, more other rows stay, which the join after it drops.
    """
    here = F.pmod(F.xxhash64(key), F.lit(MASK_ROWS)) == F.col("_cell")
    bit = F.expr(
        f"shiftright(_bits, int(shiftrightunsigned(xxhash64({key}), 40) & 63)) & 1 = 1"
    )
    return rows.join(F.broadcast(mask), here & bit, how)


_AT_WORK: list[Callable] = []


def sole(load: Callable, *args: object) -> object:
    """What the cached function `load` gives for these arguments.

    A Python worker is used again by later operators. It forgets the model and
    memos that another loader keeps, so that it holds those of one operator.
    """
    if _AT_WORK != [load]:
        for other in _AT_WORK:
            other.cache_clear()
        _AT_WORK[:] = [load]
    return load(*args)


def map_batches(
    df: DataFrame,
    fn: Callable[[dict[str, list]], dict[str, list]],
    fields: StructType,
    carry: str | None = None,
) -> DataFrame:
    """Map Arrow batches given as a list per column.

    The column `carry`, if named, goes along untouched beside the others.

    Spark bounds a batch by spark.sql.execution.arrow.maxRecordsPerBatch and
    maxBytesPerBatch, so a task never holds more than that of its input.
    """
    if carry:
        fields = StructType([*fields.fields, df.schema[carry]])
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != carry]
            out = fn(batch.select(names).to_pydict())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(carry).cast(f.type)
                    if f.name == carry
                    else pa.array(out[f.name], f.type)
                    for f in arrow
                ],
                schema=arrow,
            )

    return df.mapInArrow(run, fields)


def map_groups(
    df: DataFrame,
    key: str,
    fn: Callable[[dict[str, list]], dict[str, list]],
    fields: StructType,
) -> DataFrame:
    """Map whole groups of rows with one key, as a list per column.

    For many small groups: a task streams its sorted rows and holds one batch
    and one group. The caller bounds the size of a group.
    """
    arrow = to_arrow_schema(fields)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1)]
            for start, stop in zip(cuts, [*cuts[1:], len(keys)], strict=True):
                if held and held[-1].column(key)[0].as_py() != keys[start]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(start, stop - start))
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, list] = {n: [] for n in arrow.names}
        for group in groups(batches):
            out = fn(group.to_pydict())
            for n in arrow.names:
                ready[n].extend(out[n])
            if len(ready[arrow.names[0]]) >= 5_000:
                yield pa.RecordBatch.from_pydict(ready, schema=arrow)
                ready = {n: [] for n in arrow.names}
        yield pa.RecordBatch.from_pydict(ready, schema=arrow)

    dealt = df.repartition(key).sortWithinPartitions(key)
    return dealt.mapInArrow(run, fields)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (u, v): a row (node, root) for each node.

    Alternates two contractions until all components are stars: larger
    neighbours move to its least neighbour, then its smaller ones do. Rounds
    are written to the shared folder.
    """
    flat = edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    now = staged(flat.where("u > v").distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        below = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        )
        low = below.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            below.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
        )
        now = staged(small.where("u > v").distinct(), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none downwards."""
    ends = edges.select("u", F.lit(1).alias("down"), F.lit(0).alias("root"))
    ends = ends.union(
        edges.select("v", F.lit(0).alias("down"), F.lit(1).alias("root"))
    )
    kinds = ends.groupBy("u").agg(
        F.sum("down").alias("down"), F.max("root").alias("root")
    )
    with freeing(edges.sparkSession):
        return kinds.where("down > 1 OR (down = 1 AND root = 1)").isEmpty()
