"""Levels and means as tables: fitted once, joined at transform.

A fitted `Lookup` owns a table (value, code) in Parquet. Transforming is a
left join with it: Spark sends a small table to all tasks by its known size
and deals a large one by value, where adaptive execution splits hot values. No
level passes the driver, so a column may have as many levels as rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import (
    HasInputCol,
    HasOutputCol,
    Param,
    Params,
    TypeConverters,
)
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proclivity.functions.scalar import hash_key, str_key
from proclivity.presets import SEED
from proclivity.session import staged

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
REAL = (T.FloatType, T.DoubleType)


class Lookup(
    Transformer, HasInputCol, HasOutputCol, MLReadable, MLWritable
):
    """Replaces a column's values by their codes in a stored table.

    `miss` is SQL for values that the table lacks, null included. `size`, if
    not negative, names the number of categories for tree learners. `as_key`
    looks the text form of a value up, in which null is a key of its own.
    """

    miss = Param(Params._dummy(), "miss", "SQL", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "levels", TypeConverters.toInt)
    as_key = Param(
        Params._dummy(), "as_key", "by text", TypeConverters.toBoolean
    )

    @keyword_only
    def __init__(
        self, *, inputCol=None, outputCol=None, miss="NULL", size=-1,
        as_key=False, table=None,
    ):
        """Keep the settings and the table (value, code)."""
        super().__init__()
        self._setDefault(miss="NULL", size=-1, as_key=False)
        self.table = table
        given = dict(self._input_kwargs)
        given.pop("table", None)
        self._set(**given)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        source, out = self.getInputCol(), self.getOutputCol()
        known = self.table.select(
            F.col("value").alias("__value"), F.col("code").alias("__code")
        )
        key = F.col(f"`{source}`")
        if self.getOrDefault(self.as_key):
            key = str_key(source)
        found = F.coalesce("__code", F.expr(self.getOrDefault(self.miss)))
        size = self.getOrDefault(self.size)
        if size >= 0:
            kind = {"type": "nominal", "num_vals": size, "name": out}
            found = found.cast("double")
            column = found.alias(out, metadata={"ml_attr": kind})
        else:
            column = found.alias(out)
        kept = [c for c in dataset.columns if c != out]
        return dataset.join(known, key == F.col("__value"), "left").select(
            *[F.col(f"`{c}`") for c in kept], column
        )

    def copy(self, extra=None):
        """Copy with the same table."""
        that = super().copy(extra)
        that.table = self.table
        return that

    def write(self) -> MLWriter:
        """Writer of settings and table."""
        return LookupWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        """Reader of settings and table."""
        return LookupReader(cls)


class LookupWriter(MLWriter):
    """Settings as metadata, the table beside them."""

    def __init__(self, lookup: Lookup):
        """Keep what is written."""
        super().__init__()
        self.lookup = lookup

    def saveImpl(self, path: str) -> None:
        """Write both."""
        DefaultParamsWriter.saveMetadata(self.lookup, path, self.sparkSession)
        self.lookup.table.write.parquet(f"{path}/table")


class LookupReader(MLReader):
    """Reads what `LookupWriter` wrote."""

    def __init__(self, kind: type):
        """Keep the class."""
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> Lookup:
        """Read settings and table."""
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        lookup = self.kind(
            table=self.sparkSession.read.parquet(f"{path}/table")
        )
        lookup._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(lookup, meta)
        return lookup


def _cell(df: DataFrame, column: str, at: int) -> Column:
    """A value as a struct that sorts like the column, for any type."""
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    none = F.lit(None)
    whole, real = isinstance(kind, WHOLE), isinstance(kind, REAL)
    exact = isinstance(kind, T.DecimalType)
    return F.struct(
        F.lit(at).alias("at"),
        value.isNull().alias("gone"),
        (value if whole else none).cast("bigint").alias("l"),
        (value if exact else none).cast("decimal(38,18)").alias("e"),
        (value if real else none).cast("double").alias("d"),
        (none if whole or real or exact else value).cast("string").alias("s"),
    )


def fit_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(at, gone, l, e, d, s, code) of all distinct values of the columns.

    `at` numbers the columns; codes count each column's values in their own
    order (numbers by size) from 0. Null has no level. One distinct for all
    columns; the values are sorted in range partitions, stored with their
    partition's number, whose sizes by column give the offsets.
    """
    cells = F.array(*[_cell(df, c, i) for i, c in enumerate(columns)])
    order = ["at", "l", "e", "d", "s"]
    placed = staged(
        df.select(F.inline(cells))
        .where("NOT gone")
        .distinct()
        .repartitionByRange(*order)
        .withColumn("__part", F.spark_partition_id())
    )
    ahead = Window.partitionBy("at").orderBy("__part")
    offsets = (
        placed.groupBy("at", "__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn(
            "__offset",
            F.coalesce(
                F.sum("__n").over(
                    ahead.rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("__n")
    )
    inside = Window.partitionBy("at", "__part").orderBy(*order)
    return staged(
        placed.join(offsets, ["at", "__part"])
        .withColumn(
            "code",
            (F.col("__offset") + F.row_number().over(inside) - 1).cast("int"),
        )
        .drop("__part", "__offset")
    )


def _value(df: DataFrame, column: str) -> Column:
    """The struct's value in the column's own type."""
    kind = df.schema[column].dataType
    if isinstance(kind, WHOLE):
        return F.col("l").cast(kind)
    if isinstance(kind, REAL):
        return F.col("d").cast(kind)
    if isinstance(kind, T.DecimalType):
        return F.col("e").cast(kind)
    return F.col("s").cast(kind)


def level_lookups(
    df: DataFrame,
    columns: dict[str, str],
    miss: dict[str, str] | None = None,
    for_trees: bool = False,
) -> list[Lookup]:
    """A lookup per column (name -> output), all fitted by `fit_levels`.

    `miss` gives SQL for unknown values, by column; without it they become
    null. For tree learners they are one level more, the last.
    """
    if not columns:
        return []
    levels = fit_levels(df, list(columns))
    sizes = {}
    if for_trees:
        rows = levels.groupBy("at").count().collect()  # a row a column
        sizes = {r["at"]: r["count"] for r in rows}
    out = []
    for i, (c, name) in enumerate(columns.items()):
        table = levels.where(F.col("at") == i).select(
            _value(df, c).alias("value"), "code"
        )
        settings = {"miss": (miss or {}).get(c, "NULL")}
        if for_trees:
            n = sizes.get(i, 0)
            settings = {"miss": str(n), "size": n + 1}
        out.append(
            Lookup(inputCol=c, outputCol=name, table=table, **settings)
        )
    return out


def mean_lookups(
    df: DataFrame, columns: dict[str, str], target: str, weight: float = 1.0
) -> list[Lookup]:
    """Lookups of each category's mean target, pulled to the overall mean.

    One grouped pass for all columns; the table is written once. Categories
    that training has not seen get the overall mean. Rows that the means are
    made of must not be trained on with them: see `ordered_means`.
    """
    if not columns:
        return []
    y = F.col(target).cast("double")
    prior = df.agg(F.avg(y).alias("m")).first()["m"] or 0.0
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("at"), str_key(c).alias("value"))
            for i, c in enumerate(columns)
        ]
    )
    means = staged(
        df.select(F.inline(cells), y.alias("y"))
        .groupBy("at", "value")
        .agg(
            (
                (F.coalesce(F.sum("y"), F.lit(0.0)) + prior * weight)
                / (F.count(F.lit(1)) + weight)
            ).alias("code")
        )
    )
    return [
        Lookup(
            inputCol=c,
            outputCol=out,
            miss=f"{float(prior)!r}D",
            as_key=True,
            table=means.where(F.col("at") == i).select("value", "code"),
        )
        for i, (c, out) in enumerate(columns.items())
    ]


#: Rows of one category that are ordered in one task, about.
ORDERED_ROWS = 50_000


def ordered_means(
    df: DataFrame,
    columns: dict[str, str],
    target: str,
    key: Sequence[str],
    weight: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """Adds each category's mean target over the rows before the row.

    Rows are ordered by a hash of `key`; the mean of nothing is the overall
    mean. So no row's label, nor a later one's, is in its own features. The
    order is cut into ranges of the hash with about ORDERED_ROWS rows: sums
    per (category, range) give what lies in earlier ranges, and only rows of
    one category and range are ordered together, so a category that holds a
    third of all rows is dealt over as many tasks as there are ranges. All
    columns go through one window and come back by one grouping; rows whose
    keys repeat are kept apart. A row's place in this order is one number, so
    that its hash is shuffled once, not for each column.
    """
    if not columns:
        return df
    y = F.col(target).cast("double")
    n, prior = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.avg(y), F.lit(0.0))
    ).first()
    ranges = -(-n // ORDERED_ROWS) or 1
    if len(key) == 1:
        place = F.coalesce(hash_key(key[0], seed), F.md5(F.lit("")))
    else:
        place = F.md5(F.concat_ws("\u0001", *map(str_key, key), F.lit(seed)))
    # md5 is even: its first 32 bits deal the ranges
    part = F.conv(F.substring("__place", 1, 8), 16, 10).cast("double")
    within = Window.partitionBy("__range").orderBy("__place", "__id")
    rows = staged(
        df.withColumn("__id", F.monotonically_increasing_id())
        .withColumn("__place", place)
        .withColumn("__range", F.floor(part / float(1 << 32) * ranges))
        .withColumn(
            "__row",
            F.shiftleft("__range", 32) + F.row_number().over(within),
        )
        .drop("__id", "__place", "__range")
    )
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("at"), str_key(c).alias("value"))
            for i, c in enumerate(columns)
        ]
    )
    long = rows.select(
        "__row",
        F.shiftright("__row", 32).alias("__range"),
        F.inline(cells),
        y.alias("y"),
    )
    cell = ["at", "value", "__range"]
    before = Window.partitionBy("at", "value").orderBy("__range")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        long.groupBy(*cell)
        .agg(F.sum("y").alias("__s"), F.count("y").alias("__n"))
        .select(
            *cell,
            F.sum("__s").over(before).alias("__es"),
            F.sum("__n").over(before).alias("__en"),
        )
    )
    inside = Window.partitionBy(*cell).orderBy("__row")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    mean = (
        F.coalesce(F.sum("y").over(inside), zero)
        + F.coalesce("__es", zero)
        + prior * weight
    ) / (
        F.coalesce(F.count("y").over(inside), F.lit(0))
        + F.coalesce("__en", F.lit(0))
        + weight
    )
    wide = (
        long.join(earlier, cell)
        .select("__row", "at", mean.alias("m"))
        .groupBy("__row")
        .agg(
            *[
                F.max(F.when(F.col("at") == i, F.col("m"))).alias(out)
                for i, out in enumerate(columns.values())
            ]
        )
    )
    return rows.join(wide, "__row").drop("__row")
