"""Descriptions of a table: shares, histograms, moments, conversion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proclivity.functions.exact import exact_quantiles
from proclivity.functions.scalar import equal_width_bin, str_key
from proclivity.functions.tables import local_table
from proclivity.operators.validate import missing, unpivot_counts


def value_counts_share(
    df: DataFrame, column: str, percent: bool = False
) -> DataFrame:
    """Rows and share of every value."""
    total = df.agg(F.count(F.lit(1))).scalar()
    scale = 100.0 if percent else 1.0
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("share", F.col("n_rows") * scale / total)
    )


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Share of every target value in percent."""
    return value_counts_share(df, target, percent=True)


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values of every column, from one pass."""
    one = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in df.columns])
    return unpivot_counts(one, df.columns, "n_missing")


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows beyond the first of every distinct content."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates")
    )


def describe_all(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """Count, unique, top, freq, mean, std, min, quartiles, max per column."""
    parts = []
    if numeric:
        parts.append(_describe_numeric(df, numeric))
    if categorical:
        parts.append(_describe_categorical(df, categorical))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    order = [
        "column",
        "n",
        "n_unique",
        "top",
        "freq",
        "mean",
        "std",
        "min",
        "q25",
        "q50",
        "q75",
        "max",
    ]
    for c in order:
        if c not in out.columns:
            kind = (
                "string"
                if c == "top"
                else "bigint" if c in ("n_unique", "freq") else "double"
            )
            out = out.withColumn(c, F.lit(None).cast(kind))
    return out.select(*order)


def _describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    stats = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        stats += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
    one = df.agg(*stats)
    rows = []
    for i, c in enumerate(columns):
        q = [F.lit(v).cast("double") for v in quartiles[c]]
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("n"),
                F.col(f"mean{i}").alias("mean"),
                F.col(f"std{i}").alias("std"),
                F.col(f"min{i}").alias("min"),
                q[0].alias("q25"),
                q[1].alias("q50"),
                q[2].alias("q75"),
                F.col(f"max{i}").alias("max"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def _long(df: DataFrame, columns: Sequence[str], key) -> DataFrame:
    """One row per (column, value) of every row."""
    return df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"), key(c).alias("value")
                    )
                    for c in columns
                ]
            )
        )
    )


def _describe_categorical(
    df: DataFrame, columns: Sequence[str]
) -> DataFrame:
    values = _long(df, columns, lambda c: F.col(c).cast("string")).filter(
        F.col("value").isNotNull()
    )
    counts = values.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    # most frequent value; the first one in text order wins a tie
    rarest = F.struct((-F.col("n")).alias("m"), F.col("value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("n_"),
        F.count(F.lit(1)).alias("n_unique"),
        F.min_by("value", rarest).alias("top"),
        F.max("n").alias("freq"),
    ).withColumnRenamed("n_", "n")


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order."""
    return df.select(column).distinct().orderBy(column)


def value_frequency(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Number of rows equal to a suspicious value."""
    return df.agg(F.count_if(F.col(column) == F.lit(value)).alias("n_rows"))


def pct_histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram in percent of all rows; empty bins included."""
    x = F.col(column).cast("double")
    ends = df.agg(
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(F.lit(1)).alias("n")
    )
    low = ends.select("lo").scalar()
    high = ends.select("hi").scalar()
    total = ends.select("n").scalar()
    counts = (
        df.select(equal_width_bin(x, low, high, bins).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    grid = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin")
    )
    n = F.coalesce("n_rows", F.lit(0))
    return grid.join(counts, "bin", "left").select(
        "bin", n.alias("n_rows"), (n * 100.0 / total).alias("pct")
    )


def crosstab_row_share(
    df: DataFrame, column: str, target: str, classes: Sequence[Any] = (0, 1)
) -> DataFrame:
    """Share of each target class within every category."""
    table = df.groupBy(column).pivot(target, list(classes)).count()
    total = sum(
        (F.coalesce(F.col(f"`{k}`"), F.lit(0)) for k in classes), F.lit(0)
    )
    return table.select(
        column,
        *[
            (F.coalesce(F.col(f"`{k}`"), F.lit(0)) / total).alias(
                f"share_{k}"
            )
            for k in classes
        ],
    )


def group_conversion(
    df: DataFrame, column: str, target: str
) -> DataFrame:
    """Conversion and size by the share a category has in the table.

    Categories with an equal share fall into one group. Two aggregations; the
    rows are not joined back.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    per_category = df.groupBy(column).agg(
        F.count(F.lit(1)).alias("n"), F.sum(target).alias("pos")
    )
    return (
        per_category.groupBy("n")
        .agg(F.sum("n").alias("size"), F.sum("pos").alias("pos"))
        .select(
            (F.col("n") * 100.0 / total).alias("share_pct"),
            (F.col("pos") / F.col("size")).alias("conversion"),
            F.col("size"),
        )
    )


def rare_to_other(
    df: DataFrame,
    column: str,
    target: str,
    min_share: float = 0.01,
    other: str = "Other",
) -> DataFrame:
    """Merge categories with a share up to `min_share`, then conversion.

    Computed from the category counts; a row-level merged column is
    `merge_rare`.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    per_category = df.groupBy(str_key(column).alias("category")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(target).alias("pos")
    )
    merged = per_category.withColumn(
        "category",
        F.when(F.col("n") / total > min_share, F.col("category")).otherwise(
            F.lit(other)
        ),
    )
    return merged.groupBy("category").agg(
        F.sum("n").alias("n_rows"),
        (F.sum("n") / total).alias("share"),
        (F.sum("pos") / F.sum("n")).alias("conversion"),
    )


def pearson_with_target(
    df: DataFrame, columns: Sequence[str], target: str
) -> DataFrame:
    """Linear correlation of each column with the target, in one pass."""
    y = F.col(target).cast("double")
    one = df.agg(
        *[F.corr(F.col(c).cast("double"), y).alias(c) for c in columns]
    )
    return unpivot_counts(one, columns, "correlation")


def quantile_cuts(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = tuple(i / 10 for i in range(1, 10)),
) -> dict[str, list[float]]:
    """Exact inner deciles per column, equal cut points only once."""
    found = exact_quantiles(df, {c: list(probs) for c in columns})
    return {
        c: sorted({v for v in values if v is not None})
        for c, values in found.items()
    }


def cuts_table(df: DataFrame, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """Cut points as a table (feature, cut_no, cut)."""
    rows = [
        (c, i, float(v))
        for c, values in cuts.items()
        for i, v in enumerate(values)
    ]
    return local_table(
        df.sparkSession, rows, "feature string, cut_no int, cut double"
    )


def robust_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median and interquartile range per column."""
    found = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    rows = [
        (c, q[1], None if q[0] is None else q[2] - q[0])
        for c, q in found.items()
    ]
    return local_table(
        df.sparkSession, rows, "column string, median double, iqr double"
    )


def moments_population(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per column, in one pass."""
    one = df.agg(
        *[
            F.struct(
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_pop(F.col(c).cast("double")).alias("std"),
            ).alias(c)
            for c in columns
        ]
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(c)["mean"].alias("mean"),
                        F.col(c)["std"].alias("std"),
                    )
                    for c in columns
                ]
            )
        )
    )


def grouping_rates(
    df: DataFrame, columns: Sequence[str], target: str
) -> DataFrame:
    """Rows and positives for several groupings in one pass."""
    long = df.select(
        F.col(target).alias("__y"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("slice_col"),
                        str_key(c).alias("slice_value"),
                    )
                    for c in columns
                ]
            )
        ),
    )
    return long.groupBy("slice_col", "slice_value").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("__y").cast("long").alias("n_positive"),
    )


def near_duplicates(
    df: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Rows that differ from another row in exactly one of the columns.

    For every column: group on all the others and keep groups with at least
    two values of the left-out column. A first pass groups on 8-byte hashes,
    which shuffles little and drops most rows; the candidates are then
    grouped on the real values, so hash collisions cannot count. Equal rows
    collapse before anything is multiplied.
    """
    columns = list(columns)
    distinct = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    keys = [
        F.struct(
            F.lit(i).alias("left_out"),
            F.xxhash64(
                F.lit(i), *[str_key(c) for c in columns if c != col]
            ).alias("h"),
            str_key(col).alias("v"),
        )
        for i, col in enumerate(columns)
    ]
    hashed = distinct.select("__n", *columns, F.inline(F.array(*keys)))
    candidates = (
        hashed.groupBy("left_out", "h")
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        .filter(F.col("lo") != F.col("hi"))
        .select("left_out", "h")
    )
    suspect = hashed.join(candidates, ["left_out", "h"], "left_semi")
    others = [
        F.when(F.col("left_out") != i, str_key(c)).alias(f"o{i}")
        for i, c in enumerate(columns)
    ]
    groups = (
        suspect.groupBy("left_out", *others)
        .agg(
            F.sum("__n").alias("n"),
            F.min("v").alias("lo"),
            F.max("v").alias("hi"),
        )
        .filter(F.col("lo") != F.col("hi"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    return (
        groups.groupBy("left_out")
        .agg(
            F.count(F.lit(1)).alias("n_groups"),
            F.sum("n").alias("n_rows"),
        )
        .select(
            F.element_at(names, F.col("left_out") + 1).alias("column"),
            "n_groups",
            "n_rows",
        )
    )


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
    )


def first_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first n rows in key order: rows of a distributed table have no
    other first ones."""
    return df.orderBy(key).limit(n)
