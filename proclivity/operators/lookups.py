"""Lookups that join a table with learned statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.scalar import step_index, str_key
from proclivity.functions.tables import settle


def lookup_default(
    df: DataFrame,
    column: str,
    table: DataFrame,
    value: str,
    default: DataFrame,
    out: str,
) -> DataFrame:
    """Left join a category table; a miss gets the default.

    `table` has the columns `category` and `value`; `default` is a one-row
    table with the column `value`. Only categories above a share threshold are
    stored, so the table cannot have more than 1 / threshold rows.
    """
    fallback = default.select(value).scalar()
    small = settle(
        table.select(
            F.col("category").alias("__category"),
            F.col(value).alias("__value"),
        )
    )
    joined = df.join(small, str_key(column) == F.col("__category"), "left")
    return joined.withColumn(out, F.coalesce("__value", fallback)).drop(
        "__category", "__value"
    )


def outer_shares(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Full outer join of two share tables; a missing side counts as 0."""
    e = expected.select(*keys, F.col("share").alias("expected"))
    a = actual.select(*keys, F.col("share").alias("actual"))
    return e.join(a, list(keys), "full_outer").select(
        *keys,
        F.coalesce("expected", F.lit(0.0)).alias("expected"),
        F.coalesce("actual", F.lit(0.0)).alias("actual"),
    )


def slice_delta(champion: DataFrame, challenger: DataFrame) -> DataFrame:
    """AUC drop of the challenger on the slices both models have."""
    keys = ["slice_col", "slice_value"]
    old = champion.select(*keys, F.col("roc_auc").alias("champion_auc"))
    new = challenger.select(*keys, F.col("roc_auc").alias("challenger_auc"))
    return old.join(new, keys).withColumn(
        "drop", F.col("champion_auc") - F.col("challenger_auc")
    )


def unseen_categories(
    fitted: DataFrame, new: DataFrame, column: str
) -> DataFrame:
    """Categories of the new table that the fitted table does not have."""
    known = fitted.select(column).distinct()
    counts = (
        new.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counts.join(known, column, "left_anti")


def bin_lookup(
    df: DataFrame, column: str, cuts: Sequence[float], out: str
) -> DataFrame:
    """Bin number = cut points `<= value`; a missing value is in the last."""
    return df.withColumn(out, step_index(column, list(cuts)))


def map_back_share(df: DataFrame, column: str, out: str) -> DataFrame:
    """Attach to every row the share (in %) of its own category.

    A small share table is a local relation and is broadcast; a large one is
    joined by shuffle, where adaptive execution splits hot categories.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = settle(
        df.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    )
    shares = counts.select(
        F.col(column), (F.col("__n") * 100.0 / total).alias(out)
    )
    return df.join(shares, column, "left")
