"""Samples, splits and folds with exact class sizes.

The order behind every selection is the md5 of the key and a seed. A selection
is a handful of cut keys per class: finding them shuffles only counts, and
applying them is a comparison per row, so the table itself is never sorted or
moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.exact import rank_part, ranks_table, stratum_counts
from proclivity.functions.tables import local_table
from proclivity.spec import TableSpec


def stratified_sample(
    df: DataFrame,
    id_col: str,
    target: str,
    frac: float,
    seed: int = 42,
    exact: bool = True,
) -> DataFrame:
    """Exactly `round(frac * n)` rows of every class (halves to even).

    `exact=False` keeps each row with probability `frac`: one pass, class
    sizes only approximate.
    """
    if frac >= 1.0:
        return df
    if not exact:
        return df.sample(fraction=frac, seed=seed)
    counts, largest = stratum_counts(df, [target])
    ranks = ranks_table(counts, {0: F.bround(F.lit(frac) * F.col("__n"))})
    parts = rank_part(df, id_col, [target], ranks, "__part", seed, largest)
    return parts.filter(F.col("__part") == 0).drop("__part")


def class_quota(counts: DataFrame, size: Column, n: Column) -> DataFrame:
    """Share `size` rows among classes by largest remainder, as `__quota`.

    `n` is the class size column. The windows run over the class table.
    """
    everything = Window.partitionBy()
    by_rest = everything.orderBy(F.col("__rest").desc(), *_strata(counts))
    total = F.sum(n).over(everything)
    shares = (
        counts.withColumn("__size", size)
        .withColumn("__ideal", n * F.col("__size") / total)
        .withColumn("__base", F.floor("__ideal").cast("long"))
        .withColumn("__rest", F.col("__ideal") - F.col("__base"))
        .withColumn(
            "__open",
            F.col("__size") - F.sum("__base").over(everything),
        )
        .withColumn("__place", F.row_number().over(by_rest))
    )
    return shares.withColumn(
        "__quota",
        F.col("__base")
        + F.when(F.col("__place") <= F.col("__open"), 1).otherwise(0),
    ).drop("__size", "__ideal", "__base", "__rest", "__open", "__place")


def _strata(counts: DataFrame) -> list[str]:
    return [c for c in counts.columns if not c.startswith("__")]


def _quota_of(counts: DataFrame, frac: float, n: str, out: str) -> DataFrame:
    total = F.sum(n).over(Window.partitionBy())
    size = F.ceil(F.lit(frac) * total).cast("long")
    return class_quota(counts, size, F.col(n)).withColumnRenamed(
        "__quota", out
    )


def stratified_split(
    df: DataFrame,
    id_col: str,
    target: str,
    test_size: float = 0.25,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Add `split`: `ceil(test_size * n)` test rows, shared by largest rest."""
    sizes, largest = stratum_counts(df, [target])
    counts = _quota_of(sizes, test_size, "__n", "__test")
    ranks = ranks_table(counts, {0: F.col("__test")})
    parts = rank_part(df, id_col, [target], ranks, "__part", seed, largest)
    return parts.withColumn(
        out, F.when(F.col("__part") == 0, "test").otherwise("train")
    ).drop("__part")


def train_val_test_split(
    df: DataFrame,
    id_col: str,
    target: str,
    test_size: float = 0.25,
    val_size: float = 0.03,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Test part first, then `val_size` of the rest as a validation part.

    Both cuts come from the same histogram, so the second split is free.
    """
    sizes, largest = stratum_counts(df, [target])
    counts = _quota_of(sizes, test_size, "__n", "__test").withColumn(
        "__rest_n", F.col("__n") - F.col("__test")
    )
    counts = _quota_of(counts, val_size, "__rest_n", "__val")
    ranks = ranks_table(
        counts,
        {0: F.col("__test"), 1: F.col("__test") + F.col("__val")},
    )
    parts = rank_part(df, id_col, [target], ranks, "__part", seed, largest)
    return parts.withColumn(
        out,
        F.when(F.col("__part") == 0, "test")
        .when(F.col("__part") == 1, "val")
        .otherwise("train"),
    ).drop("__part")


def stratified_folds(
    df: DataFrame,
    id_col: str,
    target: str,
    k: int = 3,
    seed: int = 42,
    out: str = "fold",
) -> DataFrame:
    """Add `fold` 0..k-1; class sizes differ by at most one between folds."""
    counts, largest = stratum_counts(df, [target])
    n = F.col("__n")
    base = F.floor(n / k)
    extra = n % k
    ranks = ranks_table(
        counts,
        {i: i * base + F.least(F.lit(i), extra) for i in range(1, k)},
    )
    return rank_part(df, id_col, [target], ranks, out, seed, largest)


def cut_batches(
    df: DataFrame, id_col: str, rows: int, n_batches: int, seed: int = 42
) -> DataFrame:
    """Shuffled, disjoint batches of `rows` rows; the remainder is left out.

    `batch_no` is 1..n_batches. Asking for more rows than there are gives a
    shorter last batch.
    """
    spark = df.sparkSession
    total = df.count()
    cuts = [i * rows for i in range(1, n_batches + 1) if i * rows <= total]
    if not cuts:
        return df.withColumn("batch_no", F.lit(1))
    ranks = local_table(
        spark, list(enumerate(cuts)), "__cut int, __rank long"
    )
    parts = rank_part(df, id_col, [], ranks, "__part", seed, total)
    return (
        parts.filter(F.col("__part") < n_batches)
        .withColumn("batch_no", F.col("__part") + 1)
        .drop("__part")
    )


def control_rows(df: DataFrame, id_col: str, n: int = 100) -> DataFrame:
    """First n rows by key, for smoke scoring."""
    return df.orderBy(id_col).limit(n)


def split_balance(
    df: DataFrame, target: str, split: str = "split"
) -> DataFrame:
    """Size and positive rate of every part."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col(target).cast("double")).alias("positive_rate"),
    )


def holdout_of_new_batch(
    history: DataFrame | None,
    new: DataFrame,
    spec: TableSpec,
    test_size: float = 0.25,
    seed: int = 42,
) -> DataFrame:
    """A part of the new batch is held out; the rest and history is train."""
    parts = stratified_split(new, spec.id, spec.target, test_size, seed)
    if history is None:
        return parts
    return history.withColumn("split", F.lit("train")).unionByName(parts)


def shared_keys(
    df: DataFrame, id_col: str, split: str = "split"
) -> DataFrame:
    """Number of keys that occur in both train and test (must be 0)."""
    train = df.filter(F.col(split) == "train").select(id_col)
    test = df.filter(F.col(split) == "test").select(id_col)
    return train.join(test, id_col, "left_semi").agg(
        F.count(F.lit(1)).alias("n_shared")
    )
