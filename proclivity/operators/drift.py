"""Drift of a batch against a stored profile (population stability index)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity.functions.scalar import log_ratio, round4, step_index, str_key
from proclivity.functions.tables import local_table, settle
from proclivity.operators.lookups import outer_shares
from proclivity.operators.profiling import quantile_cuts

KEYS = ["feature", "kind", "category"]
PROFILE_SCHEMA = (
    "feature string, kind string, category string, cut_lo double, "
    "cut_hi double, share double"
)


def psi(shares: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of log ratios of `expected` and `actual` shares, as `psi`.

    Shares are raised to the floor but not rescaled afterwards.
    """
    term = log_ratio("actual", "expected")
    return shares.groupBy(*by).agg(F.sum(term).alias("psi"))


def bin_counts(
    df: DataFrame,
    cuts: Mapping[str, Sequence[float]],
    categorical: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows per bin and per category of all features, in one pass.

    Every row yields one cell per feature; cells collapse on the map side, so
    the shuffle carries bins and categories only. The bin number is kept in
    `category` as text.
    """
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit("numeric").alias("kind"),
            step_index(c, points)
            .cast("string")
            .alias("category"),
        )
        for c, points in cuts.items()
    ] + [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit("categorical").alias("kind"),
            str_key(c).alias("category"),
        )
        for c in categorical
    ]
    return (
        df.select(*by, F.inline(F.array(*cells)))
        .groupBy(*by, *KEYS)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def shares_of(
    df: DataFrame,
    cuts: Mapping[str, Sequence[float]],
    categorical: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Share of every bin and category; empty bins are present with 0.

    Numeric bins carry the two cut points around them.
    """
    counts = settle(bin_counts(df, cuts, categorical, by)).select(
        *by,
        *KEYS,
        F.lit(None).cast("double").alias("cut_lo"),
        F.lit(None).cast("double").alias("cut_hi"),
        "n",
    )
    if cuts:
        # every bin once with no rows, so that it exists
        grid = _bin_grid(df.sparkSession, cuts).withColumn(
            "n", F.lit(0).cast("long")
        )
        for c in by:
            # a list of batches, as long as the list of files
            seen = [r[0] for r in counts.select(c).distinct().collect()]
            grid = grid.withColumn(
                c, F.explode(F.array(*[F.lit(v) for v in seen]))
            )
        counts = counts.unionByName(grid)
    bins = counts.groupBy(*by, *KEYS).agg(
        F.max("cut_lo").alias("cut_lo"),
        F.max("cut_hi").alias("cut_hi"),
        F.sum("n").alias("n"),
    )
    per_feature = counts.groupBy(*by, "feature").agg(
        F.sum("n").alias("total")
    )
    return bins.join(per_feature, [*by, "feature"]).select(
        *by,
        *KEYS,
        "cut_lo",
        "cut_hi",
        (F.col("n") / F.col("total")).alias("share"),
    )


def _bin_grid(
    spark: SparkSession, cuts: Mapping[str, Sequence[float]]
) -> DataFrame:
    rows = []
    for c, points in cuts.items():
        edges = [None, *[float(p) for p in points], None]
        for i in range(len(points) + 1):
            rows.append((c, "numeric", str(i), edges[i], edges[i + 1]))
    return local_table(
        spark,
        rows,
        "feature string, kind string, category string, cut_lo double, "
        "cut_hi double",
    )


def data_profile(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """Profile table: decile bins and category shares of the features.

    Settled when small, so later drift checks do not scan the old data.
    """
    cuts = quantile_cuts(df, numeric) if numeric else {}
    return settle(shares_of(df, cuts, categorical))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Decile cuts and bin shares (feature, bin, cut_lo, cut_hi, share)."""
    return data_profile(df, columns, []).select(
        "feature",
        F.col("category").cast("int").alias("bin"),
        "cut_lo",
        "cut_hi",
        "share",
    )


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Category shares (feature, category, share)."""
    return data_profile(df, [], columns).select(
        "feature", "category", "share"
    )


def profile_features(
    profile: DataFrame,
) -> tuple[dict[str, list[float]], list[str]]:
    """Cut points per numeric feature, and the categorical features.

    Distinct cut points only: at most ten rows per feature are read,
    whatever the number of categories.
    """
    rows = profile.select("feature", "kind", "cut_hi").distinct().collect()
    cuts: dict[str, list[float]] = {}
    categorical = []
    for row in rows:
        if row["kind"] == "categorical":
            categorical.append(row["feature"])
            continue
        points = cuts.setdefault(row["feature"], [])
        if row["cut_hi"] is not None:
            points.append(row["cut_hi"])
    return (
        {c: sorted(cuts[c]) for c in sorted(cuts)},
        sorted(categorical),
    )


def drift_report(
    profile: DataFrame, df: DataFrame, rounded: bool = True
) -> DataFrame:
    """PSI of every profiled feature of `df` against a profile.

    The profile's cut points are literals in the scan of the new batch;
    categories are joined in a full outer join of two share tables, so an
    unseen one counts with an expected share of 0.
    """
    cuts, categorical = profile_features(profile)
    actual = shares_of(df, cuts, categorical)
    joined = outer_shares(profile, actual, KEYS)
    out = psi(joined, ["feature"])
    return out.withColumn("psi", round4("psi")) if rounded else out


def drift_by_batch(
    profile: DataFrame, df: DataFrame, batch: str
) -> DataFrame:
    """PSI per batch and feature, all batches in one pass."""
    cuts, categorical = profile_features(profile)
    actual = settle(shares_of(df, cuts, categorical, [batch]))
    # the list of batches is the list of files: the profile once per batch
    batches = [r[0] for r in actual.select(batch).distinct().collect()]
    listed = F.array(*[F.lit(b) for b in batches])
    expected = profile.select(
        F.explode(listed).alias(batch), *KEYS, "share"
    )
    joined = outer_shares(expected, actual, [batch, *KEYS])
    return psi(joined, [batch, "feature"]).withColumn("psi", round4("psi"))


def drift_alarm(report: DataFrame, limit: float = 0.2) -> DataFrame:
    """One row: largest PSI, its feature, and whether it is above the limit.

    An empty report (no production model) raises no alarm.
    """
    best = F.max(F.struct(F.col("psi"), F.col("feature")))
    return report.agg(best.alias("b")).select(
        F.col("b.psi").alias("max_psi"),
        F.coalesce(F.col("b.psi") > limit, F.lit(False)).alias("alarm"),
    )


def monitor_decision(report: DataFrame, limit: float = 0.2) -> DataFrame:
    """Exit status of a monitoring run: 2 drift, 0 none."""
    return drift_alarm(report, limit).select(
        F.when(F.col("alarm"), 2).otherwise(0).alias("exit_status"),
        F.when(F.col("alarm"), "drift").otherwise("ok").alias("result"),
    )


def batch_overview(
    df: DataFrame, profile: DataFrame, batch: str, target: str
) -> DataFrame:
    """Rows, positive rate, worst PSI and its feature for every batch."""
    sizes = df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_rows"),
        round4(F.avg(F.col(target).cast("double"))).alias("positive_rate"),
    )
    drift = drift_by_batch(profile, df, batch)
    worst = drift.groupBy(batch).agg(F.max("psi").alias("max_psi"))
    named = (
        drift.join(worst, batch)
        .filter(F.col("psi") == F.col("max_psi"))
        .groupBy(batch, "max_psi")
        .agg(F.min("feature").alias("worst_feature"))
    )
    return sizes.join(named, batch)


def store_profile(profile: DataFrame, version: str) -> DataFrame:
    """Profile rows keyed by the model version they belong to."""
    return profile.select(F.lit(version).alias("version"), *profile.columns)


def retrain_trigger(
    new_rows: Column,
    train_rows: Column,
    max_psi: Column,
    fresh_auc: Column,
    scheduled: Column | None = None,
    min_new_share: float = 0.05,
    psi_limit: float = 0.2,
    min_auc: float = 0.80,
    manual: Column | None = None,
) -> Column:
    """Reason to retrain: manual, degradation, drift, new_data, schedule, or
    none; a call by hand needs no other reason."""
    out = (
        F.when(F.lit(False) if manual is None else manual, F.lit("manual"))
        .when(fresh_auc < min_auc, F.lit("degradation"))
        .when(max_psi > psi_limit, F.lit("drift"))
        .when(new_rows >= min_new_share * train_rows, F.lit("new_data"))
    )
    if scheduled is not None:
        out = out.when(scheduled, F.lit("schedule"))
    return out.otherwise(F.lit("none"))
