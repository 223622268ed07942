"""Exact evaluation of scores: threshold metrics, AUC, curves, gains.

Everything is computed from rows collapsed to distinct scores. Per-bucket
prefix sums replace one global sort; see `functions.exact`.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.exact import (
    SORT_ROWS,
    before_buckets,
    bucket_count,
    inside_bucket,
    running_before,
    score_runs,
)
from proclivity.functions.scalar import (
    age_band,
    ratio,
    round4,
    step_index,
    str_key,
    threshold_decision,
)
from proclivity.functions.tables import settle
from proclivity.operators.ranking import TopShares

METRICS = ["precision", "recall", "f1", "roc_auc"]

def _counts(target: str, score: str, threshold) -> dict[str, Column]:
    y = F.col(target)
    hit = threshold_decision(score, threshold) == 1
    return {
        "tp": F.count_if(hit & (y == 1)),
        "fp": F.count_if(hit & (y == 0)),
        "fn": F.count_if(~hit & (y == 1)),
        "tn": F.count_if(~hit & (y == 0)),
    }


def _scores(tp, fp, fn) -> list[Column]:
    tp, fp, fn = F.col(tp), F.col(fp), F.col(fn)
    return [
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def confusion_counts(
    df: DataFrame,
    target: str,
    score: str,
    threshold: float = 0.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """TP, FP, FN, TN at `score >= threshold`."""
    sums = _counts(target, score, threshold)
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in sums.items()])


def confusion_metrics(
    df: DataFrame,
    target: str,
    score: str,
    threshold: float = 0.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """Precision, recall and F1; a division by nothing is 0."""
    counts = confusion_counts(df, target, score, threshold, by)
    return counts.select(*by, *_scores("tp", "fp", "fn"))


def _positives(target: str) -> dict[str, Column]:
    y = F.col(target)
    return {
        "pos": (y == 1).cast("long"),
        "neg": (y == 0).cast("long"),
    }


def _auc_parts(
    df: DataFrame,
    target: str,
    score: str,
    by: Sequence[str],
    bucket_rows: int,
    threshold: float | None = None,
) -> DataFrame:
    """Per (by, bucket): positives, negatives, correctly ordered pairs.

    `wins` counts, for every positive, the negatives of the same bucket below
    it (ties half). Pairs across buckets follow from the bucket totals, so
    the scores never need one common sort.
    """
    by = list(by)
    runs = score_runs(df, score, _positives(target), by, bucket_rows)
    below = F.coalesce(
        F.sum("neg").over(inside_bucket(by, score)), F.lit(0)
    )
    local = runs.withColumn(
        "wins",
        F.col("pos").cast("double") * (below + F.col("neg") / 2),
    )
    sums = [F.sum(c).alias(c) for c in ("pos", "neg", "wins")]
    if threshold is not None:
        flagged = F.col(score) >= threshold
        sums += [
            F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(flagged, F.col("neg")).otherwise(0)).alias("fp"),
        ]
    return local.groupBy(*by, "__bucket").agg(*sums)


def _auc_total(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    by = list(by)
    ahead = F.coalesce(
        F.sum("neg").over(before_buckets(by)), F.lit(0)
    )
    placed = parts.withColumn(
        "wins", F.col("wins") + F.col("pos").cast("double") * ahead
    )
    extra = [F.sum(c).alias(c) for c in ("tp", "fp") if c in parts.columns]
    return placed.groupBy(*by).agg(
        F.sum("pos").alias("n_positive"),
        F.sum("neg").alias("n_negative"),
        F.sum("wins").alias("wins"),
        *extra,
    )


def _auc_value() -> Column:
    pairs = F.col("n_positive").cast("double") * F.col("n_negative")
    return F.when(pairs > 0, F.col("wins") / F.nullif(pairs, F.lit(0.0)))


def roc_auc_exact(
    df: DataFrame,
    target: str,
    score: str,
    by: Sequence[str] = (),
    bucket_rows: int = SORT_ROWS,
) -> DataFrame:
    """ROC-AUC with ties counted half; null where only one class exists."""
    parts = _auc_parts(df, target, score, by, bucket_rows)
    return _auc_total(parts, by).select(
        *by, "n_positive", "n_negative", _auc_value().alias("roc_auc")
    )


def classification_metrics(
    df: DataFrame,
    target: str,
    score: str,
    threshold: float = 0.5,
    by: Sequence[str] = (),
    bucket_rows: int = SORT_ROWS,
) -> DataFrame:
    """Precision, recall, F1 and ROC-AUC from one pass over the rows."""
    parts = _auc_parts(df, target, score, by, bucket_rows, threshold)
    total = _auc_total(parts, by).withColumn(
        "fn", F.col("n_positive") - F.col("tp")
    )
    return total.select(
        *by,
        *_scores("tp", "fp", "fn"),
        _auc_value().alias("roc_auc"),
        (F.col("n_positive") + F.col("n_negative")).alias("n_rows"),
        "n_positive",
        (F.col("tp") + F.col("fp")).alias("n_flagged"),
    )


def confusion_matrix(
    df: DataFrame, target: str, score: str, threshold: float = 0.5
) -> DataFrame:
    """The four cells of the confusion matrix."""
    one = confusion_counts(df, target, score, threshold)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("actual"),
                        F.lit(p).alias("predicted"),
                        F.col(c).alias("n_rows"),
                    )
                    for a, p, c in cells
                ]
            )
        )
    )


def classification_report(
    df: DataFrame, target: str, score: str, threshold: float = 0.5
) -> DataFrame:
    """Per class and averaged precision, recall, F1 and support."""
    one = confusion_counts(df, target, score, threshold)
    flipped = one.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("1").alias("label"),
                    F.col("tp").alias("tp"),
                    F.col("fp").alias("fp"),
                    F.col("fn").alias("fn"),
                ),
                F.struct(
                    F.lit("0").alias("label"),
                    F.col("tn").alias("tp"),
                    F.col("fn").alias("fp"),
                    F.col("fp").alias("fn"),
                ),
            )
        )
    ).withColumn("support", F.col("tp") + F.col("fn"))
    classes = flipped.select(
        "label", *_scores("tp", "fp", "fn"), "support"
    )
    names = ["precision", "recall", "f1"]
    macro = classes.agg(
        *[F.avg(n).alias(n) for n in names],
        F.sum("support").alias("support"),
    ).select(F.lit("macro avg").alias("label"), *names, "support")
    total = F.sum("support")
    weighted = classes.agg(
        *[ratio(F.sum(F.col(n) * F.col("support")), total).alias(n)
          for n in names],
        total.alias("support_"),
    ).select(
        F.lit("weighted avg").alias("label"),
        *names,
        F.col("support_").alias("support"),
    )
    return classes.unionByName(macro).unionByName(weighted)


def train_test_gap(train: DataFrame, test: DataFrame) -> DataFrame:
    """Difference of each metric and a verdict from the AUC gap."""
    def one(df, side):
        return df.select(F.lit(side).alias("side"), F.struct(*METRICS).alias("m"))

    sides = one(train, "train").unionByName(one(test, "test"))
    both = sides.agg(
        *[
            F.max(F.when(F.col("side") == s, F.col("m"))).alias(s)
            for s in ("train", "test")
        ]
    )
    gap = F.col("train.roc_auc") - F.col("test.roc_auc")
    size = F.abs(gap)
    verdict = (
        F.when(F.col("train.roc_auc") < 0.6, "underfit")
        .when(
            (F.col("train.roc_auc") > 0.85) & (size > 0.1),
            "strong overfit",
        )
        .when((size > 0.05) & (gap > 0), "moderate overfit")
        .when(size > 0.05, "unusual")
        .when(size > 0.02, "small gap")
        .otherwise("good")
    )
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"train.{m}").alias("train"),
            F.col(f"test.{m}").alias("test"),
            (F.col(f"train.{m}") - F.col(f"test.{m}")).alias("difference"),
            verdict.alias("verdict"),
        )
        for m in METRICS
    ]
    return both.select(F.inline(F.array(*rows)))


# --- slices ---------------------------------------------------------------


def to_slices(
    df: DataFrame,
    columns: Sequence[str],
    bands: Mapping[str, tuple],
    keep: Sequence[str],
    whole: bool = False,
) -> DataFrame:
    """One row per (row, slice): each row belongs to one slice per column.

    With `whole`, the table itself is one more slice.
    """
    pairs = [(c, str_key(c)) for c in columns] + [
        (c, age_band(c, edges, labels))
        for c, (edges, labels) in bands.items()
    ]
    if whole:
        pairs.append((WHOLE, F.lit(WHOLE)))
    return df.select(
        *keep,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("slice_col"),
                        value.alias("slice_value"),
                    )
                    for c, value in pairs
                ]
            )
        ),
    )


SLICE = ["slice_col", "slice_value"]
WHOLE = "__whole"


def slice_auc(
    df: DataFrame,
    target: str,
    score: str,
    columns: Sequence[str],
    bands: Mapping[str, tuple] | None = None,
    min_rows: int = 200,
) -> DataFrame:
    """AUC inside every slice, rounded; small and one-class slices left out."""
    long = to_slices(df, columns, bands or {}, [target, score])
    auc = roc_auc_exact(long, target, score, SLICE)
    n = F.col("n_positive") + F.col("n_negative")
    return auc.filter(
        (n >= min_rows) & F.col("roc_auc").isNotNull()
    ).select(*SLICE, n.alias("n_rows"), round4("roc_auc").alias("roc_auc"))


def slice_report(
    df: DataFrame,
    target: str,
    score: str,
    columns: Sequence[str],
    bands: Mapping[str, tuple] | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Share of customers, positive rate, AUC and F1 of every slice."""
    long = to_slices(df, columns, bands or {}, [target, score])
    metrics = classification_metrics(long, target, score, threshold, SLICE)
    total = df.agg(F.count(F.lit(1))).scalar()
    return metrics.select(
        *SLICE,
        (F.col("n_rows") / total).alias("customer_share"),
        (F.col("n_positive") / F.col("n_rows")).alias("positive_rate"),
        "roc_auc",
        "f1",
    )


def score_model(
    scored: DataFrame,
    target: str,
    score: str,
    threshold: float,
    columns: Sequence[str],
    bands: Mapping[str, tuple] | None = None,
    min_slice_rows: int = 200,
) -> tuple[DataFrame, DataFrame]:
    """Rounded metrics and the slice table of one scored table.

    The whole table is measured as one more slice, so both come from the same
    pass; the few result rows are settled.
    """
    long = to_slices(scored, columns, bands or {}, [target, score], True)
    rows = settle(
        classification_metrics(long, target, score, threshold, SLICE)
    )
    whole = F.col("slice_col") == WHOLE
    overall = rows.filter(whole).select(
        *[round4(m).alias(m) for m in METRICS]
    )
    slices = rows.filter(
        ~whole
        & (F.col("n_rows") >= min_slice_rows)
        & F.col("roc_auc").isNotNull()
    ).select(*SLICE, "n_rows", round4("roc_auc").alias("roc_auc"))
    return overall, slices


# --- thresholds and curves ----------------------------------------------------


def threshold_sweep(
    df: DataFrame,
    target: str,
    score: str,
    thresholds: Sequence[float] = (0.3, 0.4, 0.5, 0.6, 0.7),
) -> DataFrame:
    """Precision, recall, F1 and flagged share at several thresholds.

    A row is counted once, in the interval between two thresholds; the
    totals from the top are summed over the few intervals afterwards.
    """
    points = sorted(thresholds)
    y = F.col(target)
    level = step_index(score, points)
    sums = []
    for i in range(len(points) + 1):
        sums.append(F.count_if((level == i) & (y == 1)).alias(f"p{i}"))
        sums.append(F.count_if((level == i) & (y == 0)).alias(f"n{i}"))
    one = df.agg(*sums)
    rows = []
    for i, t in enumerate(points):
        above = range(i + 1, len(points) + 1)
        below = range(0, i + 1)
        rows.append(
            F.struct(
                F.lit(float(t)).alias("threshold"),
                sum((F.col(f"p{j}") for j in above), F.lit(0)).alias("tp"),
                sum((F.col(f"n{j}") for j in above), F.lit(0)).alias("fp"),
                sum((F.col(f"p{j}") for j in below), F.lit(0)).alias("fn"),
                sum((F.col(f"n{j}") for j in below), F.lit(0)).alias("tn"),
            )
        )
    table = one.select(F.inline(F.array(*rows)))
    flagged = F.col("tp") + F.col("fp")
    everyone = flagged + F.col("fn") + F.col("tn")
    return table.select(
        "threshold",
        *_scores("tp", "fp", "fn"),
        ratio(flagged, everyone).alias("flagged_share"),
    )


def curve_points(
    df: DataFrame,
    target: str,
    score: str,
    bucket_rows: int = SORT_ROWS,
) -> DataFrame:
    """TP and FP at every distinct score taken as the threshold."""
    runs = score_runs(df, score, _positives(target), (), bucket_rows)
    placed = running_before(runs, score, ["pos", "neg"])
    return placed.select(
        F.col(score).alias("threshold"),
        "pos",
        "neg",
        (F.col("pos_before") + F.col("pos")).alias("tp"),
        (F.col("neg_before") + F.col("neg")).alias("fp"),
    )


def class_totals(df: DataFrame, target: str) -> tuple[Column, Column]:
    """Positives and negatives as scalar subqueries."""
    y = F.col(target)
    one = df.agg(
        F.count_if(y == 1).alias("p"), F.count_if(y == 0).alias("n")
    )
    return one.select("p").scalar(), one.select("n").scalar()


def roc_pr_curves(
    df: DataFrame,
    target: str,
    score: str,
    bucket_rows: int = SORT_ROWS,
) -> DataFrame:
    """Points of the ROC curve (fpr, tpr) and of the PR curve."""
    positives, negatives = class_totals(df, target)
    points = curve_points(df, target, score, bucket_rows)
    return points.select(
        "threshold",
        (F.col("tp") / positives).alias("tpr"),
        (F.col("fp") / negatives).alias("fpr"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def pr_auc(
    df: DataFrame,
    target: str,
    score: str,
    bucket_rows: int = SORT_ROWS,
) -> DataFrame:
    """Average precision: recall steps times precision, over all scores."""
    points = curve_points(df, target, score, bucket_rows)
    step = F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return points.agg(
        (F.sum(step) / F.nullif(F.sum("pos"), F.lit(0))).alias("pr_auc")
    )


def best_f1_threshold(
    df: DataFrame,
    target: str,
    score: str,
    grid: Sequence[float] | None = None,
    bucket_rows: int = SORT_ROWS,
) -> DataFrame:
    """Threshold with the largest F1; the smallest threshold wins a tie.

    Without a grid every distinct score is tried.
    """
    if grid is not None:
        table = threshold_sweep(df, target, score, grid)
    else:
        positives, _ = class_totals(df, target)
        points = curve_points(df, target, score, bucket_rows)
        table = points.select(
            "threshold",
            ratio(
                2 * F.col("tp"), F.col("tp") + F.col("fp") + positives
            ).alias("f1"),
        )
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("m")))
    return table.agg(best.alias("b")).select(
        (-F.col("b.m")).alias("threshold"), F.col("b.f1").alias("f1")
    )


def gains_table(
    df: DataFrame,
    id_col: str,
    target: str,
    score: str,
    shares: Sequence[float] = (0.1, 0.2, 0.3, 0.5),
    seed: int = 42,
) -> DataFrame:
    """Catch, conversion and lift of the top shares of the score order."""
    tops = TopShares(df, id_col, score, shares, seed)
    y = F.col(target)
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == 1).alias("p"),
        *[
            F.count_if(tops.inside(s) & (y == 1)).alias(f"p{i}")
            for i, s in enumerate(shares)
        ],
        *[
            F.count_if(tops.inside(s)).alias(f"n{i}")
            for i, s in enumerate(shares)
        ],
    )
    rows = [
        F.struct(
            F.lit(float(s)).alias("top_share"),
            F.col(f"n{i}").alias("n_called"),
            F.col(f"p{i}").alias("n_caught"),
            ratio(F.col(f"p{i}"), F.col("p")).alias("caught_share"),
            ratio(F.col(f"p{i}"), F.col(f"n{i}")).alias("conversion"),
            ratio(
                F.col(f"p{i}") * F.col("n"), F.col(f"n{i}") * F.col("p")
            ).alias("lift"),
        )
        for i, s in enumerate(shares)
    ]
    return one.select(F.inline(F.array(*rows)))


# --- uncertainty ---------------------------------------------------------------


def auc_ci_hanley(auc: DataFrame, z: float = 1.959963984540054) -> DataFrame:
    """Hanley-McNeil interval from AUC and the class sizes."""
    a = F.col("roc_auc")
    p, n = F.col("n_positive"), F.col("n_negative")
    q1 = a / (2 - a)
    q2 = 2 * a * a / (1 + a)
    variance = (
        a * (1 - a) + (p - 1) * (q1 - a * a) + (n - 1) * (q2 - a * a)
    ) / (p.cast("double") * n)
    error = F.sqrt(variance)
    return auc.select(
        "roc_auc",
        error.alias("std_error"),
        (a - z * error).alias("ci_low"),
        (a + z * error).alias("ci_high"),
    )


#: Groups of at most this many equal rows draw a weight for each row.
SINGLE_DRAWS = 20


def poisson_cuts() -> list[float]:
    """Distribution function of Poisson(1) at 0, 1, 2, ..."""
    terms = [math.exp(-1)]
    while terms[-1] > 1e-11:
        terms.append(terms[-1] / len(terms))
    return [math.fsum(terms[: i + 1]) for i in range(len(terms))]


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 32 bits of an md5."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 32)


def poisson_weights(
    df: DataFrame, sizes: Mapping[str, str], key: Sequence[str]
) -> DataFrame:
    """Replaces sizes by Poisson(size) numbers that depend on the key only.

    `sizes` gives each column a salt. The weight is the inverse distribution
    function of a hash: of one hash a row for up to SINGLE_DRAWS rows; beyond,
    the normal quantile with the correction for skewness (two hashes), whose
    distribution differs from Poisson's by less than 0.01 there and by less
    for larger sizes.
    """

    def uniform(salt: str, more: Column) -> Column:
        return _uniform(*map(F.col, key), F.lit(salt), more)

    def drawn(u: Column) -> Column:
        return sum(((u >= c).cast("long") for c in poisson_cuts()), F.lit(0))

    def weight(c: str, salt: str) -> Column:
        size = F.col(c)
        many = F.aggregate(
            F.transform(
                F.sequence(F.lit(1), size.cast("int")),
                lambda i: uniform(salt, i.cast("string")),
            ),
            F.lit(0).cast("long"),
            lambda total, u: total + drawn(u),
        )
        z = F.sqrt(-2 * F.log(uniform(salt, F.lit("a")))) * F.cos(
            2 * math.pi * uniform(salt, F.lit("b"))
        )
        rough = size + F.sqrt(size.cast("double")) * z + (z * z - 1) / 6
        return (
            F.when(size == 0, F.lit(0))
            .when(size == 1, drawn(F.col(f"__u_{c}")))
            .when(size <= SINGLE_DRAWS, many)
            .otherwise(F.greatest(F.floor(rough + 0.5), F.lit(0)))
            .cast("long")
        )

    # a column of its own, so that each comparison does not hash again
    first = {
        f"__u_{c}": F.when(F.col(c) == 1, uniform(salt, F.lit("1")))
        for c, salt in sizes.items()
    }
    out = df.withColumns(first)
    return out.withColumns(
        {c: weight(c, salt) for c, salt in sizes.items()}
    ).drop(*first)


def bootstrap_ci(
    df: DataFrame,
    target: str,
    score: str,
    threshold: float = 0.5,
    repeats: int = 300,
    level: float = 0.95,
    seed: int = 42,
    bucket_rows: int = 50_000,
) -> DataFrame:
    """Poisson bootstrap intervals of precision, recall, F1 and AUC.

    A group of m equal rows gets a Poisson(m) weight per repeat, which is the
    same as Poisson(1) for each of its rows. So rows collapse to distinct
    scores, which are dealt over order buckets once; each is repeated only
    inside its bucket, where a window by (bucket, repeat) adds up what lies
    below. `repeats` rows a bucket leave it. Weights are hashes of score,
    class, repeat and seed: they depend neither on the partitions nor on the
    order of rows.
    """
    buckets, _ = bucket_count(df, score, bucket_rows)
    runs = score_runs(
        df, score, _positives(target), buckets=buckets
    ).withColumnRenamed("__bucket", "bucket")
    # two whole numbers that tell all scores between 0 and 1 apart
    scaled = F.col(score).cast("double") * float(1 << 26)
    rest = (scaled - F.floor(scaled)) * float(1 << 26)
    key = F.concat_ws(
        ":", F.floor(scaled).cast("string"), F.floor(rest).cast("string")
    )
    dealt = runs.repartition(buckets, "bucket").select(
        "bucket",
        F.col(score).alias("score"),
        "pos",
        "neg",
        key.alias("key"),
        F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"),
    )
    drawn = poisson_weights(
        dealt.withColumn("seed", F.lit(str(seed))),
        {"pos": "p", "neg": "n"},
        ["key", "repeat", "seed"],
    )
    # the rows are dealt by bucket already, so this needs no exchange
    before = Window.partitionBy("bucket", "repeat").orderBy("score")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(before), F.lit(0))
    flagged = F.col("score") >= threshold
    parts = (
        drawn.withColumn("below", below)
        .groupBy("bucket", "repeat")
        .agg(
            F.sum("pos").cast("double").alias("pos"),
            F.sum("neg").cast("double").alias("neg"),
            F.sum(
                F.col("pos") * (F.col("below") + F.col("neg") / 2)
            ).alias("wins"),
            F.sum(F.when(flagged, F.col("pos")).otherwise(0))
            .cast("double")
            .alias("tp"),
            F.sum(F.when(flagged, F.col("neg")).otherwise(0))
            .cast("double")
            .alias("fp"),
        )
    )
    renamed = parts.withColumnsRenamed({"bucket": "__bucket"})
    total = _auc_total(renamed, ["repeat"]).withColumn(
        "fn", F.col("n_positive") - F.col("tp")
    )
    values = total.select(
        "repeat", *_scores("tp", "fp", "fn"), _auc_value().alias("roc_auc")
    )
    tail = (1 - level) / 2
    long = values.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("metric"), F.col(m).alias("value")
                    )
                    for m in METRICS
                ]
            )
        )
    )
    # `repeats` values per metric: the built-in percentile is exact and small
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"),
        F.percentile("value", tail).alias("ci_low"),
        F.percentile("value", 1 - tail).alias("ci_high"),
    )


def rule_baseline(
    df: DataFrame, target: str, rule: Column, bucket_rows: int = SORT_ROWS
) -> DataFrame:
    """A yes/no rule judged like a model with scores 0 and 1."""
    scored = df.select(
        F.col(target), rule.cast("int").cast("double").alias("__rule")
    )
    metrics = classification_metrics(
        scored, target, "__rule", 0.5, (), bucket_rows
    )
    return metrics.select(
        (F.col("n_flagged") / F.col("n_rows")).alias("flagged_share"),
        *METRICS,
    )
