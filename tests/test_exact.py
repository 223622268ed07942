"""Order-dependent building blocks: large paths against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from proclivity.functions import exact
from proclivity.functions.scalar import hash_key, step_index
from proclivity.functions.tables import local_table, settle
from proclivity.operators import evaluation as ev
from proclivity.operators import sampling
from proclivity.operators.ranking import TopShares, call_list


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one score; classes are very uneven."""
    rng = np.random.default_rng(1)
    n = 6000
    score = np.where(rng.random(n) < 0.34, 0.5, rng.random(n).round(3))
    y = (rng.random(n) < 0.05 + 0.3 * score).astype(int)
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "score": score})
    return pdf, spark.createDataFrame(pdf).cache()


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("bucket_rows", [50, 500, 10**6])
def test_auc_equals_all_pairs(skewed, bucket_rows):
    pdf, df = skewed
    row = ev.roc_auc_exact(df, "y", "score", bucket_rows=bucket_rows).first()
    expected = brute_auc(pdf.y.to_numpy(), pdf.score.to_numpy())
    assert row["roc_auc"] == pytest.approx(expected, abs=1e-12)


def test_auc_of_reversed_score(skewed):
    _, df = skewed
    a = ev.roc_auc_exact(df, "y", "score").first()["roc_auc"]
    flipped = df.withColumn("score", -F.col("score"))
    b = ev.roc_auc_exact(flipped, "y", "score").first()["roc_auc"]
    assert a + b == pytest.approx(1.0)


def test_auc_of_one_class_is_null(skewed):
    _, df = skewed
    one = df.filter("y = 1")
    assert ev.roc_auc_exact(one, "y", "score").first()["roc_auc"] is None


def test_average_precision_with_many_buckets(skewed):
    pdf, df = skewed
    groups = pdf.groupby("score").y.agg(["sum", "count"]).sort_index(
        ascending=False
    )
    tp, seen = groups["sum"].cumsum(), groups["count"].cumsum()
    expected = (groups["sum"] * tp / seen).sum() / pdf.y.sum()
    got = ev.pr_auc(df, "y", "score", bucket_rows=100).first()[0]
    assert got == pytest.approx(expected)


def test_best_threshold_tries_every_score(skewed):
    pdf, df = skewed
    best = max(
        (
            2 * (pdf.y[pdf.score >= t].sum())
            / ((pdf.score >= t).sum() + pdf.y.sum()),
            -t,
        )
        for t in pdf.score.unique()
    )
    row = ev.best_f1_threshold(df, "y", "score", bucket_rows=100).first()
    assert row["threshold"] == pytest.approx(-best[1])
    assert row["f1"] == pytest.approx(best[0])


def ordered_ids(df, strata):
    pdf = df.select("id", "y", hash_key("id").alias("k")).toPandas()
    pdf = pdf.sort_values([*strata, "k"])
    pdf["rn"] = pdf.groupby(strata).cumcount() + 1 if strata else range(
        1, len(pdf) + 1
    )
    return pdf


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_rank_cuts_by_histogram(spark, skewed, digits):
    _, df = skewed
    pdf = ordered_ids(df, ["y"])
    sizes = pdf.groupby("y").size()
    wanted = [
        (int(c), i, int(r))
        for c, n in sizes.items()
        for i, r in enumerate((1, n // 3, n))
    ]
    ranks = local_table(spark, wanted, "y long, __cut int, __rank long")
    cuts = exact.rank_cuts(
        df, hash_key("id"), ["y"], ranks, hex_digits=digits
    ).collect()
    found = {(r["y"], r["__cut"]): r["__key"] for r in cuts}
    for c, i, r in wanted:
        expected = pdf[(pdf.y == c) & (pdf.rn == r)].k.iloc[0]
        assert found[(c, i)] == expected


def test_sample_is_the_same_on_both_paths(skewed, monkeypatch):
    _, df = skewed
    small = sampling.stratified_sample(df, "id", "y", 0.2)
    expected = {r["id"] for r in small.collect()}
    monkeypatch.setattr(exact, "SORT_ROWS", 10)
    large = sampling.stratified_sample(df, "id", "y", 0.2)
    assert {r["id"] for r in large.collect()} == expected


def test_batches_are_the_same_on_both_paths(skewed, monkeypatch):
    _, df = skewed
    one = sampling.cut_batches(df, "id", 900, 5).select("id", "batch_no")
    expected = set(map(tuple, one.collect()))
    assert len(expected) == 4500
    monkeypatch.setattr(exact, "SORT_ROWS", 10)
    two = sampling.cut_batches(df, "id", 900, 5).select("id", "batch_no")
    assert set(map(tuple, two.collect())) == expected


def test_split_sizes_and_quota(skewed):
    pdf, df = skewed
    parts = sampling.stratified_split(df, "id", "y", 0.25).toPandas()
    assert (parts.split == "test").sum() == int(np.ceil(0.25 * len(pdf)))
    assert set(parts.id) == set(pdf.id)
    shares = parts.groupby("split").y.mean()
    assert abs(shares["test"] - shares["train"]) < 0.001


def test_empty_quota_keeps_every_row(spark):
    # one positive of many: its sample size rounds to 0
    rows = [(i, 1 if i == 0 else 0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y int")
    sample = sampling.stratified_sample(df, "id", "y", 0.1)
    assert sample.filter("y = 1").count() == 0
    assert sample.count() == 20


def test_folds_cover_all_rows(skewed):
    pdf, df = skewed
    folds = sampling.stratified_folds(df, "id", "y", 4).toPandas()
    sizes = folds.groupby(["y", "fold"]).size().unstack()
    assert ((sizes.max(axis=1) - sizes.min(axis=1)) <= 1).all()
    assert len(folds) == len(pdf)


@pytest.mark.parametrize(
    ("plain", "limit"), [(10**6, 10**6), (10, 10**6), (10, 40), (10, 5)]
)
def test_quantiles_equal_numpy(spark, plain, limit):
    rng = np.random.default_rng(3)
    n = 20_000
    smooth = rng.normal(size=n)
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 50, n))
    holes = np.where(rng.random(n) < 0.1, np.nan, rng.exponential(size=n))
    pdf = pd.DataFrame({"smooth": smooth, "hot": hot, "holes": holes})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact.exact_quantiles(
        df, dict.fromkeys(pdf.columns, probs), limit, plain, accuracy=200
    )
    for c in pdf.columns:
        expected = np.quantile(pdf[c].dropna(), probs)
        assert got[c] == pytest.approx(expected.tolist(), abs=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact.exact_quantiles(df, {"x": [0.5]}) == {"x": [None]}


def test_top_shares_cut_inside_ties(skewed):
    pdf, df = skewed
    keys = df.select("id", hash_key("id").alias("k")).toPandas()
    order = pdf.merge(keys, on="id").sort_values(
        ["score", "k"], ascending=[False, True]
    )
    for share in (0.1, 0.4, 0.55, 1.0):
        tops = TopShares(df, "id", "score", [share])
        got = {r["id"] for r in df.filter(tops.inside(share)).collect()}
        n = round(share * len(pdf))
        assert got == set(order.id[:n])


def test_call_list_needs_one_rule(skewed):
    _, df = skewed
    with pytest.raises(ValueError, match="either"):
        call_list(df, "id", "score")


def test_gains_whole_table_is_no_gain(skewed):
    _, df = skewed
    row = ev.gains_table(df, "id", "y", "score", [1.0]).first()
    assert row["caught_share"] == 1.0
    assert row["lift"] == pytest.approx(1.0)


def test_bootstrap_covers_the_estimate(skewed):
    _, df = skewed
    auc = ev.roc_auc_exact(df, "y", "score")
    hanley = ev.auc_ci_hanley(auc).first()
    rows = ev.bootstrap_ci(df, "y", "score", repeats=200, bucket_rows=1000)
    got = {r["metric"]: r for r in rows.collect()}
    ci = got["roc_auc"]
    assert ci["ci_low"] < hanley["roc_auc"] < ci["ci_high"]
    width = hanley["ci_high"] - hanley["ci_low"]
    assert ci["ci_high"] - ci["ci_low"] == pytest.approx(width, rel=0.35)
    exact_row = ev.confusion_metrics(df, "y", "score").first()
    for m in ("precision", "recall", "f1"):
        assert got[m]["ci_low"] < exact_row[m] < got[m]["ci_high"]
    # weights depend neither on the buckets nor on the order of rows
    again = ev.bootstrap_ci(
        df.repartition(13), "y", "score", repeats=200, bucket_rows=250
    )
    for r in again.collect():
        assert r["mean"] == pytest.approx(got[r["metric"]]["mean"], abs=1e-12)


def test_poisson_weights_have_their_distribution(spark):
    for size in (1, 7, 20, 21, 400):
        rows = spark.range(20_000).select(
            F.col("id").cast("string").alias("k"), F.lit(size).alias("n")
        )
        drawn = ev.poisson_weights(rows, {"n": "x"}, ["k"]).agg(
            F.avg("n").alias("m"), F.var_pop("n").alias("v"),
            F.min("n").alias("least"), F.skewness("n").alias("s"),
        ).first()
        assert drawn["m"] == pytest.approx(size, rel=0.03)
        assert drawn["v"] == pytest.approx(size, rel=0.05)
        assert drawn["s"] == pytest.approx(size**-0.5, abs=0.08)
        assert drawn["least"] >= 0


def test_settle_leaves_large_tables_alone(spark):
    big = spark.range(100)
    assert settle(big, 10) is big
    assert settle(big, 100).isLocal()


def test_step_index_counts_cuts(spark):
    cuts = [1.0, 2.0, 5.0, 5.5, 9.0]
    values = [-1.0, 1.0, 1.5, 5.0, 5.2, 9.0, 10.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(exact.step_index("x", cuts)).collect()]
    assert got == [0, 1, 1, 3, 3, 5, 5, 5, 5]


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 700])
def test_step_index_counts_cuts(spark, n):
    cuts = [i * 0.5 for i in range(n)]
    xs = [-1.0, 0.0, 0.25, 0.5, n / 4, n / 2 - 0.5, n / 2, float("nan"), None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(step_index("x", cuts)).collect()]
    assert got == [
        n if x is None or x != x else sum(c <= x for c in cuts) for x in xs
    ]


def test_buckets_have_no_ceiling(spark):
    """1500 buckets: equal sizes, no cut point in a plan, the same totals."""
    df = spark.range(30_000).select(
        F.pmod(F.col("id") * 7919, F.lit(30_000)).cast("double").alias("x"),
        (F.col("id") % 3 == 0).cast("int").alias("y"),
    )
    spark.conf.set("spark.sql.shuffle.partitions", "1500")
    try:
        assert exact.bucket_count(df, "x", 10) == (1500, 30_000)
        assert exact.bucket_count(df, "x", 20) == (1500, 30_000)
        assert exact.bucket_count(df, "x", 2_000) == (15, 30_000)
        many = ev.roc_auc_exact(df, "y", "x", bucket_rows=20)
        assert len(many._jdf.queryExecution().toString()) < 60_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    runs = exact.score_runs(df, "x", {"n": F.lit(1)}, buckets=1500)
    spans = runs.groupBy("__bucket").agg(F.min("x"), F.max("x"), F.count("x"))
    rows = sorted(tuple(r) for r in spans.collect())
    assert 1000 < len(rows) <= 1500 and max(r[3] for r in rows) < 200
    assert all(a[2] < b[1] for a, b in zip(rows, rows[1:]))
    placed = exact.running_before(runs, "x", ["n"], descending=False)
    assert placed.where("n_before <> x").isEmpty()
    one = ev.roc_auc_exact(df, "y", "x").first()[0]
    assert many.first()[0] == pytest.approx(one, abs=1e-12)


def test_missing_scores_come_last(spark):
    df = spark.createDataFrame([(float(i),) for i in range(50)] + [(None,)] * 3, "x double")
    runs = exact.score_runs(df, "x", {"n": F.lit(1)}, bucket_rows=10)
    last = runs.agg(F.max("__bucket")).first()[0]
    row = runs.where("x IS NULL").first()
    assert row["n"] == 3 and row["__bucket"] == last
