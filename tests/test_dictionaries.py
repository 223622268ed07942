"""Stored levels and means, and ordered target means."""

import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from proclivity.models import training
from proclivity.operators import dictionaries, encoders
from proclivity.operators.sampling import stratified_split
from proclivity.presets import CUSTOMER_SPEC as SPEC
from proclivity.session import staged
from tests.conftest import make_customers, to_spark


def test_codes_follow_the_order_of_each_type(spark):
    day = datetime.date(2020, 1, 1)
    rows = [
        (2**60 + i, -i / 3, f"k{i:03}", Decimal(i) / 7, day + datetime.timedelta(i), i % 2 == 0)
        for i in range(200)
    ]
    df = spark.createDataFrame(
        rows, "l long, d double, s string, e decimal(20,6), t date, b boolean"
    ).repartition(7)
    rank = encoders.fit_category_index(df, list("ldsetb")).apply(df, ["l"])
    got = sorted(tuple(r) for r in rank.toDF("v", *"ldsetb").collect())
    assert got == [
        (2**60 + i, i, 199 - i, i, i, i, int(i % 2 == 0)) for i in range(200)
    ]


def test_odd_values(spark):
    df = spark.createDataFrame(
        [(None, 1), (float("nan"), 2), (0.5, 3), (-0.5, 4)], "d double, y int"
    )
    rows = encoders.fit_category_index(df, ["d"]).apply(df, ["y"]).orderBy("y")
    assert [r.d for r in rows.collect()] == [None, 2, 1, 0]
    none = df.limit(0)
    assert encoders.fit_category_index(none, ["d"]).apply(df).first().d is None
    strict = encoders.fit_ordinal_learned(df.where("d = 0.5"), ["d"])
    with pytest.raises(Exception, match="unknown level in column d"):
        strict.apply(df).collect()


def test_lookups_are_stored_with_their_pipeline(spark, tmp_path):
    df = spark.range(500).select((F.col("id") * 3).alias("c"), (F.col("id") % 2).alias("y"))
    fitted = encoders.fit_category_index(df, ["c"]) + encoders.fit_target_mean(df, ["c"], "y")
    stages, _ = fitted.stages()
    PipelineModel(stages).write().overwrite().save(str(tmp_path / "p"))
    new = spark.createDataFrame([(6,), (7,), (None,)], "c long")
    loaded = PipelineModel.load(str(tmp_path / "p"))
    want = [tuple(r) for r in PipelineModel(stages).transform(new).orderBy("c").collect()]
    got = [tuple(r) for r in loaded.transform(new).orderBy("c").collect()]
    assert got == want and want[1][1] == 2
    assert (tmp_path / "p").exists()


def by_hand(rows, key, weight=1.0):
    """Means over earlier rows of the same key, in the order of `rows`."""
    prior = sum(y for *_, y in rows) / len(rows)
    seen, out = {}, {}
    for row in rows:
        s, n = seen.get(row[key], (0, 0))
        out[row[0]] = (s + prior * weight) / (n + weight)
        seen[row[key]] = (s + row[-1], n + 1)
    return out


def test_ordered_means_for_any_number_of_ranges(spark, monkeypatch):
    draws = np.random.default_rng(3)
    # a third of the rows share a category
    rows = [
        (i, "hot" if i % 3 == 0 else f"c{draws.integers(0, 20)}", float(draws.integers(0, 9)), int(draws.integers(0, 2)))
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "id long, c string, v double, y int")
    order = {
        r.id: r.h
        for r in df.select("id", encoders.str_key("id"), dictionaries.hash_key("id").alias("h")).collect()
    }
    ordered = sorted(rows, key=lambda r: order[r[0]])
    for size in (100_000, 40):
        monkeypatch.setattr(dictionaries, "ORDERED_ROWS", size)
        got = dictionaries.ordered_means(df, {"c": "mc", "v": "mv"}, "y", ["id"]).collect()
        assert len(got) == 900
        for at, name in ((1, "mc"), (2, "mv")):
            want = by_hand(ordered, at)
            assert {r.id: r[name] for r in got} == pytest.approx(want)


def test_ordered_means_of_odd_rows(spark):
    df = spark.createDataFrame(
        [(None, None, 1), (None, None, None), (1, "a", 0), (1, "a", 0)], "id long, c string, y int"
    )
    rows = dictionaries.ordered_means(df, {"c": "m"}, "y", ["id"]).collect()
    assert len(rows) == 4 and all(0 <= r.m <= 1 for r in rows)
    assert dictionaries.ordered_means(df.limit(0), {"c": "m"}, "y", ["id"]).count() == 0


@pytest.mark.parametrize("name", ["gbt_categorical", "gbt_all_categorical"])
def test_noise_is_not_learned(spark, name):
    """Every value a category: in-sample means would tell all labels."""
    pdf = make_customers(3000, 78)
    draws = np.random.default_rng(78)
    pdf["Region_Code"] = draws.integers(0, 900, 3000).astype(float)
    pdf["Response"] = draws.integers(0, 2, 3000)
    parts = staged(stratified_split(to_spark(spark, pdf), "id", "Response"))
    bundle = training.fit_and_evaluate(
        name, parts, SPEC, {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1}
    )
    assert bundle.metrics["train"]["roc_auc"] < 0.66
    assert abs(bundle.metrics["train"]["roc_auc"] - bundle.metrics["test"]["roc_auc"]) < 0.15


def test_hashes_are_not_shuffled_for_each_column(spark):
    """A row's place among the others goes along as one number."""
    df = spark.range(100).selectExpr("id", "id % 3 AS a", "id % 2 AS y")
    made = dictionaries.ordered_means(df, {"a": "m"}, "y", ["id"])
    assert "md5" not in plan_of(made) and "__place" not in plan_of(made)
    assert made.columns == ["id", "a", "y", "m"] and made.count() == 100


def plan_of(df):
    return df._jdf.queryExecution().toString()
