"""Small exact examples of single operators."""

import bisect
import itertools
import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from proclivity.functions import scalar
from proclivity.operators import (
    cleaning,
    correlation,
    drift,
    encoders,
    evaluation,
    gates,
    lookups,
    profiling,
    registry,
    validate,
)
from proclivity.presets import AGE_EDGES, AGE_LABELS, CUSTOMER_SPEC
from proclivity.sources import readers, sinks
from tests.conftest import make_customers, to_spark

SPEC = CUSTOMER_SPEC


# --- checks ---------------------------------------------------------------------


def changed(spark, **columns):
    pdf = make_customers(200)
    for c, (rows, value) in columns.items():
        pdf.loc[pdf.index[:rows], c] = value
    return to_spark(spark, pdf)


def test_valid_rows_pass(customers):
    assert validate.feature_error(customers, SPEC) is None


def test_absent_column_is_named(customers):
    message = validate.feature_error(customers.drop("Age"), SPEC)
    assert message == "Age: column is absent"


def test_every_broken_rule_is_counted(spark):
    df = changed(
        spark,
        Gender=(3, "Unknown"),
        Annual_Premium=(2, None),
        Vintage=(4, -1),
    )
    assert validate.feature_error(df, SPEC).split("; ") == [
        "Annual_Premium: null in 2 rows",
        "Gender: not allowed in 3 rows",
        "Vintage: negative in 4 rows",
    ]


def test_all_unexpected_values_are_listed(spark):
    pdf = make_customers(200)
    pdf["Gender"] = [f"g{i % 60}" for i in range(200)]
    found = validate.unexpected_values(
        to_spark(spark, pdf), {"Gender": SPEC.allowed["Gender"]}
    )
    assert found.count() == 60


def test_text_in_a_numeric_column(customers):
    df = customers.withColumn("Age", F.col("Age").cast("string"))
    message = validate.feature_error(df, SPEC)
    assert message == "Age: not a numeric column"


def test_validate_raises(spark):
    with pytest.raises(validate.SchemaError, match="Gender"):
        validate.validate_features(changed(spark, Gender=(1, "?")), SPEC)


def test_target_must_be_binary(spark):
    df = changed(spark, Response=(1, 3))
    found = validate.check_batch(df, SPEC, validate.GateLimits())
    assert [(g.name, g.passed) for g in found] == [("schema", False)]
    assert found[0].detail == "Response: neither 0 nor 1 in 1 rows"


def test_gates_of_a_good_batch(customers):
    limits = validate.GateLimits(
        min_rows=5000, positive_rate=0.3, positive_rate_tolerance=0.3
    )
    found = {g.name: g.passed for g in validate.check_batch(
        customers, SPEC, limits)}
    assert found == {
        "schema": True, "min_rows": False, "positive_rate": True,
    }


# --- cleaning -------------------------------------------------------------------


def test_clean_removes_anomaly_null_and_copy(spark):
    pdf = make_customers(50)
    pdf.loc[0, "Region_Code"] = 39.2
    pdf.loc[1, "Vintage"] = None
    again = pdf.loc[[2]].assign(id=999)
    df = to_spark(spark, pd.concat([pdf, again]))
    got = {r["id"] for r in cleaning.clean(df, SPEC).collect()}
    assert got == set(range(2, 50))
    audit = cleaning.clean_audit(df, SPEC).toPandas()
    assert audit.n_removed.tolist() == [0, 1, 1, 1]


# --- scalar functions -------------------------------------------------------------


def test_age_bands_are_right_closed(spark):
    ages = [0, 1, 29, 30, 39, 40, 59, 60, 200, 201, None]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    band = scalar.age_band("a", AGE_EDGES, AGE_LABELS)
    got = [r[0] for r in df.select(band).collect()]
    assert got == [
        "nan", "20-29", "20-29", "30-39", "30-39", "40-49", "50-59", "60+",
        "60+", "nan", "nan",
    ]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,)], "x double")
    got = [r[0] for r in df.select(scalar.clip("x", 2.0, 8.0)).collect()]
    assert got == [2.0, 8.0, None]


def test_ratio_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 2)], "a int, b int")
    got = [r[0] for r in df.select(scalar.ratio("a", "b")).collect()]
    assert got == [0.0, 0.5]


# --- encoders ---------------------------------------------------------------------


def test_rare_categories_share_one_value(spark):
    """Two rare colours add up; unknown and missing ones count as rare."""
    rows = [("red",)] * 5 + [("blue",)] * 13 + [("teal",)] + [("pink",)]
    fitted = encoders.fit_frequency(
        spark.createDataFrame(rows, "c string"), ["c"], 0.1
    )
    want = {"red": 0.25, "blue": 0.65, "teal": 0.1, "pink": 0.1, "grey": 0.1, None: 0.1}
    new = spark.createDataFrame([(c,) for c in want], "c string")
    got = [r[0] for r in fitted.apply(new).collect()]
    assert got == pytest.approx(list(want.values()))


def test_nothing_rare_gives_zero(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    fitted = encoders.fit_frequency(df, ["c"], 0.05)
    new = spark.createDataFrame([("x",)], "c string")
    assert fitted.apply(new).first()[0] == 0.0


def test_quotes_in_categories(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",)] * 2, "c string")
    fitted = encoders.fit_frequency(df, ["c"], 0.05)
    assert {r[0] for r in fitted.apply(df).collect()} == {0.5}


def test_categories_are_frozen(spark):
    fitted = encoders.fit_category_index(
        spark.createDataFrame([(3.0,), (1.0,), (20.0,)], "c double"), ["c"]
    )
    new = spark.createDataFrame([(20.0,), (99.0,), (1.0,)], "c double")
    assert [r[0] for r in fitted.apply(new).collect()] == [2, None, 0]


def test_unknown_level_is_an_error(spark, customers):
    fitted = encoders.fit_onehot(customers, ["Gender"])
    assert fitted.names == ["Gender_Male"]
    new = spark.createDataFrame([("Other",)], "Gender string")
    with pytest.raises(Exception, match="unknown level"):
        fitted.apply(new).collect()


def test_levels_have_no_limit(spark):
    df = spark.range(3_000).select(F.col("id").alias("c"), F.lit("x").alias("d"))
    fitted = encoders.fit_category_index(df.union(df), ["c", "d"])
    got = sorted(tuple(r) for r in fitted.apply(df, ["c"]).toDF("v", "c", "d").collect())
    assert got == [(i, i, 0) for i in range(3_000)]


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "x double")
    assert encoders.fit_robust(df, ["x"]).apply(df).first()[0] == 0.0
    assert encoders.fit_standard(df, ["x"]).apply(df).first()[0] == 0.0


def test_encoded_names_and_values(customers, customers_pdf):
    fitted = encoders.fit_encoded_features(customers, SPEC)
    assert fitted.names == [
        "Annual_Premium", "Age", "Vintage", "Region_Code",
        "Policy_Sales_Channel", "Gender_Male", "Vehicle_Damage_Yes",
        "Previously_Insured_1", "Driving_License_1", "Vehicle_Age",
    ]
    got = fitted.apply(customers, ["id"]).toPandas().set_index("id")
    x = customers_pdf.Annual_Premium
    q = np.quantile(x, [0.25, 0.5, 0.75])
    assert np.allclose(
        got.Annual_Premium.loc[customers_pdf.id], (x - q[1]) / (q[2] - q[0])
    )
    a = customers_pdf.Age
    assert np.allclose(got.Age.loc[customers_pdf.id], (a - a.mean()) / a.std(
        ddof=0))
    assert not got.isna().any().any()


# --- drift ------------------------------------------------------------------------


def psi_by_counting(old, new):
    """The index from plain counts: a bin is what `bisect` finds in the
    deciles of the old values, and no share counts as less than 0.0001."""
    values = sorted(old)
    at = [(len(values) - 1) * k / 10 for k in range(1, 10)]
    edges = sorted(
        {
            values[int(x)] + (x % 1) * (values[min(int(x) + 1, len(values) - 1)] - values[int(x)])
            for x in at
        }
    )
    total = 0.0
    sides = [Counter(bisect.bisect_right(edges, v) if v == v else len(edges) for v in vs) for vs in (old, new)]
    for i in range(len(edges) + 1):
        was, now = (max(n[i] / n.total(), 0.0001) for n in sides)
        total += (now - was) * math.log(now / was)
    return total


def test_drift_equals_counting(spark):
    rng = np.random.default_rng(5)
    # ties at the bottom leave the first bin empty; NaN is the last bin
    old = np.where(rng.random(3000) < 0.3, 0.0, rng.random(3000))
    new = np.where(rng.random(2000) < 0.05, np.nan, rng.random(2000) * 1.3)
    frames = [
        spark.createDataFrame([(float(x),) for x in v], "x double")
        for v in (old, new)
    ]
    profile = drift.data_profile(frames[0], ["x"], [])
    got = drift.drift_report(profile, frames[1], rounded=False).first()["psi"]
    assert got == pytest.approx(psi_by_counting(old.tolist(), new.tolist()), abs=1e-9)
    same = drift.drift_report(profile, frames[0]).first()["psi"]
    assert same == 0.0


def test_drift_by_hand(spark):
    """Shares 1/2, 1/2 against 1/4, 3/4: (ln 2 + ln 3/2) / 4."""
    old = spark.createDataFrame([("a",), ("b",)], "c string")
    new = spark.createDataFrame([("a",)] + [("b",)] * 3, "c string")
    report = drift.drift_report(drift.data_profile(old, [], ["c"]), new, rounded=False)
    assert report.first()["psi"] == pytest.approx((math.log(2) + math.log(1.5)) / 4)


def test_moved_premiums_raise_the_alarm(spark, customers):
    """Only the column that moved reports drift."""
    profile = drift.data_profile(
        customers, SPEC.profile_numeric, SPEC.profile_categorical
    )
    dearer = customers.withColumn(
        "Annual_Premium", F.col("Annual_Premium") * 1.6 + 500
    )
    found = drift.drift_report(profile, dearer)
    moved = [r["feature"] for r in found.collect() if r["psi"] != 0.0]
    assert moved == ["Annual_Premium"]
    assert drift.drift_alarm(found).first()["alarm"]
    still = drift.drift_alarm(drift.drift_report(profile, customers)).first()
    assert not still["alarm"] and still["max_psi"] == 0.0


def test_empty_report_gives_no_alarm(spark):
    empty = spark.createDataFrame([], "feature string, psi double")
    assert drift.drift_alarm(empty).first()["alarm"] is False


# --- profiling --------------------------------------------------------------------


def test_near_duplicates_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [tuple(int(v) for v in r) for r in rng.integers(0, 4, (60, 3))]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = {
        r["column"]: (r["n_groups"], r["n_rows"])
        for r in profiling.near_duplicates(df, ["a", "b", "c"]).collect()
    }
    for i, c in enumerate("abc"):
        groups = {}
        for r in rows:
            rest = r[:i] + r[i + 1 :]
            groups.setdefault(rest, []).append(r[i])
        hit = [v for v in groups.values() if len(set(v)) > 1]
        if hit:
            assert got[c] == (len(hit), sum(map(len, hit)))


def test_phik_ends(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 5, 4000)
    noise = rng.integers(0, 5, 4000)
    near = np.where(rng.random(4000) < 0.5, a, noise)
    df = spark.createDataFrame(
        [tuple(map(int, r)) for r in zip(a, a, noise, near)],
        "a int, same int, noise int, near int",
    )
    keys = correlation.binned(df, [], ["a", "same", "noise", "near"])
    got = {
        (r["col_a"], r["col_b"]): r
        for r in correlation.phik_matrix(keys).collect()
    }
    assert got[("a", "same")]["phik"] == pytest.approx(1.0, abs=1e-6)
    assert got[("a", "noise")]["phik"] < 0.1
    assert 0.3 < got[("a", "near")]["phik"] < 0.95
    table = pd.crosstab(a, near).to_numpy()
    e = np.outer(table.sum(1), table.sum(0)) / table.sum()
    chi2 = ((table - e) ** 2 / e).sum()
    assert got[("a", "near")]["chi2"] == pytest.approx(chi2)


def test_phik_has_no_level_limit(monkeypatch):
    """Many levels, in blocks: the correlation that made the chi-square."""
    margin = np.full(300, 7.0)
    monkeypatch.setattr(correlation, "BLOCK_CELLS", 10_000)
    n, cells = margin.sum(), 300 * 300
    freedom = 299 * 299
    pedestal = freedom + 1.5 * np.sqrt(2 * freedom)
    scale = (n * 299 - pedestal) / correlation._normal_chi2(1.0, margin, margin)
    chi2 = pedestal + scale * correlation._normal_chi2(0.7, margin, margin)
    got = correlation.solve_phik(chi2, margin, margin, cells)
    assert got == pytest.approx(0.7, abs=1e-6)


def test_normal_cells_add_up():
    margin = np.array([10.0, 30.0, 60.0])
    values = [
        correlation._normal_chi2(r, margin, margin)
        for r in (0.0, 0.3, 0.6, 0.9, 1.0)
    ]
    assert values[0] == pytest.approx(0.0, abs=1e-9)
    assert all(x < y for x, y in itertools.pairwise(values))


def test_slice_delta_uses_common_slices(spark):
    schema = "slice_col string, slice_value string, roc_auc double"
    old = spark.createDataFrame(
        [("g", "a", 0.8), ("g", "b", 0.7)], schema
    )
    new = spark.createDataFrame(
        [("g", "b", 0.65), ("g", "c", 0.9)], schema
    )
    row = lookups.slice_delta(old, new).first()
    assert row["slice_value"] == "b"
    assert row["drop"] == pytest.approx(0.05)


# --- gates ------------------------------------------------------------------------


def test_no_common_slices_passes(spark):
    schema = "slice_col string, slice_value string, roc_auc double"
    old = spark.createDataFrame([("g", "a", 0.8)], schema)
    new = spark.createDataFrame([("g", "b", 0.1)], schema)
    gate = gates.slices_gate(old, new, validate.GateLimits())
    assert gate.passed
    assert gate.detail == "no slice in common"


def test_top_features_gate(spark):
    table = spark.createDataFrame(
        [("Age", 0.1), ("Vehicle_Damage_Yes", 0.5),
         ("Previously_Insured_1", 0.4)],
        "feature string, importance double",
    )
    expected = ("Vehicle_Damage", "Previously_Insured")
    assert gates.top_features_gate(table, expected).passed
    assert not gates.top_features_gate(table, ("Age", "Vehicle")).passed


def test_confusion_metrics_without_hits(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.2)], "y int, p double")
    row = evaluation.confusion_metrics(df, "y", "p").first()
    assert tuple(row) == (0.0, 0.0, 0.0)


# --- registry ---------------------------------------------------------------------


def test_promote_and_rollback(spark):
    events = spark.createDataFrame(
        [("v1", 1, "candidate"), ("v1", 2, "production"),
         ("v2", 3, "candidate")],
        "version string, seq long, status string",
    )
    v2 = spark.createDataFrame([("v2",)], "version string")
    v1 = spark.createDataFrame([("v1",)], "version string")
    after = events.unionByName(registry.promote(events, v2))
    state = {
        r["version"]: r["status"]
        for r in registry.current_versions(after).collect()
    }
    assert state == {"v1": "archived", "v2": "production"}
    back = after.unionByName(registry.rollback(after, v2, v1))
    state = {
        r["version"]: r["status"]
        for r in registry.current_versions(back).collect()
    }
    assert state == {"v1": "production", "v2": "rolled_back"}
    assert registry.production_version(back).first()["version"] == "v1"
    assert registry.register(back, "rejected").first()["version"] == "v3"


# --- sources ----------------------------------------------------------------------


def test_missing_path_is_a_clear_error(spark):
    with pytest.raises(readers.MissingInput, match="not found"):
        readers.read_typed(spark, "/tmp/no-such-file.csv", "id long")


def test_float_codes_survive_csv(spark, tmp_path):
    from proclivity.presets import CUSTOMER_SCHEMA

    pdf = make_customers(20)
    pdf.loc[0, "Region_Code"] = 39.2
    path = str(tmp_path / "c.csv")
    pdf.to_csv(path, index=False)
    df = readers.read_typed(spark, path, CUSTOMER_SCHEMA)
    kept = cleaning.drop_anomaly(df, "Region_Code", 39.2)
    assert kept.count() == 19


def test_column_order_of_a_csv_does_not_matter(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    pd.DataFrame({"b": ["x"], "a": [1]}).to_csv(path, index=False)
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_typed(spark, path, "a int, b string").collect()


def test_manifest_ignores_row_order(customers):
    shuffled = customers.orderBy(F.rand(1))
    assert (
        readers.table_manifest(customers).first()
        == readers.table_manifest(shuffled).first()
    )


def test_override_needs_one_model():
    with pytest.raises(ValueError, match="one model"):
        readers.check_override({"C": 1}, ["logreg", "gbt"])
    readers.check_override({"C": 1}, ["logreg"])
    assert readers.merge_params({"a": 1, "b": 2}, {"b": 3}) == {
        "a": 1, "b": 3,
    }


def test_rounding_of_reports(spark):
    df = spark.createDataFrame([("m", 0.123456)], "model string, f1 double")
    assert sinks.rounded(df).first()["f1"] == 0.1235


def test_reasons_to_retrain(spark):
    rows = [(10, 0.0, 0.9, False, False), (10, 0.3, 0.9, True, False), (10, 0.3, 0.7, True, False),
            (10, 0.3, 0.7, True, True), (1, 0.0, 0.9, True, False), (1, 0.0, 0.9, False, False)]
    df = spark.createDataFrame(rows, "n int, psi double, auc double, due boolean, hand boolean")
    reason = drift.retrain_trigger(
        F.col("n"), F.lit(100), F.col("psi"), F.col("auc"), F.col("due"), manual=F.col("hand")
    )
    assert [r[0] for r in df.select(reason).collect()] == [
        "new_data", "drift", "degradation", "manual", "schedule", "none",
    ]


def test_table_with_other_is_applied(spark):
    df = spark.createDataFrame([("a",)] * 8 + [("b",), ("c",)], "c string")
    fitted = encoders.fit_table_with_other(df, "c", 0.2, "OTHER")
    new = spark.createDataFrame([("a",), ("b",), ("new",), ("OTHER",), (None,)], "c string")
    got = [round(r[0], 6) for r in fitted.apply(new).collect()]
    assert sorted(got) == [0.2, 0.2, 0.2, 0.2, 0.8]


def test_first_rows(spark):
    df = spark.range(30).orderBy(F.rand(1))
    assert [r.id for r in profiling.first_rows(df, "id", 3).collect()] == [0, 1, 2]
    assert profiling.first_rows(df.limit(0), "id").count() == 0
