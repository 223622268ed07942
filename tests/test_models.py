"""Fits, bundles, searches, cycles and streams on a known signal."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from proclivity.models import builders, search, training
from proclivity.models.bundle import ModelBundle, linear_score_sql
from proclivity.models.store import ModelRegistry
from proclivity.operators import encoders
from proclivity.operators.sampling import stratified_split
from proclivity.operators.validate import GateLimits, SchemaError
from proclivity.plans.retrain import check_drift, run_cycle
from proclivity.presets import CUSTOMER_SCHEMA, CUSTOMER_SPEC, SEARCH_RANGES
from proclivity.session import staged
from proclivity.streaming import arriving
from tests.conftest import make_customers, to_spark

SPEC = CUSTOMER_SPEC
FAST = {
    "logreg": {"max_iter": 100, "tol": 1e-9},
    "random_forest": {
        "n_estimators": 10, "max_depth": 5, "max_samples": 0.8,
        "min_samples_leaf": 5,
    },
    "gbt": {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.3},
    "gbt_categorical": {
        "n_estimators": 8, "max_depth": 3, "learning_rate": 0.3,
        "colsample_bytree": 1.0,
    },
    "gbt_all_categorical": {
        "n_estimators": 8, "max_depth": 3, "learning_rate": 0.3,
        "colsample_bytree": 1.0,
    },
}
#: Limits that batches of the test signal meet.
WIDE = GateLimits(
    positive_rate=0.25, positive_rate_tolerance=0.15, min_rows=1200,
    min_auc=0.7, max_auc_drop=0.1, max_f1_drop=0.2, max_slice_auc_drop=0.25,
    min_slice_rows=80, expected_top_features=(),
)


@pytest.fixture(scope="module")
def split(customers):
    return staged(stratified_split(customers, "id", "Response"))


@pytest.fixture(scope="module")
def logreg(split):
    return training.fit_and_evaluate("logreg", split, SPEC, FAST["logreg"])


@pytest.mark.parametrize("name", list(FAST))
def test_every_model_finds_the_signal(spark, split, name):
    bundle = training.fit_and_evaluate(name, split, SPEC, FAST[name])
    assert bundle.metrics["test"]["roc_auc"] > 0.75
    rows = bundle.predict(split).toPandas()
    assert rows.probability.between(0, 1).all()
    assert (rows.prediction == (rows.probability >= 0.5)).all()
    top = bundle.importance(spark).collect()
    assert len(top) == len(bundle.feature_names)
    # coefficients of unscaled shares and many-valued categories may rank
    # above the signal; impurity gains of the plain features may not
    if name in ("random_forest", "gbt"):
        assert top[0]["feature"].startswith(
            ("Vehicle_Damage", "Previously_Insured")
        )


def test_logreg_minimises_the_documented_objective(split, logreg):
    """C * sum(w * loss) + elastic net, checked by its gradient."""
    train = split.filter("split = 'train'")
    encoder = encoders.fit_encoded_features(train, SPEC)
    pdf = encoder.apply(train, ["Response"]).toPandas()
    y = pdf.pop("Response").to_numpy(float)
    x = pdf.to_numpy(float)
    sizes = builders.class_sizes(train, "Response")
    weights = builders.balanced_weights(sizes)
    w = np.where(y == 1, weights[1], weights[0])
    model = logreg.pipeline.stages[-1]
    beta, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ beta + b)))
    c, l1 = 100, 0.1
    slope = c * x.T @ (w * (p - y)) + (1 - l1) * beta
    slope += l1 * np.sign(beta)
    scale = c * np.abs(x).T @ w
    assert np.all(np.abs(slope) / scale < 1e-5)
    assert abs(w @ (p - y)) / w.sum() < 1e-6


def test_linear_model_as_sql(split, logreg):
    train = split.filter("split = 'train'")
    encoder = encoders.fit_encoded_features(train, SPEC)
    model = logreg.pipeline.stages[-1]
    sql = linear_score_sql(
        list(encoder.expressions.values()),
        list(model.coefficients.toArray()),
        model.intercept,
    )
    both = logreg.probability(split, split.columns).withColumn(
        "sql", F.expr(sql)
    )
    gap = both.agg(F.max(F.abs(F.col("sql") - F.col("probability"))))
    assert gap.first()[0] < 1e-12


def test_bundle_round_trip(spark, split, logreg, tmp_path):
    path = logreg.save(str(tmp_path / "m"))
    again = ModelBundle.load(spark, path, SPEC)
    assert again.feature_names == logreg.feature_names
    a = logreg.predict(split).toPandas().sort_values("id")
    b = again.predict(split).toPandas().sort_values("id")
    assert np.array_equal(a.probability, b.probability)


def test_foreign_folder_is_refused(spark, tmp_path):
    with pytest.raises(TypeError, match="does not contain"):
        ModelBundle.load(spark, str(tmp_path / "nothing"), SPEC)


def test_key_is_optional_for_scoring(split, logreg):
    rows = logreg.predict(split.drop("id"))
    assert rows.columns == ["probability", "prediction"]


def test_scoring_checks_its_input(split, logreg):
    bad = split.withColumn("Gender", F.lit("Other"))
    with pytest.raises(SchemaError, match="Gender"):
        logreg.predict(bad)


def test_unseen_codes_are_scored(split):
    bundle = training.fit_and_evaluate("gbt", split, SPEC, FAST["gbt"])
    new = split.withColumn("Region_Code", F.lit(49.0))
    assert bundle.predict(new).filter("probability is null").count() == 0


def test_unknown_model():
    with pytest.raises(ValueError, match="choose from"):
        builders.PropensityModel(name="svm", spec=SPEC)


def test_target_means_do_not_leak(spark):
    """A code of pure noise, with a few rows each, must not be learned."""
    pdf = make_customers(3000, 77)
    draws = np.random.default_rng(77)
    pdf["Region_Code"] = draws.integers(0, 900, 3000).astype(float)
    pdf["Response"] = draws.integers(0, 2, 3000)
    rows = to_spark(spark, pdf)
    parts = staged(stratified_split(rows, "id", "Response"))
    bundle = training.fit_and_evaluate(
        "gbt_categorical", parts, SPEC, FAST["gbt_categorical"]
    )
    # in-sample means alone would tell most labels of the training rows
    assert bundle.metrics["train"]["roc_auc"] < 0.7


def test_unknown_parameters_are_refused():
    with pytest.raises(ValueError, match="num_leaves"):
        builders.model_params("gbt", {"num_leaves": 31})
    for name in builders.MODEL_NAMES:
        assert builders.model_params(name)


def test_train_models_writes_everything(spark, split, tmp_path):
    out = str(tmp_path / "run")
    table = training.train_models(
        ["gbt"], split, SPEC, out, params=FAST["gbt"]
    )
    assert table.first()["model"] == "gbt"
    stored = spark.read.csv(f"{out}/comparison", header=True)
    assert stored.columns == [
        "model", "precision", "recall", "f1", "roc_auc", "fit_seconds",
    ]
    assert spark.read.json(f"{out}/gbt/metrics").count() == 1


def test_prepare_split(customers):
    parts = training.prepare_split(customers, SPEC, frac=0.5)
    rows = {r["split"]: r["count"] for r in parts.groupBy("split").count(
        ).collect()}
    assert sum(rows.values()) in (999, 1000, 1001)
    assert rows["test"] == -(-sum(rows.values()) // 4)


def test_grid_search(customers):
    grid = {"C": [0.0001, 100], "l1_ratio": [0.5], "max_iter": [30]}
    best, score, table = search.grid_search(
        "logreg", customers, SPEC, grid, folds=2
    )
    assert set(best) == set(grid)
    assert 0 <= score <= 1
    rows = table.toPandas()
    assert rows["rank"].min() == 1
    assert rows.mean_score.max() == pytest.approx(score)


def test_random_search(customers):
    best, score, trials = search.random_search(
        "logreg", customers, SPEC, n_trials=2, folds=2
    )
    assert set(best) == set(SEARCH_RANGES["logreg"])
    assert 0 <= score <= 1
    assert trials.count() == 2
    assert search.best_trial(trials).first()["score"] == score


def test_draws_stay_in_their_ranges():
    import random

    for ranges in SEARCH_RANGES.values():
        for seed in range(20):
            params = search.draw(ranges, random.Random(seed))
            for key, (kind, low, high) in ranges.items():
                assert low <= params[key] <= high
                assert isinstance(params[key], int) == kind.startswith("int")


def test_pruning_rule():
    earlier = [[0.5, 0.5], [0.7, 0.6]]
    assert search.should_prune([0.55], earlier)
    assert not search.should_prune([0.65], earlier)
    assert not search.should_prune([0.1], earlier[:1])


# --- the cycle ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def quarters(spark):
    """Four batches of the same customers' kind, by name."""
    return {
        f"q{i}": to_spark(spark, make_customers(1600, 40 + i, 10_000 * i))
        for i in range(1, 5)
    }


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    registry = ModelRegistry(spark, str(tmp_path_factory.mktemp("registry")))

    def go(batches, approved_by="duty", **more):
        return run_cycle(
            batches, registry, SPEC, approved_by=approved_by,
            model_name="logreg", params={"max_iter": 40}, limits=WIDE, **more,
        )

    go.registry = registry
    return go


def picked(quarters, *names):
    return {n: quarters[n] for n in names}


def test_cycles_end_as_their_outcomes_say(quarters, run):
    registry = run.registry
    deployed = run(picked(quarters, "q1"))
    assert (deployed.status, deployed.champion) == ("deployed", None)
    assert {o.step for o in deployed.outcomes} == {"data", "quality", "deploy"}
    replaced = run(picked(quarters, "q1", "q2"), trigger="schedule")
    assert (replaced.status, replaced.champion) == ("deployed", deployed.version)
    assert replaced.facts["train_rows"] == 1600 + 1200
    assert max(replaced.facts["drift"].values()) < 0.1
    assert registry.status(deployed.version) == "archived"

    # a fifth of the premiums lost, and some below zero
    premium = F.col("Annual_Premium")
    broken = quarters["q3"].withColumn(
        "Annual_Premium",
        F.when(F.col("id") % 5 > 0, F.when(F.col("id") % 7 > 0, premium).otherwise(-premium)),
    )
    refused = run({"q3": broken})
    assert (refused.status, refused.version) == ("rejected_data", None)
    assert refused.failed[0].detail.count("Annual_Premium") == 2

    # responses that have nothing to do with the customers
    noise = quarters["q3"].withColumn(
        "Response", (F.xxhash64("id") % 4 == 0).cast("int")
    )
    weak = run({"q3": noise})
    assert weak.status == "rejected_quality"
    assert "min_auc" in [g.name for g in weak.failed]
    assert registry.status(weak.version) == "rejected"

    waiting = run(picked(quarters, "q4"), approved_by=None)
    assert waiting.status == "not_approved" and not waiting.failed

    def down(bundle, control):
        raise OSError("scoring service is down")

    undone = run(picked(quarters, "q4"), smoke_test=down)
    assert undone.status == registry.status(undone.version) == "rolled_back"
    assert undone.failed[0].detail == "scoring service is down"

    assert registry.production_version() == replaced.version
    assert registry.meta(replaced.version)["approved_by"] == "duty"
    ends = [r.status for r in registry.reports().orderBy("cycle").collect()]
    assert ends == [
        x.status for x in (deployed, replaced, refused, weak, waiting, undone)
    ]
    levels = registry.notifications().groupBy("level").count().collect()
    assert {r.level: r["count"] for r in levels} == {
        "INFO": 3, "WARNING": 1, "ERROR": 2,
    }


def test_drift_alarm_of_the_version_in_use(quarters, run):
    usual, alarm = check_drift(quarters["q4"], run.registry)
    assert not alarm
    richer = quarters["q4"].withColumn("Annual_Premium", F.col("Annual_Premium") * 3)
    found, alarm = check_drift(richer, run.registry)
    assert alarm and found["Annual_Premium"] > 10 * usual["Annual_Premium"]


def test_no_production_no_alarm(spark, customers, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "empty"))
    assert check_drift(customers, registry) == ({}, False)
    assert registry.next_cycle() == 1
    with pytest.raises(KeyError):
        registry.status("v1")


# --- streams ------------------------------------------------------------------------


def test_stream_scores_like_batch(spark, customers, logreg, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    customers.write.parquet(source)
    stream = arriving.read_arriving(spark, source, CUSTOMER_SCHEMA)
    arriving.write_available(
        arriving.score_stream(stream, logreg), out, str(tmp_path / "state")
    )
    got = spark.read.parquet(out).toPandas().sort_values("id")
    expected = logreg.predict(customers).toPandas().sort_values("id")
    assert np.array_equal(got.probability, expected.probability)


def test_bad_rows_do_not_end_a_stream(spark, customers, logreg, tmp_path, monkeypatch):
    """Rejects have reasons, and a batch that fails halfway is repeated."""
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    bad = customers.withColumns(
        {
            "Gender": F.when(F.col("id") % 50 == 0, "?").otherwise(F.col("Gender")),
            "Annual_Premium": F.when(F.col("id") % 75 == 0, None).otherwise(
                F.col("Annual_Premium")
            ),
        }
    )
    bad.write.parquet(source)
    stream = arriving.read_arriving(spark, source, CUSTOMER_SCHEMA)
    whole, broken = ModelBundle.probability, []

    def fail_once(self, df, keep):
        if not broken:
            broken.append(1)
            raise OSError("lost")
        return whole(self, df, keep)

    monkeypatch.setattr(ModelBundle, "probability", fail_once)
    with pytest.raises(Exception, match="lost"):
        arriving.run_checked_scores(stream, logreg, out, state)
    for _ in range(2):
        arriving.run_checked_scores(stream, logreg, out, state)
    rejects = {
        r.id: r.reason for r in spark.read.parquet(f"{out}/rejects").collect()
    }
    ids = {r.id for r in customers.select("id").collect()}
    assert set(rejects) == {i for i in ids if i % 50 == 0 or i % 75 == 0}
    assert sorted(rejects[150].split("; ")) == [
        "Annual_Premium: null", "Gender: not allowed",
    ]
    scored = [r.id for r in spark.read.parquet(f"{out}/scores").collect()]
    assert sorted(scored) == sorted(ids - set(rejects))


def test_patience_rule():
    stop = builders.patience_stop
    assert stop([3, 2, 1, 2, 2, 0], 2) == (3, 5)
    assert stop([3, 2, 1, 2, 2, 0], 3) == (6, 6)
    assert stop([1, 1, 1, 1], 2) == (1, 3)  # equal is no gain
    assert stop([3, 2, 1], 100) == (3, 3)
    assert stop([5.0], 1) == (1, 1)


def test_early_stopping_keeps_the_best_trees(spark, customers, tmp_path):
    """The curve is the log loss of held-out rows under each cut model."""
    from pyspark.ml import PipelineModel

    rows = staged(
        stratified_split(customers, "id", "Response").withColumn(
            "is_val", (F.col("id") % 4 == 0) & (F.col("split") == "train")
        )
    )
    settings = {
        "n_estimators": 12, "max_depth": 4, "learning_rate": 0.8, "scale_pos_weight": 1.0,
        "validation_col": "is_val", "early_stopping_rounds": 3,
    }
    bundle = training.fit_and_evaluate("gbt", rows, SPEC, settings)
    curve, model = bundle.metrics["curve"], bundle.pipeline.stages[-1]
    kept, seen = builders.patience_stop(curve, 3)
    assert model.getNumTrees == kept and len(curve) == seen < 12
    held = rows.where("is_val")
    for n in (1, kept):
        cut = PipelineModel(
            [*bundle.pipeline.stages[:-1], builders.first_trees(model, n)]
        )
        at = ModelBundle("gbt", cut, SPEC, bundle.feature_names)
        p = F.when(F.col("Response") == 1, F.col("probability")).otherwise(
            1 - F.col("probability")
        )
        loss = at.probability(held, ["Response"]).agg(F.avg(-2 * F.log(p))).first()[0]
        assert loss == pytest.approx(curve[n - 1])
    path = training.save_run(bundle, str(tmp_path), spark)
    stored = spark.read.parquet(f"{path}/validation_curve").orderBy("trees")
    assert [r.kept for r in stored.collect()] == [i < kept for i in range(seen)]
    again = ModelBundle.load(spark, f"{path}/model", SPEC)
    assert again.predict(held).exceptAll(bundle.predict(held)).isEmpty()
    with pytest.raises(ValueError, match="validation_col"):
        training.fit_and_evaluate(
            "gbt", rows, SPEC, {"n_estimators": 2, "max_depth": 2, "early_stopping_rounds": 2}
        )


def test_a_threshold_of_zero_counts(split):
    bundle = training.fit_and_evaluate(
        "logreg", split, SPEC, FAST["logreg"], threshold=0.9
    )
    row = training.evaluate(bundle, split, threshold=0.0)[0]
    assert row["recall"] == 1.0
