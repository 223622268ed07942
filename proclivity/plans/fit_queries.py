"""Queries that fit models: training, search, scoring, cycles, streams.

Fits use small settings; what is checked is the behaviour around them. Where
the answer does not depend on the fitted numbers there is a SQL answer too.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from proclivity.models import builders, search, training
from proclivity.models.bundle import ModelBundle
from proclivity.models.store import ModelRegistry
from proclivity.operators import drift as drifting
from proclivity.operators import ranking
from proclivity.operators.gates import reload_gate
from proclivity.operators.profiling import quantile_cuts
from proclivity.operators.sampling import (
    control_rows,
    stratified_split,
    train_val_test_split,
)
from proclivity.operators.validate import GateLimits, gate_rows
from proclivity.plans.catalog import query, rounded
from proclivity.plans.frames import (
    OC,
    SCHEMAS,
    SCORING_SPEC,
    creditors,
    customers,
    scratch,
    table,
)
from proclivity.plans.model_queries import _metrics_cte
from proclivity.plans.profile_queries import DECILES_SQL
from proclivity.plans.retrain import run_cycle
from proclivity.session import staged
from proclivity.sources import sinks
from proclivity.streaming import arriving

SMALL = {
    "logreg": {"max_iter": 50},
    "random_forest": {
        "n_estimators": 10,
        "max_depth": 5,
        "max_samples": 0.5,
        "min_samples_leaf": 20,
    },
    "gbt": {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1},
    "gbt_categorical": {
        "n_estimators": 5,
        "max_depth": 3,
        "learning_rate": 0.1,
        "max_bins": 64,
    },
    "gbt_all_categorical": {
        "n_estimators": 5,
        "max_depth": 3,
        "learning_rate": 0.1,
        "max_bins": 64,
    },
}
METRIC_SCHEMA = (
    "part string, precision double, recall double, f1 double, roc_auc double"
)


def _columns():
    spec = SCORING_SPEC
    return [spec.id, spec.target, *spec.features]


def _split(spark, sf):
    df = creditors(spark, sf).select(*_columns())
    return staged(stratified_split(staged(df), "id", "y"))


def _fit(spark, sf, name, params=None):
    split = _split(spark, sf)
    bundle = training.fit_and_evaluate(
        name, split, SCORING_SPEC, {**SMALL[name], **(params or {})}
    )
    return split, bundle


def _metrics_of(spark, bundle):
    rows = [
        (part, *[float(bundle.metrics[part][m] or 0.0)
                 for m in training.METRICS])
        for part in ("train", "test")
    ]
    return rounded(training.local_table(spark, rows, METRIC_SCHEMA))


def _fit_query(name):
    def run(spark, sf):
        split, bundle = _fit(spark, sf, name)
        return _metrics_of(spark, bundle)

    return run


query("fit_logreg")(_fit_query("logreg"))
query("fit_random_forest")(_fit_query("random_forest"))
query("fit_gbt")(_fit_query("gbt"))
query("fit_gbt_categorical")(_fit_query("gbt_categorical"))
query("fit_all_categorical")(_fit_query("gbt_all_categorical"))


@query("early_stopping_fit")
def early_stopping_fit(spark, sf):
    """The stored curve of a model that stops after rounds without gain."""
    parts = staged(
        train_val_test_split(
            creditors(spark, sf).select(*_columns()), "id", "y", 0.25, 0.2
        )
    )
    data = parts.withColumn("is_val", F.col("split") == "val").withColumn(
        "split", F.when(F.col("split") == "test", "test").otherwise("train")
    )
    settings = {
        **SMALL["gbt"],
        "n_estimators": 30,
        "learning_rate": 0.5,
        "validation_col": "is_val",
        "early_stopping_rounds": 5,
    }
    bundle = training.fit_and_evaluate("gbt", data, SCORING_SPEC, settings)
    path = training.save_run(bundle, scratch(spark), spark)
    return rounded(spark.read.parquet(f"{path}/validation_curve"))


@query(
    "fit_and_evaluate",
    f"""WITH {OC} SELECT CAST(count(*) - ceil(0.25 * count(*)) AS BIGINT)
      AS n_train, CAST(ceil(0.25 * count(*)) AS BIGINT) AS n_test FROM oc""",
)
def fit_and_evaluate(spark, sf):
    split, bundle = _fit(spark, sf, "logreg")
    rows = [(bundle.metrics["n_train"], bundle.metrics["n_test"])]
    return training.local_table(spark, rows, "n_train long, n_test long")


@query("train_models")
def train_models(spark, sf):
    split = _split(spark, sf)
    table_ = None
    for name in ("logreg", "random_forest"):
        one = training.train_models(
            [name], split, SCORING_SPEC, params=SMALL[name]
        )
        table_ = one if table_ is None else table_.unionByName(one)
    return sinks.rounded(table_)


@query(
    "feature_names",
    """SELECT CAST(slot AS INTEGER) AS slot, feature FROM (VALUES
      (0, 'o_totalprice'), (1, 'credit'), (2, 'in_debt'),
      (3, 'o_orderpriority'), (4, 'c_nationkey')) AS t(slot, feature)""",
)
def feature_names(spark, sf):
    split, bundle = _fit(spark, sf, "gbt")
    rows = list(enumerate(bundle.feature_names))
    return training.local_table(spark, rows, "slot int, feature string")


@query("feature_importance")
def feature_importance(spark, sf):
    split, bundle = _fit(spark, sf, "random_forest")
    return rounded(bundle.importance(spark))


@query("importance_sorted")
def importance_sorted(spark, sf):
    split, bundle = _fit(spark, sf, "logreg")
    weights = rounded(bundle.importance(spark))
    return ranking.top_k(
        weights, "importance", "feature", len(bundle.feature_names)
    )


@query("model_comparison")
def model_comparison(spark, sf):
    split = _split(spark, sf)
    bundles = [
        training.fit_and_evaluate(n, split, SCORING_SPEC, SMALL[n])
        for n in ("logreg", "gbt")
    ]
    return sinks.rounded(training.metric_rows(spark, bundles))


@query(
    "sink_comparison",
    f"""WITH {OC}, {_metrics_cte("a", "oc", "score", 0.5)},
    {_metrics_cte("b", "oc", "score_b", 0.5)}
    SELECT 'score' AS model, round_even(precision, 4) AS precision,
      round_even(recall, 4) AS recall, round_even(f1, 4) AS f1,
      round_even(roc_auc, 4) AS roc_auc FROM a
    UNION ALL SELECT 'score_b', round_even(precision, 4),
      round_even(recall, 4), round_even(f1, 4), round_even(roc_auc, 4)
    FROM b""",
)
def sink_comparison(spark, sf):
    from proclivity.operators.evaluation import METRICS, classification_metrics

    df = customers(spark, sf)
    rows = None
    for score in ("score", "score_b"):
        one = classification_metrics(df, "y", score).select(
            F.lit(score).alias("model"), *METRICS
        )
        rows = one if rows is None else rows.unionByName(one)
    path = scratch(spark)
    sinks.write_comparison(rows, path)
    schema = (
        "model string, precision double, recall double, f1 double, "
        "roc_auc double"
    )
    return spark.read.schema(schema).csv(path, header=True)


@query("sink_run_artifacts")
def sink_run_artifacts(spark, sf):
    split, bundle = _fit(spark, sf, "logreg")
    path = training.save_run(bundle, scratch(spark), spark)
    return spark.read.schema("feature string, importance double").csv(
        f"{path}/feature_importance", header=True
    )


@query(
    "model_save_load",
    f"""WITH {OC} SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS same
    FROM oc""",
)
def model_save_load(spark, sf):
    split, bundle = _fit(spark, sf, "logreg")
    path = bundle.save(f"{scratch(spark)}/model")
    again = ModelBundle.load(spark, path, SCORING_SPEC)
    before = bundle.probability(split, ["id"])
    after = again.probability(split, ["id"]).withColumnRenamed(
        "probability", "again"
    )
    return before.join(after, "id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.col("probability") == F.col("again")).alias("same"),
    )


@query(
    "gate_reload",
    f"""WITH {OC}, s AS (SELECT y, count(*) AS n FROM oc GROUP BY y)
    SELECT 'load_test' AS name, true AS passed, concat('0 of ',
      least(100, ceil(sum(n) / 4.0)::BIGINT), ' control rows differ after reloading')
      AS detail FROM s""",
)
def gate_reload(spark, sf):
    split, bundle = _fit(spark, sf, "gbt")
    path = bundle.save(f"{scratch(spark)}/model")
    again = ModelBundle.load(spark, path, SCORING_SPEC)
    test = split.filter(F.col("split") == "test").drop("split")
    control = control_rows(test, "id")
    gate = reload_gate(bundle.predict(control), again.predict(control), "id")
    return gate_rows(spark, [gate])


@query("score_batch")
def score_batch(spark, sf):
    split, bundle = _fit(spark, sf, "logreg")
    new = creditors(spark, sf).select("id", *SCORING_SPEC.features)
    return rounded(bundle.predict(new))


# --- search -------------------------------------------------------------------


def _search_data(spark, sf):
    return staged(creditors(spark, sf).select(*_columns()))


@query("grid_search")
def grid_search(spark, sf):
    grid = {"C": [0.1, 100], "l1_ratio": [0.1], "max_iter": [20]}
    best, score, _ = search.grid_search(
        "logreg", _search_data(spark, sf), SCORING_SPEC, grid, folds=2
    )
    return training.local_table(
        spark, [(str(best), round(score, 6))], "params string, score double"
    )


@query("cv_results_table")
def cv_results_table(spark, sf):
    grid = {"n_estimators": [2, 4], "max_depth": [2], "learning_rate": [0.1]}
    _, _, results = search.grid_search(
        "gbt", _search_data(spark, sf), SCORING_SPEC, grid, folds=2
    )
    return rounded(results)


@query("random_search")
def random_search(spark, sf):
    _, _, trials = search.random_search(
        "logreg", _search_data(spark, sf), SCORING_SPEC, n_trials=2, folds=2
    )
    return trials.select("trial", "params", "score", "state")


@query("cv_score")
def cv_score(spark, sf):
    score = search.cv_score(
        "logreg", _search_data(spark, sf), SCORING_SPEC,
        SMALL["logreg"], folds=2,
    )
    return training.local_table(spark, [(round(score, 6),)], "f1 double")


# --- cycle --------------------------------------------------------------------

CYCLE_LIMITS = GateLimits(
    min_auc=0.4,
    max_auc_drop=0.2,
    max_f1_drop=0.5,
    max_slice_auc_drop=0.5,
    positive_rate=0.33,
    positive_rate_tolerance=0.1,
    min_rows=100,
    min_slice_rows=50,
    expected_top_features=(),
)


@query(
    "retrain_cycle",
    f"""WITH {OC}, b AS (SELECT batch_no, count(*) >= 100
      AND abs(avg(CAST(y AS DOUBLE)) - 0.33) <= 0.1 AS ok,
      count(*) FILTER (id % 97 = 0) AS n_missing FROM oc GROUP BY batch_no)
    SELECT CAST(batch_no AS INTEGER) AS cycle, CASE WHEN ok THEN 'deployed'
      ELSE 'rejected_data' END AS status FROM b
    UNION ALL SELECT 3, CASE WHEN n_missing > 0 THEN 'rejected_data'
      ELSE 'deployed' END FROM b WHERE batch_no = 2""",
)
def retrain_cycle(spark, sf):
    registry = ModelRegistry(spark, scratch(spark))
    df = creditors(spark, sf).select(*_columns(), "batch_no")
    first, second = (
        df.filter(F.col("batch_no") == n).drop("batch_no") for n in (1, 2)
    )
    # accepted, accepted against a champion, rejected for its labels
    broken = second.withColumn(
        "y", F.when(F.col("id") % 97 != 0, F.col("y"))
    )
    for batches in (
        {"batch_1": first},
        {"batch_1": first, "batch_2": second},
        {"batch_1": first, "batch_2": broken},
    ):
        run_cycle(
            batches, registry, SCORING_SPEC, approved_by="on duty",
            model_name="logreg", params=SMALL["logreg"], limits=CYCLE_LIMITS,
        )
    return registry.reports().select("cycle", "status")


@query(
    "retrain_endings",
    f"""WITH {OC}, b AS (SELECT count(*) >= 100
      AND abs(avg(CAST(y AS DOUBLE)) - 0.33) <= 0.1 AS ok
      FROM oc WHERE batch_no = 1),
    e AS (SELECT unnest([1, 2, 3]) AS cycle, unnest(['rejected_quality',
      'not_approved', 'rolled_back']) AS status)
    SELECT CAST(cycle AS INTEGER) AS cycle,
      CASE WHEN ok THEN status ELSE 'rejected_data' END AS status FROM e, b""",
)
def retrain_endings(spark, sf):
    """Endings besides those of retrain_cycle, each by what leads to it."""
    registry = ModelRegistry(spark, scratch(spark))
    df = creditors(spark, sf).select(*_columns(), "batch_no")
    batches = {"batch_1": df.filter(F.col("batch_no") == 1).drop("batch_no")}

    def down(bundle, control):
        raise OSError("scoring service is down")

    for changes in (
        {"limits": replace(CYCLE_LIMITS, min_auc=1.01)},
        {"approved_by": None},
        {"smoke_test": down},
    ):
        settings = {"approved_by": "on duty", "limits": CYCLE_LIMITS}
        run_cycle(
            batches, registry, SCORING_SPEC, model_name="logreg",
            params=SMALL["logreg"], **settings | changes,
        )
    return registry.reports().select("cycle", "status")


# --- streams ------------------------------------------------------------------


def _defects(df):
    """Rows as they might arrive: some with a null, an unknown level or a
    negative amount, some with two of them."""
    i = F.col("id")
    return df.withColumns(
        {
            "o_totalprice": F.when(i % 97 != 0, F.col("o_totalprice")),
            "in_debt": F.when(i % 101 == 0, "Maybe").otherwise(F.col("in_debt")),
            "credit": F.when(i % 89 == 0, -1.0).otherwise(F.col("credit")),
        }
    )


@query(
    "stream_score",
    f"""WITH {OC}, r AS (SELECT id, concat_ws('; ',
      CASE WHEN id % 97 = 0 THEN 'o_totalprice: null' END,
      CASE WHEN id % 101 = 0 THEN 'in_debt: not allowed' END,
      CASE WHEN id % 89 = 0 THEN 'credit: negative' END) AS reason FROM oc)
    SELECT id, CASE WHEN reason <> '' THEN reason END AS reason,
      CASE WHEN reason = '' THEN true END AS as_in_batch FROM r""",
)
def stream_score(spark, sf):
    """Two deliveries and a restart: each row once, scored or rejected."""
    from pyspark.sql import types as T

    _, bundle = _fit(spark, sf, "logreg")
    base = scratch(spark)
    schema = T.StructType.fromDDL(
        "id long, c_nationkey int, in_debt string, o_orderpriority string, "
        "o_totalprice double, credit double"
    )
    rows = staged(
        _defects(creditors(spark, sf).select("id", *SCORING_SPEC.features))
    )
    for part in (0, 1, 2):  # the third time nothing has arrived
        if part < 2:
            rows.where(F.col("id") % 2 == part).write.mode("append").parquet(
                f"{base}/in"
            )
        new = arriving.read_arriving(spark, f"{base}/in", schema)
        arriving.run_checked_scores(
            new, bundle, f"{base}/out", f"{base}/state"
        )
    scores = spark.read.parquet(f"{base}/out/scores")
    rejects = spark.read.parquet(f"{base}/out/rejects")
    good = rows.join(rejects.select("id"), "id", "left_anti")
    batch = bundle.predict(staged(good)).select(
        "id", F.col("probability").alias("p"), F.col("prediction").alias("d")
    )
    same = (F.abs(F.col("probability") - F.col("p")) < 1e-12) & (
        F.col("prediction") == F.col("d")
    )
    return (
        scores.join(batch, "id", "left")
        .select(
            "id", F.lit(None).cast("string").alias("reason"),
            F.coalesce(same, F.lit(False)).alias("as_in_batch"),
        )
        .union(
            rejects.select(
                "id", "reason", F.lit(None).cast("boolean")
            )
        )
    )


@query(
    "stream_drift",
    f"""WITH q AS (SELECT list_distinct(quantile_cont(value, {DECILES_SQL}))
      AS cuts FROM events),
    cells AS (SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01')
        AS w, 'value' AS feature,
        CAST(len(list_filter(cuts, lambda c: c <= value)) AS VARCHAR) AS k
      FROM events, q
      UNION ALL SELECT time_bucket(INTERVAL 7 DAY, ts,
        TIMESTAMP '1970-01-01'), 'event_type', event_type FROM events),
    n AS (SELECT w, feature, k, count(*) AS n FROM cells GROUP BY 1, 2, 3),
    a AS (SELECT w, feature, k, n / CAST(sum(n) OVER (
        PARTITION BY w, feature) AS DOUBLE) AS share FROM n),
    e0 AS (SELECT feature, k, count(*) / CAST((SELECT count(*) FROM events)
        AS DOUBLE) AS share FROM cells GROUP BY 1, 2),
    e AS (SELECT DISTINCT a.w, e0.feature, e0.k, e0.share
          FROM a JOIN e0 USING (feature)),
    j AS (SELECT coalesce(e.w, a.w) AS w, coalesce(e.feature, a.feature)
        AS feature, greatest(coalesce(e.share, 0), 0.0001) AS x,
        greatest(coalesce(a.share, 0), 0.0001) AS y
      FROM e FULL OUTER JOIN a ON e.w = a.w AND e.feature = a.feature
        AND e.k = a.k)
    SELECT w AS window_start, feature, round(sum((y - x) * ln(y / x)), 6)
      AS psi FROM j GROUP BY 1, 2""",
)
def stream_drift(spark, sf):
    from pyspark.sql import types as T

    events = table(spark, sf, "events")
    cuts = quantile_cuts(events, ["value"])
    profile = drifting.data_profile(events, ["value"], ["event_type"])
    schema = T.StructType.fromDDL(SCHEMAS["events"])
    stream = arriving.read_arriving(spark, sf, schema, "events.parquet")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    bins = arriving.window_bins(
        stream, "ts", "7 days", "1 hour", cuts, ["event_type"]
    )
    base = scratch(spark)
    arriving.run_window_bins(bins, f"{base}/bins", f"{base}/state")
    latest = arriving.latest_bins(spark, f"{base}/bins")
    out = arriving.window_psi(latest, profile)
    return rounded(
        out.withColumn(
            "window_start", F.col("window_start").cast("timestamp_ntz")
        )
    )
