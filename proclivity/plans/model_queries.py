"""Queries: encoders, evaluation, drift, gates, registry."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from proclivity.models.bundle import linear_score_sql
from proclivity.operators import drift as drifting
from proclivity.operators import encoders as enc
from proclivity.operators import evaluation as ev
from proclivity.operators import gates as gating
from proclivity.operators import lookups
from proclivity.operators import profiling, registry, validate
from proclivity.models.search import best_trial
from proclivity.models.search import median_pruning as prune
from proclivity.operators.dictionaries import ordered_means
from proclivity.operators.sampling import stratified_folds, stratified_split
from proclivity.plans.catalog import query, r6, rounded
from proclivity.plans.data_queries import SPLIT_SQL
from proclivity.plans.frames import (
    BAND_LABELS,
    BANDS,
    MESSY,
    OC,
    PRIORITIES,
    SPEC,
    customers,
    md5_sql,
    messy,
    table,
)
from proclivity.plans.profile_queries import DECILES_SQL, _psi_sql

# --- encoders -----------------------------------------------------------------


def _freq_sql(column: str, threshold: float) -> str:
    """CTEs: share of each category and the share of the rare ones."""
    return f"""
    f_{column} AS (SELECT CAST({column} AS VARCHAR) AS k, count(*)
        / CAST((SELECT count(*) FROM oc) AS DOUBLE) AS share
        FROM oc GROUP BY 1),
    o_{column} AS (SELECT coalesce(sum(share) FILTER (share < {threshold}),
        0.0) AS o FROM f_{column})"""


def _freq_value(column: str, threshold: float) -> str:
    return f"""coalesce((SELECT share FROM f_{column} WHERE k =
      CAST(oc.{column} AS VARCHAR) AND share >= {threshold}),
      (SELECT o FROM o_{column}))"""


@query(
    "freq_encode",
    f"""WITH {OC}, {_freq_sql("c_nationkey", 0.04)},
    {_freq_sql("o_custkey", 0.01)}
    SELECT id, round({_freq_value("c_nationkey", 0.04)}, 6) AS c_nationkey,
           round({_freq_value("o_custkey", 0.01)}, 6) AS o_custkey FROM oc""",
)
def freq_encode(spark, sf):
    df = customers(spark, sf).select("id", "c_nationkey", "o_custkey")
    encoder = enc.fit_frequency(df, ["c_nationkey"], 0.04)
    encoder = encoder + enc.fit_frequency(df, ["o_custkey"], 0.01)
    return rounded(encoder.apply(df, ["id"]))


@query(
    "freq_encode_other",
    f"""WITH {OC}, {_freq_sql("c_nationkey", 0.04)}
    SELECT k AS category, round(share, 6) AS share FROM f_c_nationkey
    WHERE share >= 0.04
    UNION ALL SELECT 'OTHER', round(o, 6) FROM o_c_nationkey""",
)
def freq_encode_other(spark, sf):
    return rounded(
        enc.freq_table_with_other(
            customers(spark, sf), "c_nationkey", 0.04, "OTHER"
        )
    )


@query(
    "freq_encode_other_values",
    f"""WITH {OC}, {_freq_sql("c_nationkey", 0.04)}
    SELECT id, round({_freq_value("c_nationkey", 0.04)}, 6) AS c_nationkey
    FROM oc""",
)
def freq_encode_other_values(spark, sf):
    """Each row's share by the table of shares; rare ones share OTHER's."""
    df = customers(spark, sf)
    encoder = enc.fit_table_with_other(df, "c_nationkey", 0.04, "OTHER")
    return rounded(encoder.apply(df, ["id"]))


@query(
    "category_index",
    f"""WITH {MESSY}, d AS (SELECT c_mktsegment AS v,
      dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code
      FROM (SELECT DISTINCT c_mktsegment FROM oc) t),
    n AS (SELECT o_custkey AS v, dense_rank() OVER (ORDER BY o_custkey)
      - 1 AS code FROM (SELECT DISTINCT o_custkey FROM oc
                        WHERE id % 3 <> 0) t)
    SELECT id, CAST(d.code AS INTEGER) AS c_mktsegment,
           CAST(n.code AS INTEGER) AS o_custkey
    FROM messy LEFT JOIN d ON c_mktsegment = d.v
    LEFT JOIN n ON o_custkey = n.v""",
)
def category_index(spark, sf):
    """Thousands of customers as a category; some are not seen at the fit."""
    df = customers(spark, sf)
    segments = enc.fit_category_index(df, ["c_mktsegment"])
    keys = enc.fit_category_index(df.where("id % 3 <> 0"), ["o_custkey"])
    encoder = segments + keys
    return encoder.apply(messy(spark, sf), ["id"])


@query(
    "category_dictionary",
    f"""WITH {OC} SELECT o_custkey AS value, CAST(row_number() OVER (
    ORDER BY o_custkey) - 1 AS BIGINT) AS code
    FROM (SELECT DISTINCT o_custkey FROM oc) t""",
)
def category_dictionary(spark, sf):
    return enc.category_dictionary(customers(spark, sf), "o_custkey")


@query(
    "category_string",
    f"""WITH {OC} SELECT id, CAST(c_nationkey AS VARCHAR) AS c_nationkey
    FROM oc""",
)
def category_string(spark, sf):
    return enc.category_string(["c_nationkey"]).apply(
        customers(spark, sf), ["id"]
    )


@query(
    "robust_scale",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.5) AS m,
      quantile_cont(l_extendedprice, 0.75)
        - quantile_cont(l_extendedprice, 0.25) AS w FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey,
           round((l_extendedprice - m) / w, 6) AS l_extendedprice
    FROM lineitem, q""",
)
def robust_scale(spark, sf):
    df = table(spark, sf, "lineitem")
    encoder = enc.fit_robust(df, ["l_extendedprice"])
    return rounded(
        encoder.apply(df, ["l_orderkey", "l_linenumber", "l_partkey"])
    )


@query(
    "standard_scale",
    """WITH q AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS w
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey,
           round((l_quantity - m) / w, 6) AS l_quantity FROM lineitem, q""",
)
def standard_scale(spark, sf):
    df = table(spark, sf, "lineitem")
    encoder = enc.fit_standard(df, ["l_quantity"])
    return rounded(
        encoder.apply(df, ["l_orderkey", "l_linenumber", "l_partkey"])
    )


@query(
    "onehot_if_binary",
    f"""WITH {OC} SELECT id,
    CAST(in_debt = 'Yes' AS INTEGER) AS "in_debt_Yes",
    CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS "c_mktsegment_AUTOMOBILE",
    CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS "c_mktsegment_BUILDING",
    CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS "c_mktsegment_FURNITURE",
    CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS "c_mktsegment_HOUSEHOLD",
    CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS "c_mktsegment_MACHINERY"
    FROM oc""",
)
def onehot_if_binary(spark, sf):
    df = customers(spark, sf)
    return enc.fit_onehot(df, ["in_debt", "c_mktsegment"]).apply(df, ["id"])


ORDINAL_CASE = (
    "CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITIES))
    + " END"
)


@query(
    "ordinal_explicit",
    f"WITH {OC} SELECT id, {ORDINAL_CASE} AS o_orderpriority FROM oc",
)
def ordinal_explicit(spark, sf):
    encoder = enc.fit_ordinal({"o_orderpriority": PRIORITIES})
    return encoder.apply(customers(spark, sf), ["id"])


@query(
    "ordinal_learned",
    f"""WITH {OC}, d AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
      FROM (SELECT DISTINCT o_custkey AS v FROM oc) t)
    SELECT id, CAST(in_debt = 'Yes' AS INTEGER) AS in_debt,
           CAST(code AS INTEGER) AS o_custkey
    FROM oc JOIN d ON o_custkey = v""",
)
def ordinal_learned(spark, sf):
    df = customers(spark, sf)
    return enc.fit_ordinal_learned(df, ["in_debt", "o_custkey"]).apply(
        df, ["id"]
    )


SCALE_SQL = """
    s AS (SELECT quantile_cont(o_totalprice, 0.5) AS med,
      quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)
        AS iqr, avg(c_acctbal) AS mean, stddev_pop(c_acctbal) AS std
      FROM oc)"""
SCALED = f"""round((o_totalprice - med) / iqr, 6) AS o_totalprice,
    round((c_acctbal - mean) / std, 6) AS c_acctbal,
    {ORDINAL_CASE} AS o_orderpriority"""


@query(
    "encoded_features",
    f"""WITH {OC}, {SCALE_SQL}, {_freq_sql("c_nationkey", 0.04)}
    SELECT id, {SCALED},
      round({_freq_value("c_nationkey", 0.04)}, 6) AS c_nationkey,
      CAST(in_debt = 'Yes' AS INTEGER) AS "in_debt_Yes" FROM oc, s""",
)
def encoded_features(spark, sf):
    df = customers(spark, sf)
    encoder = enc.fit_encoded_features(df, SPEC, 0.04)
    return rounded(encoder.apply(df, ["id"]))


@query(
    "native_features",
    f"""WITH {OC}, d AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
      FROM (SELECT DISTINCT c_nationkey AS v FROM oc) t),
    k AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
      FROM (SELECT DISTINCT o_custkey AS v FROM oc) t)
    SELECT id, o_totalprice, c_acctbal,
      CAST(in_debt = 'Yes' AS INTEGER) AS in_debt,
      {ORDINAL_CASE} AS o_orderpriority,
      CAST(d.code AS INTEGER) AS c_nationkey,
      CAST(k.code AS INTEGER) AS o_custkey
    FROM oc JOIN d ON c_nationkey = d.v JOIN k ON o_custkey = k.v""",
)
def native_features(spark, sf):
    df = customers(spark, sf)
    spec = replace(SPEC, high_card=("c_nationkey", "o_custkey"))
    return enc.fit_native_features(df, spec).apply(df, ["id"])


@query(
    "drop_remainder",
    f"""WITH {OC}, {SCALE_SQL} SELECT {SCALED} FROM oc, s""",
)
def drop_remainder(spark, sf):
    df = customers(spark, sf)
    return rounded(enc.fit_scaled_features(df, SPEC).apply(df))


@query(
    "skip_encoder_features",
    f"""WITH {OC}, {SCALE_SQL} SELECT id, {SCALED}, c_nationkey, in_debt
    FROM oc, s""",
)
def skip_encoder_features(spark, sf):
    df = customers(spark, sf)
    encoder = enc.fit_scaled_features(df, SPEC)
    rest = ["id", *SPEC.high_card, *SPEC.binary]
    return rounded(encoder.apply(df, rest))


@query(
    "target_mean_oof",
    f"""WITH {OC}, f AS (SELECT id, y, c_nationkey, CAST(ntile(3) OVER (
        PARTITION BY y ORDER BY {md5_sql()}) - 1 AS INTEGER) AS fold FROM oc),
    g AS (SELECT c_nationkey, fold, sum(y) AS s, count(*) AS n
          FROM f GROUP BY 1, 2),
    t AS (SELECT c_nationkey, sum(s) AS s, sum(n) AS n FROM g GROUP BY 1),
    p AS (SELECT avg(CAST(y AS DOUBLE)) AS p FROM f)
    SELECT f.id, round((t.s - g.s + p.p) / (t.n - g.n + 1.0), 6)
      AS target_mean
    FROM f JOIN g USING (c_nationkey, fold) JOIN t USING (c_nationkey), p""",
)
def target_mean_oof(spark, sf):
    df = customers(spark, sf).select("id", "y", "c_nationkey")
    folds = stratified_folds(df, "id", "y", 3)
    out = enc.target_mean_oof(folds, "c_nationkey", "y", "fold")
    return out.select("id", r6("target_mean"))


@query(
    "target_mean_table",
    f"""WITH {MESSY}, t AS (SELECT o_custkey AS v, sum(y) AS s, count(*) AS n
      FROM oc WHERE id % 3 <> 0 GROUP BY 1),
    p AS (SELECT avg(CAST(y AS DOUBLE)) AS p FROM oc WHERE id % 3 <> 0)
    SELECT id, round(coalesce((s + p) / (n + 1.0), p), 6) AS o_custkey
    FROM messy CROSS JOIN p LEFT JOIN t ON o_custkey = v""",
)
def target_mean_table(spark, sf):
    """Mean target of thousands of customers; some are not seen at the fit."""
    df = customers(spark, sf).where("id % 3 <> 0")
    encoder = enc.fit_target_mean(df, ["o_custkey"], "y")
    return rounded(encoder.apply(messy(spark, sf), ["id"]))


def _before(column):
    return (
        f"sum(y) OVER (PARTITION BY {column} ORDER BY {md5_sql()}, id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
        f"row_number() OVER (PARTITION BY {column} ORDER BY {md5_sql()}, id)",
    )


@query(
    "ordered_target_means",
    f"""WITH {OC}, p AS (SELECT avg(CAST(y AS DOUBLE)) AS p FROM oc)
    SELECT id, """
    + ", ".join(
        f"round((coalesce({total}, 0) + p) / ({n}), 6) AS {out}"
        for out, (total, n) in {
            "by_customer": _before("o_custkey"),
            "by_price": _before("o_totalprice"),
            "by_pair": _before("c_nationkey, in_debt"),
        }.items()
    )
    + " FROM oc, p",
)
def ordered_target_means(spark, sf):
    """Means over the rows before a row: of every value, and of a pair."""
    df = customers(spark, sf).withColumn(
        "pair", F.concat_ws("/", "c_nationkey", "in_debt")
    )
    places = {
        "o_custkey": "by_customer",
        "o_totalprice": "by_price",
        "pair": "by_pair",
    }
    out = ordered_means(
        df.select("id", "y", *places), places, "y", ["id"]
    )
    return rounded(out.select("id", *places.values()))


@query(
    "class_weight_column",
    f"""WITH {OC} SELECT id, y, round(count(*) OVER ()
    / (2.0 * count(*) OVER (PARTITION BY y)), 6) AS balanced,
    CAST(CASE WHEN y = 1 THEN 3.5 ELSE 1.0 END AS DOUBLE)
      AS positive_weight FROM oc""",
)
def class_weight_column(spark, sf):
    from proclivity.models.builders import class_weight

    df = customers(spark, sf).select("id", "y")
    df = class_weight(df, "y", "balanced")
    df = class_weight(df, "y", "positive_weight", positive=3.5)
    return rounded(df)


WEIGHTS = [0.5, -0.3, 0.2, -0.1, 0.4]
INTERCEPT = -0.25


@query(
    "score_linear_sql",
    f"""WITH {OC}, {SCALE_SQL}, {_freq_sql("c_nationkey", 0.04)}
    SELECT id, round(1.0 / (1.0 + exp(-(-0.25
      + 0.5 * ((o_totalprice - med) / iqr)
      - 0.3 * ((c_acctbal - mean) / std)
      + 0.2 * {_freq_value("c_nationkey", 0.04)}
      - 0.1 * CAST(in_debt = 'Yes' AS INTEGER)
      + 0.4 * {ORDINAL_CASE}))), 6) AS probability FROM oc, s""",
)
def score_linear_sql(spark, sf):
    df = customers(spark, sf)
    encoder = enc.fit_encoded_features(df, SPEC, 0.04)
    sql = linear_score_sql(
        list(encoder.expressions.values()), WEIGHTS, INTERCEPT
    )
    return df.select("id", r6(F.expr(sql), "probability"))


# --- evaluation ---------------------------------------------------------------


def _confusion(t: float, score: str = "score") -> str:
    return f"""
    cm AS (SELECT count(*) FILTER ({score} >= {t} AND y = 1) AS tp,
                  count(*) FILTER ({score} >= {t} AND y = 0) AS fp,
                  count(*) FILTER ({score} < {t} AND y = 1) AS fn,
                  count(*) FILTER ({score} < {t} AND y = 0) AS tn FROM oc)"""


PRECISION = "CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / CAST(tp + fp AS DOUBLE) END"
RECALL = "CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / CAST(tp + fn AS DOUBLE) END"
F1 = """CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0
      ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END"""
SCORES = f"""round({PRECISION}, 6) AS precision, round({RECALL}, 6) AS recall,
    round({F1}, 6) AS f1"""


@query(
    "confusion_metrics",
    f"WITH {OC}, {_confusion(0.5)} SELECT {SCORES} FROM cm",
)
def confusion_metrics(spark, sf):
    return rounded(
        ev.confusion_metrics(customers(spark, sf), "y", "score", 0.5)
    )


def _auc_sql(source: str, score: str, by: str = "") -> str:
    """Ranks of positives with ties at their mean: the AUC by rank sums."""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    keep = f"{by}," if by else ""
    return f"""SELECT {keep} count(*) FILTER (y = 1) AS p,
      count(*) FILTER (y = 0) AS n,
      (sum(mid) FILTER (y = 1) - count(*) FILTER (y = 1)
        * (count(*) FILTER (y = 1) + 1) / 2.0)
        / nullif(CAST(count(*) FILTER (y = 1) AS DOUBLE)
                 * count(*) FILTER (y = 0), 0) AS auc
    FROM (SELECT *, rank() OVER ({part} ORDER BY {score})
            + (count(*) OVER (PARTITION BY {keep} {score}) - 1) / 2.0 AS mid
          FROM {source}) t {group}"""


@query(
    "roc_auc_exact",
    f"""WITH {OC}, a AS ({_auc_sql("oc", "score")})
    SELECT CAST(p AS BIGINT) AS n_positive, CAST(n AS BIGINT) AS n_negative,
           round(auc, 6) AS roc_auc FROM a""",
)
def roc_auc_exact(spark, sf):
    return rounded(ev.roc_auc_exact(customers(spark, sf), "y", "score"))


@query(
    "roc_auc_continuous",
    f"""WITH l AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
      l_extendedprice * (1 - l_discount) AS revenue FROM lineitem),
    a AS ({_auc_sql("l", "revenue")})
    SELECT CAST(p AS BIGINT) AS n_positive, CAST(n AS BIGINT) AS n_negative,
           round(auc, 6) AS roc_auc FROM a""",
)
def roc_auc_continuous(spark, sf):
    # nearly every score is its own: the ordering has to be bucketed
    df = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias(
            "revenue"
        ),
    )
    return rounded(ev.roc_auc_exact(df, "y", "revenue", bucket_rows=200))


@query(
    "confusion_matrix",
    f"""WITH {OC} SELECT y AS actual, CAST(score >= 0.5 AS INTEGER)
    AS predicted, CAST(count(*) AS BIGINT) AS n_rows FROM oc GROUP BY 1, 2""",
)
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(customers(spark, sf), "y", "score", 0.5)


@query(
    "classification_report",
    f"""WITH {OC}, {_confusion(0.5)},
    c AS (SELECT '1' AS label, tp, fp, fn FROM cm
          UNION ALL SELECT '0', tn, fn, fp FROM cm),
    m AS (SELECT label, tp / CAST(tp + fp AS DOUBLE) AS precision,
            tp / CAST(tp + fn AS DOUBLE) AS recall,
            2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS f1,
            tp + fn AS support FROM c),
    u AS (SELECT * FROM m
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1),
        CAST(sum(support) AS BIGINT) FROM m
      UNION ALL SELECT 'weighted avg',
        sum(precision * support) / sum(support),
        sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM m)
    SELECT label, round(precision, 6) AS precision, round(recall, 6)
      AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support
    FROM u""",
)
def classification_report(spark, sf):
    return rounded(
        ev.classification_report(customers(spark, sf), "y", "score", 0.5)
    )


def _metrics_cte(name: str, source: str, score: str, t: float) -> str:
    return f"""
    {name}_a AS ({_auc_sql(source, score)}),
    {name}_c AS (SELECT count(*) FILTER ({score} >= {t} AND y = 1) AS tp,
      count(*) FILTER ({score} >= {t} AND y = 0) AS fp,
      count(*) FILTER ({score} < {t} AND y = 1) AS fn FROM {source}),
    {name} AS (SELECT {PRECISION} AS precision, {RECALL} AS recall,
      {F1} AS f1, auc AS roc_auc FROM {name}_c, {name}_a)"""


@query(
    "train_test_gap",
    f"""WITH {SPLIT_SQL}, tr AS (SELECT * FROM split WHERE split = 'train'),
    te AS (SELECT * FROM split WHERE split = 'test'),
    {_metrics_cte("mtr", "tr", "score", 0.5)},
    {_metrics_cte("mte", "te", "score", 0.5)},
    rows AS (SELECT 'precision' AS metric, a.precision AS train,
        b.precision AS test FROM mtr a, mte b
      UNION ALL SELECT 'recall', a.recall, b.recall FROM mtr a, mte b
      UNION ALL SELECT 'f1', a.f1, b.f1 FROM mtr a, mte b
      UNION ALL SELECT 'roc_auc', a.roc_auc, b.roc_auc FROM mtr a, mte b),
    v AS (SELECT CASE WHEN a.roc_auc < 0.6 THEN 'underfit'
      WHEN a.roc_auc > 0.85 AND abs(a.roc_auc - b.roc_auc) > 0.1
        THEN 'strong overfit'
      WHEN abs(a.roc_auc - b.roc_auc) > 0.05 AND a.roc_auc > b.roc_auc
        THEN 'moderate overfit'
      WHEN abs(a.roc_auc - b.roc_auc) > 0.05 THEN 'unusual'
      WHEN abs(a.roc_auc - b.roc_auc) > 0.02 THEN 'small gap'
      ELSE 'good' END AS verdict FROM mtr a, mte b)
    SELECT metric, round(train, 6) AS train, round(test, 6) AS test,
           round(train - test, 6) AS difference, verdict FROM rows, v""",
)
def train_test_gap(spark, sf):
    parts = stratified_split(
        customers(spark, sf).select("id", "y", "score"), "id", "y"
    )
    metrics = [
        ev.classification_metrics(
            parts.filter(F.col("split") == side), "y", "score"
        )
        for side in ("train", "test")
    ]
    return rounded(ev.train_test_gap(*metrics))


SLICES_SQL = """
    sl AS (SELECT y, score, score_b, 'c_mktsegment' AS slice_col,
             c_mktsegment AS slice_value FROM oc
      UNION ALL SELECT y, score, score_b, 'o_orderpriority', o_orderpriority
      FROM oc
      UNION ALL SELECT y, score, score_b, 'o_totalprice',
        CASE WHEN o_totalprice <= 0 THEN 'nan'
             WHEN o_totalprice <= 100000 THEN '0-100k'
             WHEN o_totalprice <= 200000 THEN '100-200k'
             WHEN o_totalprice <= 300000 THEN '200-300k'
             WHEN o_totalprice <= 400000 THEN '300-400k'
             WHEN o_totalprice <= 1000000 THEN '400k+' ELSE 'nan' END
      FROM oc)"""
SLICE_COLUMNS = ["c_mktsegment", "o_orderpriority"]
SLICE_BANDS = {"o_totalprice": (BANDS, BAND_LABELS)}
SLICE_KEY = "slice_col, slice_value"


@query(
    "slice_auc",
    f"""WITH {OC}, {SLICES_SQL}, a AS ({_auc_sql("sl", "score", SLICE_KEY)})
    SELECT {SLICE_KEY}, CAST(p + n AS BIGINT) AS n_rows,
           round_even(auc, 4) AS roc_auc
    FROM a WHERE p + n >= 200 AND auc IS NOT NULL""",
)
def slice_auc(spark, sf):
    return ev.slice_auc(
        customers(spark, sf), "y", "score", SLICE_COLUMNS, SLICE_BANDS, 200
    )


def _f1_by_slice(t: float) -> str:
    return f"""
    f AS (SELECT {SLICE_KEY}, count(*) FILTER (score >= {t} AND y = 1) AS tp,
      count(*) FILTER (score >= {t} AND y = 0) AS fp,
      count(*) FILTER (score < {t} AND y = 1) AS fn, count(*) AS n,
      sum(y) AS pos FROM sl GROUP BY {SLICE_KEY})"""


@query(
    "slice_report",
    f"""WITH {OC}, {SLICES_SQL}, a AS ({_auc_sql("sl", "score", SLICE_KEY)}),
    {_f1_by_slice(0.5)}
    SELECT f.slice_col, f.slice_value,
      round(f.n / CAST((SELECT count(*) FROM oc) AS DOUBLE), 6)
        AS customer_share,
      round(f.pos / CAST(f.n AS DOUBLE), 6) AS positive_rate,
      round(auc, 6) AS roc_auc,
      round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) AS f1
    FROM f JOIN a USING (slice_col, slice_value)""",
)
def slice_report(spark, sf):
    return rounded(
        ev.slice_report(
            customers(spark, sf), "y", "score", SLICE_COLUMNS, SLICE_BANDS
        )
    )


@query(
    "score_model",
    f"""WITH {OC}, {SLICES_SQL}, {_metrics_cte("m", "oc", "score", 0.5)},
    a AS ({_auc_sql("sl", "score", SLICE_KEY)})
    SELECT 'precision' AS name, round_even(precision, 4) AS value FROM m
    UNION ALL SELECT 'recall', round_even(recall, 4) FROM m
    UNION ALL SELECT 'f1', round_even(f1, 4) FROM m
    UNION ALL SELECT 'roc_auc', round_even(roc_auc, 4) FROM m
    UNION ALL SELECT concat(slice_col, '=', slice_value), round_even(auc, 4)
    FROM a WHERE p + n >= 200 AND auc IS NOT NULL""",
)
def score_model(spark, sf):
    overall, slices = ev.score_model(
        customers(spark, sf), "y", "score", 0.5, SLICE_COLUMNS, SLICE_BANDS
    )
    metrics = overall.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("name"), F.col(m).alias("value")
                    )
                    for m in ev.METRICS
                ]
            )
        )
    )
    return metrics.unionByName(
        slices.select(
            F.concat_ws("=", "slice_col", "slice_value").alias("name"),
            F.col("roc_auc").alias("value"),
        )
    )


SWEEP = [0.3, 0.4, 0.5, 0.6, 0.7]


def _sweep_sql(thresholds: list[float]) -> str:
    values = ", ".join(f"({t!r}::DOUBLE)" for t in thresholds)
    return f"""
    t AS (SELECT * FROM (VALUES {values}) v(threshold)),
    c AS (SELECT threshold, count(*) FILTER (score >= threshold AND y = 1)
        AS tp, count(*) FILTER (score >= threshold AND y = 0) AS fp,
        count(*) FILTER (score < threshold AND y = 1) AS fn, count(*) AS n
      FROM oc, t GROUP BY threshold)"""


@query(
    "threshold_sweep",
    f"""WITH {OC}, {_sweep_sql(SWEEP)} SELECT threshold, {SCORES},
    round((tp + fp) / CAST(n AS DOUBLE), 6) AS flagged_share FROM c""",
)
def threshold_sweep(spark, sf):
    return rounded(
        ev.threshold_sweep(customers(spark, sf), "y", "score", SWEEP)
    )


@query(
    "best_f1_threshold",
    f"""WITH {OC},
    d AS (SELECT score, sum(y) AS pos, count(*) AS n FROM oc GROUP BY score),
    k AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp,
            sum(n) OVER (ORDER BY score DESC) AS flagged,
            sum(pos) OVER () AS p FROM d),
    f AS (SELECT score, 2 * tp / CAST(flagged + p AS DOUBLE) AS f1 FROM k)
    SELECT min(score) AS threshold, round(max(f1), 6) AS f1 FROM f
    WHERE f1 = (SELECT max(f1) FROM f)""",
)
def best_f1_threshold(spark, sf):
    return rounded(
        ev.best_f1_threshold(customers(spark, sf), "y", "score")
    )


@query(
    "gains_table",
    f"""WITH {OC}, r AS (SELECT y, row_number() OVER (
        ORDER BY score DESC, {md5_sql()}) AS rn, count(*) OVER () AS n,
        sum(y) OVER () AS p FROM oc),
    s AS (SELECT * FROM (VALUES (0.1::DOUBLE), (0.2::DOUBLE), (0.3::DOUBLE),
          (0.5::DOUBLE)) v(top_share)),
    g AS (SELECT top_share, count(*) AS called, sum(y) AS caught, max(n) AS n,
            max(p) AS p FROM r, s WHERE rn <= round_even(top_share * n, 0)
          GROUP BY top_share)
    SELECT top_share, CAST(called AS BIGINT) AS n_called,
      CAST(caught AS BIGINT) AS n_caught,
      round(caught / CAST(p AS DOUBLE), 6) AS caught_share,
      round(caught / CAST(called AS DOUBLE), 6) AS conversion,
      round(caught * n / (CAST(called AS DOUBLE) * p), 6) AS lift FROM g""",
)
def gains_table(spark, sf):
    return rounded(
        ev.gains_table(customers(spark, sf), "id", "y", "score")
    )


CURVE_SQL = """
    d AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg
          FROM oc GROUP BY score),
    k AS (SELECT score, pos, sum(pos) OVER (ORDER BY score DESC) AS tp,
            sum(neg) OVER (ORDER BY score DESC) AS fp,
            sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM d)"""


@query(
    "pr_auc",
    f"""WITH {OC}, {CURVE_SQL} SELECT round(sum(pos * tp
    / CAST(tp + fp AS DOUBLE)) / max(p), 6) AS pr_auc FROM k""",
)
def pr_auc(spark, sf):
    return rounded(ev.pr_auc(customers(spark, sf), "y", "score"))


@query(
    "roc_pr_curves",
    f"""WITH {OC}, {CURVE_SQL} SELECT score AS threshold,
    round(tp / CAST(p AS DOUBLE), 6) AS tpr,
    round(fp / CAST(n AS DOUBLE), 6) AS fpr,
    round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision FROM k""",
)
def roc_pr_curves(spark, sf):
    return rounded(ev.roc_pr_curves(customers(spark, sf), "y", "score"))


@query(
    "auc_ci_hanley",
    f"""WITH {OC}, x AS ({_auc_sql("oc", "score")}),
    q AS (SELECT auc AS a, CAST(p AS DOUBLE) AS p, CAST(n AS DOUBLE) AS n,
            auc / (2 - auc) AS q1, 2 * auc * auc / (1 + auc) AS q2 FROM x),
    e AS (SELECT a, sqrt((a * (1 - a) + (p - 1) * (q1 - a * a)
            + (n - 1) * (q2 - a * a)) / (p * n)) AS e FROM q)
    SELECT round(a, 6) AS roc_auc, round(e, 6) AS std_error,
           round(a - 1.959963984540054 * e, 6) AS ci_low,
           round(a + 1.959963984540054 * e, 6) AS ci_high FROM e""",
)
def auc_ci_hanley(spark, sf):
    auc = ev.roc_auc_exact(customers(spark, sf), "y", "score")
    return rounded(ev.auc_ci_hanley(auc))


def _draw_sql(size: str, group: str) -> str:
    """The weight of a group of equal rows in one repeat, from md5 hashes."""

    def uniform(more: str) -> str:
        text = f"concat_ws(':', key, repeat, '42', '{group}', {more})"
        return f"((CAST('0x' || md5({text})[1:8] AS BIGINT) + 0.5) / 4294967296.0)"

    def one(more: str) -> str:
        cuts = ", ".join(f"{c!r}" for c in ev.poisson_cuts())
        return f"len([c FOR c IN [{cuts}] IF {uniform(more)} >= c])"

    z = (
        f"(sqrt(-2 * ln({uniform("'a'")}))"
        f" * cos(2 * pi() * {uniform("'b'")}))"
    )
    return f"""CASE WHEN {size} = 0 THEN 0 WHEN {size} <= {ev.SINGLE_DRAWS}
      THEN list_sum([{one("i")} FOR i IN range(1, CAST({size} AS BIGINT) + 1)])
      ELSE greatest(floor({size} + sqrt({size}) * {z}
        + ({z} * {z} - 1) / 6 + 0.5), 0) END"""


@query(
    "bootstrap_ci",
    f"""WITH {OC}, g AS (SELECT score, sum(y) AS p, sum(1 - y) AS q,
      concat_ws(':', CAST(floor(score * 67108864) AS BIGINT),
        CAST(floor((score * 67108864 - floor(score * 67108864)) * 67108864)
          AS BIGINT)) AS key
      FROM oc GROUP BY score),
    w AS (SELECT score, repeat, {_draw_sql("p", "p")} AS p,
        {_draw_sql("q", "n")} AS q
      FROM g, (SELECT unnest(range(300)) AS repeat) r),
    b AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY repeat ORDER BY score
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM w),
    t AS (SELECT repeat, CAST(sum(p) AS DOUBLE) AS pos,
        CAST(sum(q) AS DOUBLE) AS neg, sum(p * (below + q / 2.0)) AS wins,
        CAST(sum(p) FILTER (score >= 0.5) AS DOUBLE) AS tp,
        CAST(sum(q) FILTER (score >= 0.5) AS DOUBLE) AS fp
      FROM b GROUP BY repeat),
    v AS (SELECT unnest([
        {{'metric': 'precision', 'value': tp / (tp + fp)}},
        {{'metric': 'recall', 'value': tp / pos}},
        {{'metric': 'f1', 'value': 2 * tp / (tp + fp + pos)}},
        {{'metric': 'roc_auc', 'value': wins / (pos * neg)}}
      ], recursive := true) FROM t)
    SELECT metric, round(avg(value), 6) AS mean,
      round(quantile_cont(value, 0.025), 6) AS ci_low,
      round(quantile_cont(value, 0.975), 6) AS ci_high
    FROM v GROUP BY metric""",
)
def bootstrap_ci(spark, sf):
    return rounded(
        ev.bootstrap_ci(
            customers(spark, sf), "y", "score", repeats=300, bucket_rows=2_000
        )
    )


@query(
    "rule_baseline",
    f"""WITH {OC}, r AS (SELECT y, CASE WHEN in_debt = 'No'
      AND o_orderpriority <= '3' THEN 1.0 ELSE 0.0 END AS rule FROM oc),
    {_metrics_cte("m", "r", "rule", 0.5)}
    SELECT round((SELECT avg(rule) FROM r), 6) AS flagged_share,
      round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc FROM m""",
)
def rule_baseline(spark, sf):
    rule = (F.col("in_debt") == "No") & (F.col("o_orderpriority") <= "3")
    return rounded(ev.rule_baseline(customers(spark, sf), "y", rule))


@query(
    "label_quality_auc",
    f"""WITH l AS (SELECT quality AS y, CAST(n_chars AS DOUBLE) AS chars, lang
      FROM labels JOIN documents USING (doc_id)),
    a AS ({_auc_sql("l", "chars", "lang")})
    SELECT lang, CAST(p AS BIGINT) AS n_positive, CAST(n AS BIGINT)
      AS n_negative, round(auc, 6) AS roc_auc FROM a""",
)
def label_quality_auc(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    df = table(spark, sf, "labels").join(docs, "doc_id")
    df = df.withColumn("chars", F.col("n_chars").cast("double"))
    return rounded(ev.roc_auc_exact(df, "quality", "chars", ["lang"]))


# --- drift --------------------------------------------------------------------

NUMERIC = ["o_totalprice", "c_acctbal"]
CATEGORICAL = ["c_mktsegment", "o_orderpriority"]


def _batches(spark, sf):
    df = customers(spark, sf)
    return df.filter(F.col("batch_no") == 1), df.filter(
        F.col("batch_no") == 2
    )


def _shares_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category,
        count(*) / CAST((SELECT count(*) FROM {source}) AS DOUBLE) AS share
        FROM {source} GROUP BY 2"""
        for c in columns
    )


@query(
    "psi",
    f"""WITH {OC}, b1 AS (SELECT * FROM oc WHERE batch_no = 1),
    b2 AS (SELECT * FROM oc WHERE batch_no = 2),
    e AS ({_shares_sql("b1", ["c_nationkey", "o_custkey"])}),
    a AS ({_shares_sql("b2", ["c_nationkey", "o_custkey"])}),
    j AS (SELECT feature, greatest(coalesce(e.share, 0), 0.0001) AS e,
            greatest(coalesce(a.share, 0), 0.0001) AS a
          FROM e FULL OUTER JOIN a USING (feature, category))
    SELECT feature, round(sum((a - e) * ln(a / e)), 6) AS psi
    FROM j GROUP BY feature""",
)
def psi(spark, sf):
    old, new = _batches(spark, sf)
    columns = ["c_nationkey", "o_custkey"]
    shares = lookups.outer_shares(
        drifting.shares_of(old, {}, columns),
        drifting.shares_of(new, {}, columns),
        drifting.KEYS,
    )
    return rounded(drifting.psi(shares, ["feature"]))


def _numeric_profile_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS feature, {c} AS x, (SELECT list_sort(
          list_distinct(quantile_cont({c}, {DECILES_SQL}))) FROM lineitem)
          AS cuts FROM lineitem"""
        for c in ("l_extendedprice", "l_quantity", "l_discount")
    ]
    return f"""WITH x AS ({" UNION ALL ".join(parts)}),
    b AS (SELECT feature, len(list_filter(cuts, lambda q: q <= x)) AS bin,
            count(*) AS n FROM x GROUP BY 1, 2),
    g AS (SELECT feature, unnest(range(len(cuts) + 1)) AS bin, cuts
          FROM (SELECT DISTINCT feature, cuts FROM x) t)
    SELECT g.feature, CAST(g.bin AS INTEGER) AS bin,
      round(CASE WHEN g.bin > 0 THEN cuts[g.bin] END, 6) AS cut_lo,
      round(CASE WHEN g.bin < len(cuts) THEN cuts[g.bin + 1] END, 6)
        AS cut_hi,
      round(coalesce(n, 0) / CAST((SELECT count(*) FROM lineitem)
        AS DOUBLE), 6) AS share
    FROM g LEFT JOIN b ON g.feature = b.feature AND g.bin = b.bin"""


@query("numeric_profile", _numeric_profile_sql())
def numeric_profile(spark, sf):
    return rounded(
        drifting.numeric_profile(
            table(spark, sf, "lineitem"),
            ["l_extendedprice", "l_quantity", "l_discount"],
        )
    )


@query(
    "categorical_profile",
    f"""WITH {MESSY}, s AS ({_shares_sql("messy", ["c_mktsegment",
      "o_orderpriority"])})
    SELECT feature, category, round(share, 6) AS share FROM s""",
)
def categorical_profile(spark, sf):
    return rounded(
        drifting.categorical_profile(
            messy(spark, sf), ["c_mktsegment", "o_orderpriority"]
        )
    )


DRIFT_SQL = f"{OC}, {_psi_sql('oc', NUMERIC, CATEGORICAL)}"


def _report(spark, sf):
    old, new = _batches(spark, sf)
    profile = drifting.data_profile(old, NUMERIC, CATEGORICAL)
    return drifting.drift_report(profile, new)


@query(
    "drift_report",
    f"WITH {DRIFT_SQL} SELECT feature, psi FROM psi WHERE batch_no = 2",
)
def drift_report(spark, sf):
    return _report(spark, sf)


# a shifted price, missing values and an unseen category
SHIFTED_SQL = f"""{OC}, shifted AS (SELECT batch_no, CASE
    WHEN batch_no = 2 AND id % 97 = 0 THEN NULL
    WHEN batch_no = 2 THEN o_totalprice + 150000
    ELSE o_totalprice END AS o_totalprice, c_acctbal,
    CASE WHEN batch_no = 2 AND id % 101 = 0 THEN 'Unknown'
         ELSE c_mktsegment END AS c_mktsegment, o_orderpriority FROM oc),
    {_psi_sql("shifted", NUMERIC, CATEGORICAL)}"""


def _shifted_report(spark, sf):
    old, new = _batches(spark, sf)
    shifted = new.withColumns(
        {
            "o_totalprice": F.when(
                F.col("id") % 97 != 0, F.col("o_totalprice") + 150000
            ),
            "c_mktsegment": F.when(
                F.col("id") % 101 == 0, "Unknown"
            ).otherwise(F.col("c_mktsegment")),
        }
    )
    profile = drifting.data_profile(old, NUMERIC, CATEGORICAL)
    return drifting.drift_report(profile, shifted)


@query(
    "drift_report_shifted",
    f"WITH {SHIFTED_SQL} SELECT feature, psi FROM psi WHERE batch_no = 2",
)
def drift_report_shifted(spark, sf):
    return _shifted_report(spark, sf)


@query(
    "drift_alarm",
    f"""WITH {SHIFTED_SQL} SELECT max(psi) AS max_psi, max(psi) > 0.2 AS alarm
    FROM psi WHERE batch_no = 2""",
)
def drift_alarm(spark, sf):
    return drifting.drift_alarm(_shifted_report(spark, sf))


@query(
    "profile_store",
    f"""WITH {SPLIT_SQL}, tr AS (SELECT * FROM split WHERE split = 'train'),
    s AS ({_shares_sql("tr", CATEGORICAL)})
    SELECT 'v1' AS version, feature, 'categorical' AS kind, category,
           round(share, 6) AS share FROM s""",
)
def profile_store(spark, sf):
    parts = stratified_split(
        customers(spark, sf).select("id", "y", *CATEGORICAL), "id", "y"
    )
    train = parts.filter(F.col("split") == "train")
    profile = drifting.data_profile(train, [], CATEGORICAL)
    stored = drifting.store_profile(profile, "v1")
    return stored.select(
        "version", "feature", "kind", "category", r6("share")
    )


@query(
    "monitor_decision",
    f"""WITH {SHIFTED_SQL}, m AS (SELECT max(psi) > 0.2 AS alarm FROM psi
      WHERE batch_no = 2)
    SELECT CASE WHEN alarm THEN 2 ELSE 0 END AS exit_status,
           CASE WHEN alarm THEN 'drift' ELSE 'ok' END AS result FROM m""",
)
def monitor_decision(spark, sf):
    return drifting.monitor_decision(_shifted_report(spark, sf))


@query(
    "score_distribution_drift",
    f"""WITH {OC}, {_psi_sql("oc", ["score"], [])}
    SELECT feature, psi FROM psi WHERE batch_no = 2""",
)
def score_distribution_drift(spark, sf):
    old, new = _batches(spark, sf)
    profile = drifting.data_profile(old, ["score"], [])
    return drifting.drift_report(profile, new)


@query(
    "retrain_trigger",
    f"""WITH {OC}, o AS (SELECT count(*) AS train_rows FROM oc
      WHERE batch_no = 1),
    m AS (SELECT c_nationkey, strftime(o_orderdate, '%Y') AS year, *
          EXCLUDE (c_nationkey) FROM oc WHERE batch_no = 2),
    a AS ({_auc_sql("m", "score", "year")})
    SELECT year, CASE WHEN auc < 0.49 THEN 'degradation'
      WHEN p + n >= 0.05 * train_rows THEN 'new_data' ELSE 'none' END
      AS reason FROM a, o""",
)
def retrain_trigger(spark, sf):
    old, new = _batches(spark, sf)
    yearly = new.withColumn("year", F.date_format("o_orderdate", "yyyy"))
    auc = ev.roc_auc_exact(yearly, "y", "score", ["year"])
    train_rows = old.agg(F.count(F.lit(1))).scalar()
    reason = drifting.retrain_trigger(
        F.col("n_positive") + F.col("n_negative"),
        train_rows,
        F.lit(0.0),
        F.col("roc_auc"),
        min_auc=0.49,
    )
    return auc.select("year", reason.alias("reason"))


@query(
    "retrain_reasons",
    f"""WITH {OC}, o AS (SELECT count(*) AS train_rows, avg(o_totalprice) AS mean
      FROM oc WHERE batch_no = 1),
    m AS (SELECT c_nationkey, count(*) AS n_rows, avg(score) AS fresh,
        abs(avg(o_totalprice) / max(mean) - 1) AS moved
      FROM oc, o GROUP BY 1)
    SELECT c_nationkey, CASE WHEN c_nationkey % 7 = 3 THEN 'manual'
      WHEN fresh < 0.497 THEN 'degradation' WHEN moved > 0.02 THEN 'drift'
      WHEN n_rows >= 0.043 * train_rows THEN 'new_data'
      WHEN c_nationkey % 2 = 0 THEN 'schedule' ELSE 'none' END AS reason
    FROM m, o""",
)
def retrain_reasons(spark, sf):
    """Every reason, by the nations' sizes, mean scores and prices."""
    old, _ = _batches(spark, sf)
    base = old.agg(
        F.count(F.lit(1)).alias("train_rows"),
        F.avg("o_totalprice").alias("mean"),
    )
    nations = (
        customers(spark, sf)
        .groupBy("c_nationkey")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg("score").alias("fresh"),
            F.avg("o_totalprice").alias("price"),
        )
    )
    reason = drifting.retrain_trigger(
        F.col("n_rows"),
        base.select("train_rows").scalar(),
        F.abs(F.col("price") / base.select("mean").scalar() - 1),
        F.col("fresh"),
        scheduled=F.col("c_nationkey") % 2 == 0,
        min_new_share=0.043,
        psi_limit=0.02,
        min_auc=0.497,
        manual=F.col("c_nationkey") % 7 == 3,
    )
    return nations.select("c_nationkey", reason.alias("reason"))


# --- gates --------------------------------------------------------------------

LIMITS = validate.GateLimits(min_auc=0.49)


def _overall(spark, sf):
    """Rounded metrics of the old and the new score."""
    df = customers(spark, sf)
    out = []
    for score in ("score", "score_b"):
        metrics = ev.classification_metrics(df, "y", score, 0.5)
        row = metrics.select(
            *[F.bround(m, 4).alias(m) for m in ev.METRICS]
        ).first()
        out.append(row.asDict())
    return out


def _slices(spark, sf):
    """Slice tables of the old and the new score."""
    df = customers(spark, sf)
    return [
        ev.slice_auc(df, "y", score, SLICE_COLUMNS, SLICE_BANDS, 200)
        for score in ("score", "score_b")
    ]


def _gate_table(spark, gates):
    return validate.gate_rows(spark, gates)


NEW_SQL = f"""{OC}, {SLICES_SQL}, {_metrics_cte("m1", "oc", "score", 0.5)},
    {_metrics_cte("m2", "oc", "score_b", 0.5)},
    old AS (SELECT round_even(roc_auc, 4) AS auc, round_even(f1, 4) AS f1
            FROM m1),
    new AS (SELECT round_even(roc_auc, 4) AS auc, round_even(f1, 4) AS f1
            FROM m2)"""
MIN_AUC_SQL = """SELECT 'min_auc' AS name, auc >= 0.49 AS passed,
    printf('roc_auc is %.4f, floor 0.49', auc) AS detail FROM new"""
VS_AUC_SQL = """SELECT 'vs_champion_auc' AS name,
    old.auc - new.auc <= 0.002 AS passed, printf(
    'roc_auc loses %.4f, may lose 0.002', old.auc - new.auc) AS detail
    FROM old, new"""
VS_F1_SQL = """SELECT 'vs_champion_f1' AS name,
    old.f1 - new.f1 <= 0.005 AS passed, printf(
    'f1 loses %.4f, may lose 0.005', old.f1 - new.f1) AS detail
    FROM old, new"""


def _drops_sql() -> str:
    one = _auc_sql("sl", "score", SLICE_KEY)
    two = _auc_sql("sl", "score_b", SLICE_KEY)
    return f"""
    s1 AS ({one}), s2 AS ({two}),
    drops AS (SELECT slice_col, slice_value,
        round_even(s1.auc, 4) AS champion_auc,
        round_even(s2.auc, 4) AS challenger_auc,
        round_even(s1.auc, 4) - round_even(s2.auc, 4) AS drop
      FROM s1 JOIN s2 USING (slice_col, slice_value)
      WHERE s1.p + s1.n >= 200 AND s1.auc IS NOT NULL)"""


SLICES_GATE_SQL = """SELECT 'slices' AS name, max(drop) <= 0.02 AS passed,
    printf('%s loses %.4f, may lose 0.02',
    arg_min(concat(slice_col, '=', slice_value), (-drop, concat(slice_col,
      '=', slice_value))), max(drop)) AS detail FROM drops"""


@query(
    "slice_delta",
    f"""WITH {NEW_SQL}, {_drops_sql()} SELECT slice_col, slice_value,
    champion_auc, challenger_auc, round(drop, 6) AS "drop" FROM drops""",
)
def slice_delta(spark, sf):
    old, new = _slices(spark, sf)
    return rounded(lookups.slice_delta(old, new))


@query("gate_min_auc", f"WITH {NEW_SQL} {MIN_AUC_SQL}")
def gate_min_auc(spark, sf):
    _, new = _overall(spark, sf)
    return _gate_table(spark, [gating.floor_gate(new, LIMITS)])


@query("gate_vs_champion_auc", f"WITH {NEW_SQL} {VS_AUC_SQL}")
def gate_vs_champion_auc(spark, sf):
    old, new = _overall(spark, sf)
    return _gate_table(spark, [gating.loss_gate("vs_champion_auc", new, old, LIMITS)])


@query("gate_vs_champion_f1", f"WITH {NEW_SQL} {VS_F1_SQL}")
def gate_vs_champion_f1(spark, sf):
    old, new = _overall(spark, sf)
    return _gate_table(spark, [gating.loss_gate("vs_champion_f1", new, old, LIMITS)])


@query(
    "gate_slices", f"WITH {NEW_SQL}, {_drops_sql()} {SLICES_GATE_SQL}"
)
def gate_slices(spark, sf):
    old, new = _slices(spark, sf)
    return _gate_table(spark, [gating.slices_gate(old, new, LIMITS)])


IMPORTANCE = ["o_totalprice", "c_acctbal", "c_nationkey"]
EXPECTED = ("o_total", "c_acct")


@query(
    "gate_top_features",
    f"""WITH {OC}, i AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS f, abs(corr({c}, y)) AS w FROM oc"
        for c in IMPORTANCE)}),
    top AS (SELECT f, w FROM i ORDER BY w DESC, f LIMIT 2)
    SELECT 'top_features' AS name, bool_and(starts_with(f, 'o_total')
      OR starts_with(f, 'c_acct')) AS passed,
      concat('led by ', string_agg(f, ', ' ORDER BY f)) AS detail FROM top""",
)
def gate_top_features(spark, sf):
    # strength of the linear relation as a stand-in for model importance
    weights = profiling.pearson_with_target(
        customers(spark, sf), IMPORTANCE, "y"
    ).select(
        F.col("column").alias("feature"),
        F.abs("correlation").alias("importance"),
    )
    return _gate_table(spark, [gating.top_features_gate(weights, EXPECTED)])


@query(
    "quality_gates",
    f"""WITH {NEW_SQL}, {_drops_sql()} {MIN_AUC_SQL}
    UNION ALL {VS_AUC_SQL} UNION ALL {VS_F1_SQL}
    UNION ALL {SLICES_GATE_SQL}""",
)
def quality_gates(spark, sf):
    df = customers(spark, sf)
    (old, old_slices), (new, new_slices) = (
        (overall.first().asDict(), slices)
        for overall, slices in (
            ev.score_model(
                df, "y", score, 0.5, SLICE_COLUMNS, SLICE_BANDS
            )
            for score in ("score", "score_b")
        )
    )
    gates = gating.quality_gates(new, new_slices, LIMITS, old, old_slices)
    return _gate_table(spark, gates)


# --- registry: one registry per nation, customers as versions ------------------

EVENTS = f"""{OC}, ev AS (SELECT c_nationkey AS registry,
    concat('v', CAST(o_custkey AS VARCHAR)) AS version, id AS seq,
    CASE WHEN id % 5 = 0 THEN 'production' WHEN id % 5 = 1 THEN 'archived'
         WHEN id % 5 = 2 THEN 'rejected' ELSE 'candidate' END AS status
    FROM oc),
    cur AS (SELECT registry, version, arg_max(status, seq) AS status,
              max(seq) AS seq FROM ev GROUP BY 1, 2),
    last AS (SELECT registry, max(seq) AS last FROM ev GROUP BY 1),
    live AS (SELECT registry, arg_max(version, seq) AS version FROM cur
             WHERE status = 'production' GROUP BY 1)"""
BY = ["registry"]


def _events(spark, sf):
    rest = F.col("id") % 5
    return customers(spark, sf).select(
        F.col("c_nationkey").alias("registry"),
        F.concat(F.lit("v"), F.col("o_custkey").cast("string")).alias(
            "version"
        ),
        F.col("id").alias("seq"),
        F.when(rest == 0, "production")
        .when(rest == 1, "archived")
        .when(rest == 2, "rejected")
        .otherwise("candidate")
        .alias("status"),
    )


def _latest(events, status):
    current = registry.current_versions(events, BY)
    return (
        current.filter(F.col("status") == status)
        .groupBy(*BY)
        .agg(F.max_by("version", "seq").alias("version"))
    )


@query(
    "registry_register",
    f"""WITH {EVENTS} SELECT registry, concat('v', CAST(count(DISTINCT
      version) + 1 AS VARCHAR)) AS version,
      CAST(max(seq) + 1 AS BIGINT) AS seq, 'candidate' AS status
    FROM ev GROUP BY registry""",
)
def registry_register(spark, sf):
    return registry.register(_events(spark, sf), registry.CANDIDATE, BY)


@query(
    "registry_promote",
    f"""WITH {EVENTS}, c AS (SELECT registry, arg_max(version, seq) AS version
      FROM cur WHERE status = 'candidate' GROUP BY 1)
    SELECT registry, version, CAST(last + 1 AS BIGINT) AS seq,
           'archived' AS status FROM live JOIN last USING (registry)
    UNION ALL SELECT registry, version, CAST(last + 2 AS BIGINT), 'production'
    FROM c JOIN last USING (registry)""",
)
def registry_promote(spark, sf):
    events = _events(spark, sf)
    chosen = _latest(events, registry.CANDIDATE)
    return registry.promote(events, chosen, BY)


@query(
    "registry_rollback",
    f"""WITH {EVENTS}, p AS (SELECT registry, arg_max(version, seq) AS version
      FROM cur WHERE status = 'archived' GROUP BY 1)
    SELECT registry, version, CAST(last + 1 AS BIGINT) AS seq,
           'rolled_back' AS status FROM live JOIN last USING (registry)
    UNION ALL SELECT registry, version, CAST(last + 2 AS BIGINT), 'production'
    FROM p JOIN last USING (registry)""",
)
def registry_rollback(spark, sf):
    events = _events(spark, sf)
    failed = registry.production_version(events, BY)
    previous = _latest(events, registry.ARCHIVED)
    return registry.rollback(events, failed, previous, BY)


@query(
    "registry_current",
    f"""WITH {EVENTS} SELECT registry, version, status, seq,
    EXISTS (SELECT 1 FROM live WHERE live.registry = cur.registry
            AND live.version = cur.version) AS in_production FROM cur""",
)
def registry_current(spark, sf):
    events = _events(spark, sf)
    live = registry.production_version(events, BY).withColumn(
        "in_production", F.lit(True)
    )
    current = registry.current_versions(events, BY)
    return current.join(live, [*BY, "version"], "left").withColumn(
        "in_production", F.coalesce("in_production", F.lit(False))
    )


# --- cycles: one cycle per month of orders ---------------------------------------

MONTHS = f"""{OC}, m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, *
      FROM oc),
    g AS (SELECT month, row_number() OVER (ORDER BY month) AS cycle,
            count(*) AS n, avg(CAST(y AS DOUBLE)) AS rate FROM m
          GROUP BY month),
    auc AS ({_auc_sql("m", "score", "month")}),
    c AS (SELECT g.*, round_even(auc.auc, 4) AS auc,
            g.n >= 100 AND abs(rate - 0.33) <= 0.05 AS data_ok,
            coalesce(round_even(auc.auc, 4) >= 0.48, false) AS quality_ok
          FROM g JOIN auc ON g.month = auc.month)"""


def _monthly(spark, sf):
    from pyspark.sql import Window

    df = customers(spark, sf).withColumn(
        "month", F.date_format("o_orderdate", "yyyy-MM")
    )
    auc = ev.roc_auc_exact(df, "y", "score", ["month"])
    n = F.col("n_positive") + F.col("n_negative")
    rate = F.col("n_positive") / n
    # one row per cycle: the window runs over the cycle table
    cycle = F.row_number().over(Window.orderBy("month"))
    return auc.select(
        "month",
        cycle.alias("cycle"),
        n.alias("n"),
        rate.alias("rate"),
        F.bround("roc_auc", 4).alias("auc"),
    ).withColumns(
        {
            "data_ok": (F.col("n") >= 100)
            & (F.abs(F.col("rate") - 0.33) <= 0.05),
            "quality_ok": F.coalesce(F.col("auc") >= 0.48, F.lit(False)),
        }
    )


@query(
    "cycle_log",
    f"""WITH {MONTHS} SELECT CAST(cycle AS INTEGER) AS cycle,
    month AS data_file, CAST(n AS BIGINT) AS n_rows,
    round(rate, 6) AS positive_rate, auc,
    concat_ws(',', CASE WHEN NOT data_ok THEN 'data' END,
              CASE WHEN NOT quality_ok THEN 'min_auc' END) AS failed_gates
    FROM c""",
)
def cycle_log(spark, sf):
    return _monthly(spark, sf).select(
        "cycle",
        F.col("month").alias("data_file"),
        F.col("n").alias("n_rows"),
        r6("rate", "positive_rate"),
        "auc",
        F.concat_ws(
            ",",
            F.when(~F.col("data_ok"), "data"),
            F.when(~F.col("quality_ok"), "min_auc"),
        ).alias("failed_gates"),
    )


@query(
    "notifications",
    f"""WITH {MONTHS} SELECT CAST(cycle AS INTEGER) AS cycle,
    CASE WHEN NOT data_ok THEN 'ERROR' ELSE 'WARNING' END AS level,
    concat('cycle ', CAST(cycle AS VARCHAR), ': ', CASE WHEN NOT data_ok
      THEN 'data check failed' ELSE 'rejected by quality gates' END)
      AS message
    FROM c WHERE NOT data_ok OR NOT quality_ok""",
)
def notifications(spark, sf):
    cycles = _monthly(spark, sf).filter(
        ~F.col("data_ok") | ~F.col("quality_ok")
    )
    bad_data = ~F.col("data_ok")
    return cycles.select(
        "cycle",
        F.when(bad_data, "ERROR").otherwise("WARNING").alias("level"),
        F.format_string(
            "cycle %d: %s",
            "cycle",
            F.when(bad_data, "data check failed").otherwise(
                "rejected by quality gates"
            ),
        ).alias("message"),
    )


@query(
    "cycle_status",
    f"""WITH {MONTHS} SELECT CAST(cycle AS INTEGER) AS cycle, CASE
      WHEN NOT data_ok THEN 'rejected_data'
      WHEN NOT quality_ok THEN 'rejected_quality'
      WHEN cycle % 5 = 0 THEN 'not_approved'
      WHEN cycle % 7 = 0 THEN 'rolled_back' ELSE 'deployed' END AS status
    FROM c""",
)
def cycle_status(spark, sf):
    approved = F.when(F.col("cycle") % 5 != 0, "on duty")
    status = registry.cycle_status(
        F.col("data_ok"),
        F.col("quality_ok"),
        approved,
        F.col("cycle") % 7 != 0,
    )
    return _monthly(spark, sf).select("cycle", status.alias("status"))


# --- trials: one parameter set per nation -----------------------------------------

TRIALS = f"""{OC}, ft AS (SELECT c_nationkey AS trial,
      CAST(id % 3 AS INTEGER) AS fold,
      round(avg(CAST(y AS DOUBLE)), 4) AS score
    FROM oc GROUP BY 1, 2)"""


def _fold_table(spark, sf):
    return (
        customers(spark, sf)
        .groupBy(
            F.col("c_nationkey").alias("trial"),
            (F.col("id") % 3).cast("int").alias("fold"),
        )
        .agg(F.round(F.avg(F.col("y").cast("double")), 4).alias("score"))
    )


@query(
    "trial_log",
    f"""WITH {TRIALS}, t AS (SELECT trial, round(avg(score), 6) AS score,
      CASE WHEN trial = 24 THEN 'RUNNING' ELSE 'COMPLETE' END AS state
      FROM ft GROUP BY trial)
    SELECT CAST(count(*) AS BIGINT) AS n_complete,
           arg_min(trial, (-score, trial)) AS trial, max(score) AS score
    FROM t WHERE state = 'COMPLETE'""",
)
def trial_log(spark, sf):
    trials = (
        _fold_table(spark, sf)
        .groupBy("trial")
        .agg(r6(F.avg("score"), "score"))
        .withColumn(
            "state",
            F.when(F.col("trial") == 24, "RUNNING").otherwise("COMPLETE"),
        )
    )
    return best_trial(trials)


@query(
    "median_pruning",
    f"""WITH {TRIALS}, w AS (SELECT trial, fold, score,
      quantile_cont(score, 0.5) OVER v AS m, count(score) OVER v AS k FROM ft
      WINDOW v AS (PARTITION BY fold ORDER BY trial
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT trial, fold, score, round(m, 6) AS median_before,
           CAST(k AS BIGINT) AS n_before,
           k >= 2 AND coalesce(score < m, false) AS pruned FROM w""",
)
def median_pruning(spark, sf):
    out = prune(_fold_table(spark, sf))
    return rounded(
        out.withColumn("pruned", F.coalesce("pruned", F.lit(False)))
    )
