"""The whole path from raw rows to a metrics row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity.models.bundle import linear_score_sql
from proclivity.operators.cleaning import clean
from proclivity.operators.encoders import fit_encoded_features
from proclivity.operators.evaluation import classification_metrics
from proclivity.operators.sampling import stratified_split
from proclivity.session import staged
from proclivity.plans.catalog import query, rounded
from proclivity.plans.frames import (
    MARKER,
    MESSY,
    PRIORITIES,
    SPEC,
    md5_sql,
    messy,
)

WEIGHTS = (0.5, -0.3, 2.0, -0.1, 0.4)
INTERCEPT = -0.75

CONTENT = (
    "y, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, o_custkey, "
    "c_nationkey, in_debt, batch_no"
)
ORDINAL = (
    "CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITIES))
    + " END"
)


@query(
    "flagship",
    f"""WITH {MESSY},
    cleaned AS (SELECT min(id) AS id, {CONTENT} FROM messy
      WHERE c_nationkey <> {MARKER} AND o_totalprice IS NOT NULL
      GROUP BY {CONTENT}),
    counts AS (SELECT y, count(*) AS c FROM cleaned GROUP BY y),
    q1 AS (SELECT y, c, ceil(0.25 * (sum(c) OVER ())) AS size,
             sum(c) OVER () AS total FROM counts),
    q2 AS (SELECT y, c, size, CAST(c AS DOUBLE) * size / total AS ideal
           FROM q1),
    q3 AS (SELECT y, floor(ideal) AS base, size - sum(floor(ideal)) OVER ()
             AS open, row_number() OVER (ORDER BY ideal - floor(ideal) DESC,
             y) AS place FROM q2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY y
      ORDER BY {md5_sql()}) AS rn FROM cleaned),
    split AS (SELECT ranked.*, rn <= base + CASE WHEN place <= open THEN 1
      ELSE 0 END AS is_test FROM ranked JOIN q3 USING (y)),
    train AS (SELECT * FROM split WHERE NOT is_test),
    s AS (SELECT quantile_cont(o_totalprice, 0.5) AS med,
      quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)
        AS iqr, avg(c_acctbal) AS mean, stddev_pop(c_acctbal) AS std
      FROM train),
    f AS (SELECT c_nationkey AS k, count(*) / CAST((SELECT count(*)
        FROM train) AS DOUBLE) AS share FROM train GROUP BY 1),
    o AS (SELECT coalesce(sum(share), 0.0) AS o FROM f WHERE share < 0.04),
    x AS (SELECT y, 1.0 / (1.0 + exp(-(-0.75
        + 0.5 * ((o_totalprice - med) / iqr)
        - 0.3 * ((c_acctbal - mean) / std)
        + 2.0 * coalesce(f.share, o.o)
        - 0.1 * CAST(in_debt = 'Yes' AS INTEGER)
        + 0.4 * {ORDINAL}))) AS p
      FROM split LEFT JOIN f ON c_nationkey = k AND f.share >= 0.04, s, o
      WHERE is_test),
    r AS (SELECT y, p, rank() OVER (ORDER BY p)
        + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS mid FROM x),
    a AS (SELECT (sum(mid) FILTER (y = 1) - count(*) FILTER (y = 1)
        * (count(*) FILTER (y = 1) + 1) / 2.0) / (CAST(count(*)
        FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0)) AS auc,
        count(*) AS n, count(*) FILTER (y = 1) AS np,
        count(*) FILTER (p >= 0.5) AS nf,
        count(*) FILTER (p >= 0.5 AND y = 1) AS tp FROM r)
    SELECT round(tp / CAST(nf AS DOUBLE), 6) AS precision,
      round(tp / CAST(np AS DOUBLE), 6) AS recall,
      round(2 * tp / CAST(nf + np AS DOUBLE), 6) AS f1,
      round(auc, 6) AS roc_auc, CAST(n AS BIGINT) AS n_rows,
      CAST(np AS BIGINT) AS n_positive, CAST(nf AS BIGINT) AS n_flagged
    FROM a""",
)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Clean, split, fit encoders on train, score test with a linear rule."""
    # stored once, then read by columns: the split and every encoder pass
    cleaned = staged(clean(messy(spark, sf), SPEC))
    parts = stratified_split(cleaned, "id", "y", 0.25)
    train = parts.filter(F.col("split") == "train")
    test = parts.filter(F.col("split") == "test")
    encoder = fit_encoded_features(train, SPEC, 0.04)
    sql = linear_score_sql(
        list(encoder.expressions.values()), list(WEIGHTS), INTERCEPT
    )
    scored = test.select("y", F.expr(sql).alias("probability"))
    return rounded(classification_metrics(scored, "y", "probability", 0.5))
