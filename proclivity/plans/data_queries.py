"""Queries: reading, checking, cleaning, sampling, joining, sets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from proclivity.operators import cleaning, lookups, sampling, sets, validate
from proclivity.operators.encoders import freq_tables
from proclivity.operators.profiling import quantile_cuts
from proclivity.operators.drift import shares_of
from proclivity.plans.catalog import query, r6, rounded
from proclivity.plans.frames import (
    MARKER,
    MESSY,
    OC,
    PRIORITIES,
    SEGMENTS,
    SPEC,
    customers,
    md5_sql,
    messy,
    scratch,
    table,
)
from proclivity.sources import readers, sinks

CSV_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
    ]
)
CSV_COLUMNS = CSV_SCHEMA.fieldNames()


# --- reading and writing ------------------------------------------------------


@query(
    "scan_typed",
    f"WITH {OC} SELECT id, y, o_totalprice, c_mktsegment FROM oc",
)
def scan_typed(spark, sf):
    path = scratch(spark)
    customers(spark, sf).select(*CSV_COLUMNS).write.option(
        "header", True
    ).csv(path)
    return readers.read_typed(spark, path, CSV_SCHEMA).select(
        "id", "y", "o_totalprice", "c_mktsegment"
    )


@query(
    "scan_head",
    f"WITH {OC} SELECT id, y, o_totalprice FROM oc ORDER BY id LIMIT 1000",
)
def scan_head(spark, sf):
    df = customers(spark, sf).select("id", "y", "o_totalprice")
    return readers.head_rows(df, "id", 1000)


@query(
    "scan_window",
    f"WITH {OC} SELECT id, y, o_totalprice, c_mktsegment, c_nationkey, "
    "batch_no FROM oc",
)
def scan_window(spark, sf):
    base = scratch(spark)
    df = customers(spark, sf)
    paths = []
    for number in (1, 2):
        paths.append(f"{base}/batch_{number}")
        df.filter(F.col("batch_no") == number).select(
            *CSV_COLUMNS
        ).write.option("header", True).csv(paths[-1])
    return readers.read_window(spark, paths, CSV_SCHEMA)


@query(
    "scan_optional_key",
    f"""WITH {OC}
    SELECT 'with key' AS input, true AS has_key, CAST(count(*) AS BIGINT)
      AS n_rows FROM oc
    UNION ALL SELECT 'without key', false, CAST(count(*) AS BIGINT) FROM oc""",
)
def scan_optional_key(spark, sf):
    df = customers(spark, sf).select("id", *SPEC.features)
    out = None
    for label, part in (("with key", df), ("without key", df.drop("id"))):
        rows, has_key = readers.with_optional_key(part, "id")
        one = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(label).alias("input"),
            F.lit(has_key).alias("has_key"),
            "n_rows",
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "sink_predictions",
    f"""WITH {OC} SELECT id, score AS probability,
    CAST(score >= 0.5 AS INTEGER) AS prediction FROM oc""",
)
def sink_predictions(spark, sf):
    scored = customers(spark, sf).select(
        "id",
        F.col("score").alias("probability"),
        (F.col("score") >= 0.5).cast("int").alias("prediction"),
    )
    path = scratch(spark)
    sinks.write_predictions(scored, path, id_col="id")
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("probability", T.DoubleType()),
            T.StructField("prediction", T.IntegerType()),
        ]
    )
    return readers.read_typed(spark, path, schema)


@query("dataset_manifest")
def dataset_manifest(spark, sf):
    files = readers.file_manifest(spark, f"{sf}/orders.parquet")
    rows = readers.table_manifest(table(spark, sf, "orders"))
    return files.select(
        "*",
        rows.select("n_rows").scalar().alias("n_rows"),
        rows.select("rows_hash").scalar().alias("rows_hash"),
    )


# --- checks -------------------------------------------------------------------

REQUIRED = [*SPEC.features, SPEC.target, "loyalty_points"]


@query(
    "check_required_columns",
    f"""WITH {OC}
    SELECT 'loyalty_points' AS "column", CAST(count(*) AS BIGINT) AS n_rows
    FROM oc""",
)
def check_required_columns(spark, sf):
    df = customers(spark, sf)
    absent = validate.missing_columns(df, REQUIRED)
    names = F.explode(F.array(*[F.lit(c) for c in absent])).alias("column")
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(names, "n_rows")


NULL_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column",
    CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)
    AS n_missing FROM messy"""
    for c in SPEC.features
)


@query("check_nulls", f"WITH {MESSY} {NULL_SQL}")
def check_nulls(spark, sf):
    return validate.null_counts(messy(spark, sf), SPEC.features)


@query(
    "check_domain",
    f"""WITH {MESSY}
    SELECT 'c_mktsegment' AS "column", c_mktsegment AS value,
           CAST(count(*) AS BIGINT) AS n_rows
    FROM messy WHERE c_mktsegment NOT IN {SEGMENTS} GROUP BY c_mktsegment
    UNION ALL
    SELECT 'o_orderpriority', o_orderpriority, CAST(count(*) AS BIGINT)
    FROM messy WHERE o_orderpriority NOT IN {PRIORITIES[:4]}
    GROUP BY o_orderpriority""",
)
def check_domain(spark, sf):
    return validate.unexpected_values(
        messy(spark, sf),
        {"c_mktsegment": SEGMENTS, "o_orderpriority": PRIORITIES[:4]},
    )


@query(
    "check_numeric_type",
    f"""WITH {OC}
    SELECT 'c_mktsegment' AS "column", CAST(count(*) AS BIGINT) AS n_rows
    FROM oc""",
)
def check_numeric_type(spark, sf):
    df = customers(spark, sf)
    wrong = validate.numeric_types(
        df, [*SPEC.must_be_numeric, "c_mktsegment"]
    )
    names = F.explode(F.array(*[F.lit(c) for c in wrong])).alias("column")
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(names, "n_rows")


NEGATIVE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column",
    CAST(sum(CASE WHEN {c} < 0 THEN 1 ELSE 0 END) AS BIGINT)
    AS n_negative FROM messy"""
    for c in SPEC.must_be_numeric
)


@query("check_non_negative", f"WITH {MESSY} {NEGATIVE_SQL}")
def check_non_negative(spark, sf):
    return validate.negative_counts(messy(spark, sf), SPEC.must_be_numeric)


# a target with missing and invalid values
BAD_TARGET = "CASE WHEN id % 97 = 0 THEN NULL WHEN id % 101 = 0 THEN 2 ELSE y END"


@query(
    "check_target",
    f"""WITH {OC}, t AS (SELECT {BAD_TARGET} AS y FROM oc)
    SELECT CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (y IS NULL) AS BIGINT) AS n_missing,
           CAST(count(*) FILTER (y NOT IN (0, 1)) AS BIGINT) AS n_invalid,
           round(avg(CAST(y AS DOUBLE)), 6) AS positive_rate FROM t""",
)
def check_target(spark, sf):
    df = customers(spark, sf).select(F.expr(BAD_TARGET).alias("y"))
    return rounded(validate.target_summary(df, "y"))


@query(
    "check_min_rows",
    f"""WITH {OC}
    SELECT 'min_rows' AS name, count(*) >= 1000 AS passed,
           concat('has ', count(*), ' of 1000 rows') AS detail
    FROM oc WHERE batch_no = 2""",
)
def check_min_rows(spark, sf):
    one = validate.target_summary(
        customers(spark, sf).filter(F.col("batch_no") == 2), "y"
    )
    gate = validate.min_rows_gate(F.col("n_rows"), 1000)
    return one.select(gate.alias("g")).select("g.*")


@query(
    "check_positive_rate",
    f"""WITH {OC}
    SELECT 'positive_rate' AS name,
           abs(avg(CAST(y AS DOUBLE)) - 0.123) <= 0.03 AS passed,
           printf('%.3f positive, 0.030 around 0.123 allowed',
                  avg(CAST(y AS DOUBLE))) AS detail
    FROM oc WHERE batch_no = 2""",
)
def check_positive_rate(spark, sf):
    one = validate.target_summary(
        customers(spark, sf).filter(F.col("batch_no") == 2), "y"
    )
    gate = validate.positive_rate_gate(F.col("positive_rate"), 0.123, 0.03)
    return one.select(gate.alias("g")).select("g.*")


LIMITS = validate.GateLimits(
    positive_rate=0.33, positive_rate_tolerance=0.005, min_rows=1000
)
# the accepted batch has no negative column in its numeric roles
CHECK_SPEC = SPEC.__class__(
    id="id",
    target="y",
    high_card=("c_nationkey",),
    binary=("in_debt",),
    ordinal=SPEC.ordinal,
    robust=("o_totalprice",),
    allowed=SPEC.allowed,
)

GATES_SQL = f"""WITH {MESSY}, good AS (SELECT * FROM oc WHERE batch_no = 1)
  SELECT 'defective' AS batch, 'schema' AS name, false AS passed,
         concat('o_totalprice: null in ',
                count(*) FILTER (o_totalprice IS NULL),
                ' rows') AS detail FROM messy
  UNION ALL
  SELECT 'accepted', 'schema', true, 'every rule holds'
  UNION ALL
  SELECT 'accepted', 'min_rows', count(*) >= 1000,
         concat('has ', count(*), ' of 1000 rows') FROM good
  UNION ALL
  SELECT 'accepted', 'positive_rate',
         abs(avg(CAST(y AS DOUBLE)) - 0.33) <= 0.005,
         printf('%.3f positive, 0.005 around 0.330 allowed',
                avg(CAST(y AS DOUBLE))) FROM good"""


@query("data_gates", GATES_SQL)
def data_gates(spark, sf):
    bad = validate.check_batch(messy(spark, sf), CHECK_SPEC, LIMITS)
    good = validate.check_batch(
        customers(spark, sf).filter(F.col("batch_no") == 1),
        CHECK_SPEC,
        LIMITS,
    )
    labelled = [
        validate.gate_rows(spark, gates).select(
            F.lit(batch).alias("batch"), "*"
        )
        for batch, gates in (("defective", bad), ("accepted", good))
    ]
    return labelled[0].unionByName(labelled[1])


@query(
    "failed_gates",
    f"WITH g AS ({GATES_SQL}) SELECT * FROM g WHERE NOT passed",
)
def failed_gates(spark, sf):
    return validate.failed_gates(data_gates(spark, sf))


# --- cleaning -----------------------------------------------------------------


@query(
    "drop_anomaly",
    f"WITH {OC} SELECT id, c_nationkey FROM oc WHERE c_nationkey <> {MARKER}",
)
def drop_anomaly(spark, sf):
    df = customers(spark, sf).select("id", "c_nationkey")
    return cleaning.drop_anomaly(df, "c_nationkey", MARKER)


@query(
    "drop_incomplete",
    f"""WITH {MESSY} SELECT id, o_totalprice FROM messy
    WHERE o_totalprice IS NOT NULL""",
)
def drop_incomplete(spark, sf):
    df = messy(spark, sf).select("id", "o_totalprice")
    return cleaning.drop_incomplete(df, ["o_totalprice"])


CONTENT = (
    "y, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, o_custkey, "
    "c_nationkey, in_debt, batch_no"
)


@query(
    "drop_duplicates",
    f"WITH {MESSY} SELECT min(id) AS id, {CONTENT} FROM messy GROUP BY {CONTENT}",
)
def drop_duplicates(spark, sf):
    return cleaning.drop_duplicates(messy(spark, sf), "id")


@query(
    "clean_audit",
    f"""WITH {MESSY},
    a AS (SELECT * FROM messy WHERE c_nationkey <> {MARKER}),
    b AS (SELECT * FROM a WHERE o_totalprice IS NOT NULL),
    c AS (SELECT DISTINCT {CONTENT} FROM b),
    n AS (SELECT (SELECT count(*) FROM messy) AS n0,
                 (SELECT count(*) FROM a) AS n1,
                 (SELECT count(*) FROM b) AS n2,
                 (SELECT count(*) FROM c) AS n3)
    SELECT 0 AS step_no, 'input' AS step, n0 AS n_rows,
           CAST(0 AS BIGINT) AS n_removed FROM n
    UNION ALL SELECT 1, 'drop_anomaly', n1, n0 - n1 FROM n
    UNION ALL SELECT 2, 'drop_incomplete', n2, n1 - n2 FROM n
    UNION ALL SELECT 3, 'drop_duplicates', n3, n2 - n3 FROM n""",
)
def clean_audit(spark, sf):
    return cleaning.clean_audit(messy(spark, sf), SPEC)


@query(
    "clean",
    f"""WITH {MESSY} SELECT min(id) AS id, {CONTENT} FROM messy
    WHERE c_nationkey <> {MARKER} AND o_totalprice IS NOT NULL
    GROUP BY {CONTENT}""",
)
def clean(spark, sf):
    return cleaning.clean(messy(spark, sf), SPEC)


@query(
    "select_features",
    f"""WITH {OC} SELECT id, c_nationkey, in_debt, o_orderpriority,
    o_totalprice, c_acctbal, y FROM oc""",
)
def select_features(spark, sf):
    return cleaning.select_features(customers(spark, sf), SPEC)


@query(
    "recode_map",
    f"""WITH {MESSY} SELECT id,
    CASE in_debt WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS in_debt,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
         WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3
         WHEN 'MACHINERY' THEN 4 END AS c_mktsegment
    FROM messy""",
)
def recode_map(spark, sf):
    df = messy(spark, sf).select("id", "in_debt", "c_mktsegment")
    return cleaning.recode_columns(
        df,
        {
            "in_debt": {"No": 0, "Yes": 1},
            "c_mktsegment": {s: i for i, s in enumerate(SEGMENTS)},
        },
    )


@query(
    "cast_category",
    f"""WITH {OC} SELECT id, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    CAST(o_custkey AS VARCHAR) AS o_custkey FROM oc""",
)
def cast_category(spark, sf):
    df = customers(spark, sf).select("id", "c_nationkey", "o_custkey")
    return cleaning.cast_category(df, ["c_nationkey", "o_custkey"])


@query(
    "filter_valid_for_profile",
    f"""WITH {MESSY} SELECT id, c_mktsegment, o_totalprice FROM messy
    WHERE c_mktsegment IN {SEGMENTS} AND o_totalprice IS NOT NULL""",
)
def filter_valid_for_profile(spark, sf):
    df = messy(spark, sf).select("id", "c_mktsegment", "o_totalprice")
    return cleaning.valid_for_profile(df, {"c_mktsegment": SEGMENTS})


@query(
    "threshold_decision",
    f"""WITH {OC} SELECT id, CAST(score >= 0.62 AS INTEGER) AS prediction
    FROM oc""",
)
def threshold_decision(spark, sf):
    from proclivity.functions.scalar import threshold_decision as decide

    return customers(spark, sf).select(
        "id", decide("score", 0.62).alias("prediction")
    )


# --- sampling -----------------------------------------------------------------


@query(
    "stratified_sample",
    f"""WITH {OC}, r AS (
      SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY {md5_sql()})
               AS rn, count(*) OVER (PARTITION BY y) AS n FROM oc)
    SELECT id, y FROM r
    WHERE rn <= round_even(CAST(0.03 AS DOUBLE) * n, 0)""",
)
def stratified_sample(spark, sf):
    df = customers(spark, sf).select("id", "y")
    return sampling.stratified_sample(df, "id", "y", 0.03)


def _quota_sql(source: str, size: str, n: str) -> str:
    """Largest remainder shares of `size` rows by class, as CTEs."""
    return f"""
    q1 AS (SELECT y, {n} AS n, {size} AS size, sum({n}) OVER () AS total
           FROM {source}),
    q2 AS (SELECT y, n, size, CAST(n AS DOUBLE) * size / total AS ideal
           FROM q1),
    q3 AS (SELECT y, n, size, floor(ideal) AS base, ideal - floor(ideal)
             AS rest FROM q2),
    q4 AS (SELECT y, n, base, size - sum(base) OVER () AS open,
                  row_number() OVER (ORDER BY rest DESC, y) AS place FROM q3),
    quota AS (SELECT y, n, CAST(base AS BIGINT)
                + CASE WHEN place <= open THEN 1 ELSE 0 END AS k FROM q4)"""


SPLIT_SQL = f"""{OC},
    counts AS (SELECT y, count(*) AS c FROM oc GROUP BY y),
    {_quota_sql("counts", "ceil(0.25 * (sum(c) OVER ()))", "c")},
    ranked AS (SELECT oc.*, row_number() OVER (
        PARTITION BY y ORDER BY {md5_sql()}) AS rn FROM oc),
    split AS (SELECT ranked.*, CASE WHEN rn <= k THEN 'test' ELSE 'train'
        END AS split FROM ranked JOIN quota USING (y))"""


@query("stratified_split", f"WITH {SPLIT_SQL} SELECT id, y, split FROM split")
def stratified_split(spark, sf):
    df = customers(spark, sf).select("id", "y")
    return sampling.stratified_split(df, "id", "y", 0.25)


@query(
    "train_val_test_split",
    f"""WITH {OC},
    c0 AS (SELECT y, count(*) AS c FROM oc GROUP BY y),
    {_quota_sql("c0", "ceil(0.25 * (sum(c) OVER ()))", "c")},
    left_over AS (SELECT y, n - k AS c, k AS k_test FROM quota),
    {_quota_sql("left_over", "ceil(0.03 * (sum(c) OVER ()))", "c")
        .replace("q1", "v1").replace("q2", "v2").replace("q3", "v3")
        .replace("q4", "v4").replace("quota", "vquota")},
    ranked AS (SELECT id, y, row_number() OVER (
        PARTITION BY y ORDER BY {md5_sql()}) AS rn FROM oc)
    SELECT id, y, CASE WHEN rn <= k_test THEN 'test'
                       WHEN rn <= k_test + vquota.k THEN 'val'
                       ELSE 'train' END AS split
    FROM ranked JOIN left_over USING (y) JOIN vquota USING (y)""",
)
def train_val_test_split(spark, sf):
    df = customers(spark, sf).select("id", "y")
    return sampling.train_val_test_split(df, "id", "y", 0.25, 0.03)


@query(
    "stratified_folds",
    f"""WITH {OC} SELECT id, y, CAST(ntile(3) OVER (
    PARTITION BY y ORDER BY {md5_sql()}) - 1 AS INTEGER) AS fold FROM oc""",
)
def stratified_folds(spark, sf):
    df = customers(spark, sf).select("id", "y")
    return sampling.stratified_folds(df, "id", "y", 3)


@query(
    "cut_batches",
    f"""WITH {OC}, r AS (SELECT id, row_number() OVER (ORDER BY {md5_sql()})
      AS rn, count(*) OVER () // 7 AS size FROM oc)
    SELECT id, CAST((rn - 1) // size + 1 AS INTEGER) AS batch_no FROM r
    WHERE rn <= 6 * size""",
)
def cut_batches(spark, sf):
    df = customers(spark, sf).select("id")
    # six batches; what is left over stays out
    return sampling.cut_batches(df, "id", df.count() // 7, 6)


@query(
    "control_rows",
    f"""WITH {SPLIT_SQL} SELECT id, y, score FROM split WHERE split = 'test'
    ORDER BY id LIMIT 100""",
)
def control_rows(spark, sf):
    df = customers(spark, sf).select("id", "y", "score")
    parts = sampling.stratified_split(df, "id", "y", 0.25)
    test = parts.filter(F.col("split") == "test").drop("split")
    return sampling.control_rows(test, "id")


@query(
    "split_balance",
    f"""WITH {SPLIT_SQL} SELECT split, CAST(count(*) AS BIGINT) AS n_rows,
    round(avg(CAST(y AS DOUBLE)), 6) AS positive_rate
    FROM split GROUP BY split""",
)
def split_balance(spark, sf):
    return rounded(
        sampling.split_balance(stratified_split(spark, sf), "y")
    )


@query(
    "new_batch_holdout",
    f"""WITH {OC}, new AS (SELECT * FROM oc WHERE batch_no = 2),
    counts AS (SELECT y, count(*) AS c FROM new GROUP BY y),
    {_quota_sql("counts", "ceil(0.25 * (sum(c) OVER ()))", "c")},
    ranked AS (SELECT id, y, row_number() OVER (
        PARTITION BY y ORDER BY {md5_sql()}) AS rn FROM new)
    SELECT id, y, CASE WHEN rn <= k THEN 'test' ELSE 'train' END AS split
    FROM ranked JOIN quota USING (y)
    UNION ALL SELECT id, y, 'train' FROM oc WHERE batch_no = 1""",
)
def new_batch_holdout(spark, sf):
    df = customers(spark, sf).select("id", "y", "batch_no")
    parts = sampling.holdout_of_new_batch(
        df.filter(F.col("batch_no") == 1),
        df.filter(F.col("batch_no") == 2),
        SPEC,
    )
    return parts.select("id", "y", "split")


@query(
    "split_disjoint",
    f"""WITH {SPLIT_SQL} SELECT CAST(count(*) AS BIGINT) AS n_shared
    FROM (SELECT id FROM split GROUP BY id
          HAVING count(DISTINCT split) > 1) t""",
)
def split_disjoint(spark, sf):
    return sampling.shared_keys(stratified_split(spark, sf), "id")


# --- joins --------------------------------------------------------------------


@query(
    "lookup_left_default",
    f"""WITH {OC}, f AS (
      SELECT CAST(c_nationkey AS VARCHAR) AS k,
             count(*) / CAST((SELECT count(*) FROM oc) AS DOUBLE) AS share
      FROM oc GROUP BY c_nationkey),
    other AS (SELECT coalesce(sum(share), 0) AS o FROM f WHERE share < 0.04)
    SELECT id, round(coalesce(f.share, other.o), 6) AS freq
    FROM oc LEFT JOIN f ON CAST(c_nationkey AS VARCHAR) = k
      AND f.share >= 0.04, other""",
)
def lookup_left_default(spark, sf):
    df = customers(spark, sf).select("id", "c_nationkey")
    common, other = freq_tables(df, ["c_nationkey"], 0.04)
    joined = lookups.lookup_default(
        df, "c_nationkey", common, "share", other, "freq"
    )
    return joined.select("id", r6("freq"))


@query(
    "full_outer_shares",
    f"""WITH {MESSY},
    e AS (SELECT c_mktsegment AS category,
            count(*) / CAST((SELECT count(*) FROM oc) AS DOUBLE) AS share
          FROM oc GROUP BY 1),
    a AS (SELECT c_mktsegment AS category,
            count(*) / CAST((SELECT count(*) FROM messy) AS DOUBLE) AS share
          FROM messy GROUP BY 1)
    SELECT category, round(coalesce(e.share, 0), 6) AS expected,
           round(coalesce(a.share, 0), 6) AS actual
    FROM e FULL OUTER JOIN a USING (category)""",
)
def full_outer_shares(spark, sf):
    expected = shares_of(customers(spark, sf), {}, ["c_mktsegment"])
    actual = shares_of(messy(spark, sf), {}, ["c_mktsegment"])
    return rounded(lookups.outer_shares(expected, actual, ["category"]))


@query(
    "unseen_categories",
    f"""WITH {MESSY} SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n_rows
    FROM messy WHERE c_mktsegment NOT IN (SELECT c_mktsegment FROM oc)
    GROUP BY c_mktsegment""",
)
def unseen_categories(spark, sf):
    return lookups.unseen_categories(
        customers(spark, sf), messy(spark, sf), "c_mktsegment"
    )


@query(
    "bin_lookup",
    f"""WITH {MESSY}, q AS (SELECT list_distinct(quantile_cont(
        o_totalprice, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS cuts
      FROM oc WHERE batch_no = 1)
    SELECT id, CAST(CASE WHEN o_totalprice IS NULL THEN len(cuts)
      ELSE len(list_filter(cuts, lambda c: c <= o_totalprice)) END
      AS INTEGER) AS bin
    FROM messy, q""",
)
def bin_lookup(spark, sf):
    old = customers(spark, sf).filter(F.col("batch_no") == 1)
    cuts = quantile_cuts(old, ["o_totalprice"])["o_totalprice"]
    rows = lookups.bin_lookup(messy(spark, sf), "o_totalprice", cuts, "bin")
    return rows.select("id", "bin")


@query(
    "map_back_share",
    f"""WITH {OC} SELECT id, round(count(*) OVER (PARTITION BY c_nationkey)
    * 100.0 / count(*) OVER (), 6) AS share_pct FROM oc""",
)
def map_back_share(spark, sf):
    df = customers(spark, sf).select("id", "c_nationkey")
    out = lookups.map_back_share(df, "c_nationkey", "share_pct")
    return out.select("id", r6("share_pct"))


# --- sets ---------------------------------------------------------------------


@query(
    "union_all_batches",
    f"WITH {OC} SELECT id, y, batch_no FROM oc",
)
def union_all_batches(spark, sf):
    df = customers(spark, sf).select("id", "y", "batch_no")
    return sets.union_batches(
        df.filter(F.col("batch_no") == 1), df.filter(F.col("batch_no") == 2)
    )


@query(
    "except_allowed",
    f"""WITH {MESSY} SELECT DISTINCT c_mktsegment FROM messy
    WHERE c_mktsegment NOT IN {SEGMENTS}""",
)
def except_allowed(spark, sf):
    return sets.except_allowed(messy(spark, sf), "c_mktsegment", SEGMENTS)


@query(
    "union_keys",
    f"""WITH {MESSY} SELECT c_mktsegment AS category FROM oc
    UNION SELECT c_mktsegment FROM messy""",
)
def union_keys(spark, sf):
    return sets.union_keys(
        customers(spark, sf), messy(spark, sf), "c_mktsegment"
    )
