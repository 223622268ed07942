"""Queries: profiling, ranking, scalar functions, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from proclivity.functions import scalar
from proclivity.operators import correlation, profiling, ranking
from proclivity.operators.drift import (
    batch_overview as overview,
)
from proclivity.operators.drift import data_profile
from proclivity.operators.encoders import derived_features as derive
from proclivity.plans.catalog import query, r6, rounded
from proclivity.plans.frames import (
    BAND_LABELS,
    BANDS,
    MARKER,
    MESSY,
    OC,
    customers,
    md5_sql,
    messy,
    table,
)

DECILES = [i / 10 for i in range(1, 10)]
DECILES_SQL = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"


# --- shares and counts --------------------------------------------------------


@query(
    "value_counts_share",
    f"""WITH {OC} SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n_rows,
    round(count(*) / CAST((SELECT count(*) FROM oc) AS DOUBLE), 6) AS share
    FROM oc GROUP BY c_mktsegment""",
)
def value_counts_share(spark, sf):
    return rounded(
        profiling.value_counts_share(customers(spark, sf), "c_mktsegment")
    )


@query(
    "class_balance",
    f"""WITH {OC} SELECT y, CAST(count(*) AS BIGINT) AS n_rows,
    round(count(*) * 100.0 / CAST((SELECT count(*) FROM oc) AS DOUBLE), 6)
      AS share
    FROM oc GROUP BY y""",
)
def class_balance(spark, sf):
    return rounded(profiling.class_balance(customers(spark, sf), "y"))


NULLS = ["o_totalprice", "c_mktsegment", "o_custkey", "y"]
NULLS_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column",
    CAST(count(*) - count({c}) AS BIGINT) AS n_missing FROM messy"""
    for c in NULLS
)


@query("null_counts", f"WITH {MESSY} {NULLS_SQL}")
def null_counts(spark, sf):
    return profiling.null_counts(messy(spark, sf).select(*NULLS))


@query(
    "duplicate_count",
    f"""WITH {MESSY}, g AS (SELECT count(*) AS n FROM messy
      GROUP BY y, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment,
               o_custkey, c_nationkey, in_debt, batch_no)
    SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM g""",
)
def duplicate_count(spark, sf):
    df = messy(spark, sf)
    return profiling.duplicate_count(
        df, [c for c in df.columns if c != "id"]
    )


def _number_row(c: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS n,
    CAST(NULL AS BIGINT) AS n_unique, CAST(NULL AS VARCHAR) AS top,
    CAST(NULL AS BIGINT) AS freq, round(avg({c}), 6) AS mean,
    round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
    round(quantile_cont({c}, 0.25), 6) AS q25,
    round(quantile_cont({c}, 0.5), 6) AS q50,
    round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max
    FROM messy"""


def _text_row(c: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(sum(k) AS BIGINT) AS n,
    CAST(count(*) AS BIGINT) AS n_unique,
    arg_min(v, (-k, v)) AS top, CAST(max(k) AS BIGINT) AS freq,
    CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std,
    CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS q25,
    CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75,
    CAST(NULL AS DOUBLE) AS max
    FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS k FROM messy
          WHERE {c} IS NOT NULL GROUP BY 1) t"""


@query(
    "describe_all",
    f"""WITH {MESSY} {_number_row("o_totalprice")}
    UNION ALL {_number_row("c_acctbal")}
    UNION ALL {_text_row("c_mktsegment")}
    UNION ALL {_text_row("o_custkey")}""",
)
def describe_all(spark, sf):
    return rounded(
        profiling.describe_all(
            messy(spark, sf),
            ["o_totalprice", "c_acctbal"],
            ["c_mktsegment", "o_custkey"],
        )
    )


@query(
    "distinct_sorted",
    f"WITH {OC} SELECT DISTINCT c_nationkey FROM oc ORDER BY 1",
)
def distinct_sorted(spark, sf):
    return profiling.distinct_sorted(customers(spark, sf), "c_nationkey")


@query(
    "value_frequency_of",
    f"""WITH {OC} SELECT CAST(count(*) AS BIGINT) AS n_rows FROM oc
    WHERE c_nationkey = {MARKER}""",
)
def value_frequency_of(spark, sf):
    return profiling.value_frequency(
        customers(spark, sf), "c_nationkey", MARKER
    )


@query(
    "pct_histogram",
    """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice)
        AS hi, count(*) AS n FROM lineitem),
    b AS (SELECT CAST(least(floor((l_extendedprice - lo) * 30 / (hi - lo)),
        29) AS INTEGER) AS bin, count(*) AS k FROM lineitem, e GROUP BY 1)
    SELECT CAST(g.i AS INTEGER) AS bin,
           CAST(coalesce(k, 0) AS BIGINT) AS n_rows,
           round(coalesce(k, 0) * 100.0 / CAST(n AS DOUBLE), 6) AS pct
    FROM range(30) g(i) LEFT JOIN b ON b.bin = g.i, e""",
)
def pct_histogram(spark, sf):
    return rounded(
        profiling.pct_histogram(
            table(spark, sf, "lineitem"), "l_extendedprice", 30
        )
    )


@query(
    "crosstab_row_share",
    f"""WITH {OC} SELECT c_mktsegment,
    round(avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END), 6) AS share_0,
    round(avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END), 6) AS share_1
    FROM oc GROUP BY c_mktsegment""",
)
def crosstab_row_share(spark, sf):
    return rounded(
        profiling.crosstab_row_share(
            customers(spark, sf), "c_mktsegment", "y"
        )
    )


@query(
    "group_conversion",
    f"""WITH {OC}, g AS (SELECT o_custkey, count(*) AS n, sum(y) AS pos
      FROM oc GROUP BY o_custkey)
    SELECT round(n * 100.0 / CAST((SELECT count(*) FROM oc) AS DOUBLE), 6)
             AS share_pct,
           round(sum(pos) / CAST(sum(n) AS DOUBLE), 6) AS conversion,
           CAST(sum(n) AS BIGINT) AS size
    FROM g GROUP BY n""",
)
def group_conversion(spark, sf):
    # customers: many categories share the same size and fall together
    return rounded(
        profiling.group_conversion(customers(spark, sf), "o_custkey", "y")
    )


@query(
    "rare_to_other",
    f"""WITH {OC}, t AS (SELECT count(*) AS n FROM oc),
    g AS (SELECT c_nationkey, count(*) AS k, sum(y) AS pos FROM oc GROUP BY 1)
    SELECT CASE WHEN k / CAST(n AS DOUBLE) > 0.04
                THEN CAST(c_nationkey AS VARCHAR) ELSE 'Other' END AS category,
           CAST(sum(k) AS BIGINT) AS n_rows,
           round(sum(k) / CAST(max(n) AS DOUBLE), 6) AS share,
           round(sum(pos) / CAST(sum(k) AS DOUBLE), 6) AS conversion
    FROM g, t GROUP BY 1""",
)
def rare_to_other(spark, sf):
    return rounded(
        profiling.rare_to_other(
            customers(spark, sf), "c_nationkey", "y", 0.04
        )
    )


PEARSON = ["o_totalprice", "c_acctbal", "c_nationkey", "score"]
PEARSON_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(corr({c}, y), 6) AS correlation
    FROM oc"""
    for c in PEARSON
)


@query("pearson_with_target", f"WITH {OC} {PEARSON_SQL}")
def pearson_with_target(spark, sf):
    return rounded(
        profiling.pearson_with_target(customers(spark, sf), PEARSON, "y")
    )


MIXED_NUMERIC = ["o_totalprice", "c_acctbal"]
MIXED_TEXT = ["c_mktsegment", "o_orderpriority", "c_nationkey", "y"]


def _keys(spark, sf):
    return correlation.binned(
        customers(spark, sf), MIXED_NUMERIC, MIXED_TEXT, 10
    )


def _chi2_sql() -> str:
    bins = [
        f"""lpad(CAST(CAST(least(floor(({c} - min({c}) OVER ()) * 10
        / (max({c}) OVER () - min({c}) OVER ())), 9) AS INTEGER) AS VARCHAR),
        4, '0') AS {c}"""
        for c in MIXED_NUMERIC
    ] + [f"CAST({c} AS VARCHAR) AS {c}" for c in MIXED_TEXT]
    names = [*MIXED_NUMERIC, *MIXED_TEXT]
    pairs = [
        (a, b) for i, a in enumerate(names) for b in names[i + 1 :]
    ]
    cells = " UNION ALL ".join(
        f"""SELECT '{a}' AS col_a, '{b}' AS col_b, {a} AS a, {b} AS b,
        count(*) AS n FROM k GROUP BY {a}, {b}"""
        for a, b in pairs
    )
    return f"""WITH {OC}, k AS (SELECT {", ".join(bins)} FROM oc),
    cells AS ({cells}),
    m AS (SELECT *, sum(n) OVER (PARTITION BY col_a, col_b, a) AS rn,
                 sum(n) OVER (PARTITION BY col_a, col_b, b) AS cn,
                 sum(n) OVER (PARTITION BY col_a, col_b) AS tn FROM cells),
    s AS (SELECT col_a, col_b, max(tn) AS tn, count(*) AS n_cells,
            count(DISTINCT a) AS la, count(DISTINCT b) AS lb,
            greatest(max(tn) * (sum(CAST(n AS DOUBLE) * n
              / (CAST(rn AS DOUBLE) * cn)) - 1), 0.0) AS chi2
          FROM m GROUP BY col_a, col_b)
    SELECT col_a, col_b, CAST(tn AS BIGINT) AS n_rows,
           CAST(la AS BIGINT) AS levels_a, CAST(lb AS BIGINT) AS levels_b,
           CAST(n_cells AS BIGINT) AS n_cells, round(chi2, 6) AS chi2,
           round(CASE WHEN least(la, lb) > 1
             THEN sqrt(chi2 / (tn * (least(la, lb) - 1))) END, 6)
             AS cramers_v
    FROM s"""


@query("chi2_matrix", _chi2_sql())
def chi2_matrix(spark, sf):
    return rounded(
        correlation.chi_square(correlation.contingency(_keys(spark, sf)))
    )


@query("phik_matrix")
def phik_matrix(spark, sf):
    return correlation.phik_matrix(_keys(spark, sf))


# --- quantiles and moments -------------------------------------------------------


@query(
    "quantile_cuts",
    f"""WITH f AS (
      SELECT 'l_extendedprice' AS feature,
             quantile_cont(l_extendedprice, {DECILES_SQL}) AS q FROM lineitem
      UNION ALL SELECT 'l_quantity', quantile_cont(l_quantity, {DECILES_SQL})
      FROM lineitem
      UNION ALL SELECT 'l_discount', quantile_cont(l_discount, {DECILES_SQL})
      FROM lineitem),
    u AS (SELECT DISTINCT feature, unnest(q) AS cut FROM f)
    SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY cut)
      - 1 AS INTEGER) AS cut_no, round(cut, 6) AS cut FROM u""",
)
def quantile_cuts(spark, sf):
    df = table(spark, sf, "lineitem")
    cuts = profiling.quantile_cuts(
        df, ["l_extendedprice", "l_quantity", "l_discount"], DECILES
    )
    return rounded(profiling.cuts_table(df, cuts))


@query(
    "robust_stats",
    """SELECT 'l_extendedprice' AS "column",
    round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
    round(quantile_cont(l_extendedprice, 0.75)
          - quantile_cont(l_extendedprice, 0.25), 6) AS iqr FROM lineitem
    UNION ALL SELECT 'l_quantity', round(quantile_cont(l_quantity, 0.5), 6),
    round(quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25),
          6) FROM lineitem""",
)
def robust_stats(spark, sf):
    return rounded(
        profiling.robust_stats(
            table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"]
        )
    )


@query(
    "moments_population",
    """SELECT 'l_extendedprice' AS "column",
    round(avg(l_extendedprice), 4) AS mean,
    round(stddev_pop(l_extendedprice), 4) AS std FROM lineitem
    UNION ALL SELECT 'l_tax', round(avg(l_tax), 4),
    round(stddev_pop(l_tax), 4) FROM lineitem""",
)
def moments_population(spark, sf):
    out = profiling.moments_population(
        table(spark, sf, "lineitem"), ["l_extendedprice", "l_tax"]
    )
    return out.select(
        "column",
        F.round("mean", 4).alias("mean"),
        F.round("std", 4).alias("std"),
    )


@query(
    "slice_grouping_sets",
    f"""WITH {OC} SELECT
      CASE WHEN grouping(c_mktsegment) = 0 THEN 'c_mktsegment'
           WHEN grouping(o_orderpriority) = 0 THEN 'o_orderpriority'
           ELSE 'in_debt' END AS slice_col,
      coalesce(c_mktsegment, o_orderpriority, in_debt) AS slice_value,
      CAST(count(*) AS BIGINT) AS n_rows,
      CAST(sum(y) AS BIGINT) AS n_positive
    FROM oc GROUP BY GROUPING SETS ((c_mktsegment), (o_orderpriority),
                                    (in_debt))""",
)
def slice_grouping_sets(spark, sf):
    return profiling.grouping_rates(
        customers(spark, sf),
        ["c_mktsegment", "o_orderpriority", "in_debt"],
        "y",
    )


def _psi_sql(new: str, numeric: list[str], categorical: list[str]) -> str:
    """CTEs: PSI of each feature of `new` against batch 1, by batch."""
    parts = []
    for c in numeric:
        parts.append(
            f"""SELECT '{c}' AS feature, batch_no,
            CAST(CASE WHEN {c} IS NULL THEN len(cuts) ELSE
              len(list_filter(cuts, lambda q: q <= {c})) END AS VARCHAR)
              AS k, count(*) AS n
            FROM {new}, (SELECT list_distinct(quantile_cont({c},
              {DECILES_SQL})) AS cuts FROM old) GROUP BY ALL"""
        )
    for c in categorical:
        parts.append(
            f"""SELECT '{c}' AS feature, batch_no,
            coalesce(CAST({c} AS VARCHAR), 'nan') AS k, count(*) AS n
            FROM {new} GROUP BY ALL"""
        )
    return f"""
    old AS (SELECT * FROM oc WHERE batch_no = 1),
    cells AS ({" UNION ALL ".join(parts)}),
    s AS (SELECT feature, batch_no, k,
            n / CAST(sum(n) OVER (PARTITION BY feature, batch_no) AS DOUBLE)
              AS share FROM cells),
    e AS (SELECT b.batch_no, s.feature, s.k, s.share FROM s,
            (SELECT DISTINCT batch_no FROM cells) b WHERE s.batch_no = 1),
    j AS (SELECT coalesce(e.batch_no, s.batch_no) AS batch_no,
            coalesce(e.feature, s.feature) AS feature,
            greatest(coalesce(s.share, 0), 0.0001) AS a,
            greatest(coalesce(e.share, 0), 0.0001) AS x
          FROM e FULL OUTER JOIN s ON e.batch_no = s.batch_no
            AND e.feature = s.feature AND e.k = s.k),
    psi AS (SELECT batch_no, feature,
              round_even(sum((a - x) * ln(a / x)), 4) AS psi
            FROM j GROUP BY 1, 2)"""


@query(
    "batch_overview",
    f"""WITH {OC}, {_psi_sql("oc", ["o_totalprice", "c_acctbal"],
                             ["c_mktsegment", "o_orderpriority"])},
    sizes AS (SELECT batch_no, count(*) AS n_rows,
                round_even(avg(CAST(y AS DOUBLE)), 4) AS positive_rate
              FROM oc GROUP BY batch_no)
    SELECT batch_no, n_rows, positive_rate,
           max(psi) AS max_psi, arg_min(feature, (-psi, feature))
             AS worst_feature
    FROM psi JOIN sizes USING (batch_no)
    GROUP BY batch_no, n_rows, positive_rate""",
)
def batch_overview(spark, sf):
    df = customers(spark, sf)
    profile = data_profile(
        df.filter(F.col("batch_no") == 1),
        ["o_totalprice", "c_acctbal"],
        ["c_mktsegment", "o_orderpriority"],
    )
    return overview(df, profile, "batch_no", "y")


NEAR = ["c_mktsegment", "o_orderpriority", "c_nationkey", "in_debt", "month"]


def _near_sql() -> str:
    parts = []
    for c in NEAR:
        rest = ", ".join(x for x in NEAR if x != c)
        parts.append(
            f"""SELECT '{c}' AS "column", CAST(count(*) AS BIGINT)
            AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows
            FROM (SELECT count(*) AS n FROM m GROUP BY {rest}
                  HAVING count(DISTINCT {c}) > 1) t"""
        )
    return f"""WITH {OC}, m AS (SELECT *, strftime(o_orderdate, '%Y-%m')
      AS month FROM oc)
    SELECT * FROM ({" UNION ALL ".join(parts)}) t WHERE n_groups > 0"""


@query("near_duplicates", _near_sql())
def near_duplicates(spark, sf):
    df = customers(spark, sf).withColumn(
        "month", F.date_format("o_orderdate", "yyyy-MM")
    )
    return profiling.near_duplicates(df, NEAR)


@query(
    "shape_head",
    f"WITH {OC} SELECT CAST(count(*) AS BIGINT) AS n_rows, "
    "13 AS n_columns FROM oc",
)
def shape_head(spark, sf):
    return profiling.shape(customers(spark, sf))


@query(
    "first_rows",
    f"""WITH {OC} SELECT id, y, o_totalprice, o_orderpriority, c_nationkey
    FROM oc ORDER BY id LIMIT 10""",
)
def first_rows(spark, sf):
    df = customers(spark, sf).select(
        "id", "y", "o_totalprice", "o_orderpriority", "c_nationkey"
    )
    return profiling.first_rows(df, "id", 10)


# --- ranking ------------------------------------------------------------------


@query(
    "top_k",
    f"""WITH {OC} SELECT id, o_totalprice FROM oc
    ORDER BY o_totalprice DESC, id LIMIT 20""",
)
def top_k(spark, sf):
    df = customers(spark, sf).select("id", "o_totalprice")
    return ranking.top_k(df, "o_totalprice", "id", 20)


@query(
    "call_list",
    f"""WITH {OC}, r AS (SELECT id, score, row_number() OVER (
      ORDER BY score DESC, {md5_sql()}) AS rn, count(*) OVER () AS n FROM oc)
    SELECT 'top 10%' AS list, id, score FROM r
    WHERE rn <= round_even(CAST(0.1 AS DOUBLE) * n, 0)
    UNION ALL SELECT 'threshold', id, score FROM oc WHERE score >= 0.8""",
)
def call_list(spark, sf):
    df = customers(spark, sf)
    by_share = ranking.call_list(df, "id", "score", share=0.1)
    by_score = ranking.call_list(df, "id", "score", threshold=0.8)
    return by_share.select(F.lit("top 10%").alias("list"), "*").unionByName(
        by_score.select(F.lit("threshold").alias("list"), "*")
    )


@query(
    "argmax_slice",
    f"""WITH {OC}, g AS (SELECT c_mktsegment AS slice,
      round(avg(CAST(y AS DOUBLE)), 6) AS rate FROM oc GROUP BY 1)
    SELECT arg_min(slice, (-rate, slice)) AS slice, max(rate) AS rate FROM g""",
)
def argmax_slice(spark, sf):
    rates = (
        customers(spark, sf)
        .groupBy(F.col("c_mktsegment").alias("slice"))
        .agg(r6(F.avg(F.col("y").cast("double")), "rate"))
    )
    return ranking.largest(rates, "rate", "slice")


@query(
    "trial_ranking",
    f"""WITH {OC}, t AS (SELECT c_nationkey AS trial,
      round(avg(CAST(y AS DOUBLE)), 4) AS score FROM oc GROUP BY 1)
    SELECT trial, score, CAST(rank() OVER (ORDER BY score DESC) AS INTEGER)
      AS rank FROM t""",
)
def trial_ranking(spark, sf):
    trials = (
        customers(spark, sf)
        .groupBy(F.col("c_nationkey").alias("trial"))
        .agg(F.round(F.avg(F.col("y").cast("double")), 4).alias("score"))
    )
    return ranking.rank_trials(trials, "score")


# --- scalar functions -----------------------------------------------------------


@query(
    "age_band",
    f"""WITH {MESSY} SELECT id, CASE
      WHEN o_totalprice IS NULL OR o_totalprice <= 0 THEN 'nan'
      WHEN o_totalprice <= 100000 THEN '0-100k'
      WHEN o_totalprice <= 200000 THEN '100-200k'
      WHEN o_totalprice <= 300000 THEN '200-300k'
      WHEN o_totalprice <= 400000 THEN '300-400k'
      WHEN o_totalprice <= 1000000 THEN '400k+' ELSE 'nan' END AS band
    FROM messy""",
)
def age_band(spark, sf):
    return messy(spark, sf).select(
        "id", scalar.age_band("o_totalprice", BANDS, BAND_LABELS).alias("band")
    )


@query(
    "clip",
    f"""WITH {MESSY} SELECT id,
    CASE WHEN o_totalprice < 50000 THEN 50000.0
         WHEN o_totalprice > 400000 THEN 400000.0
         ELSE o_totalprice END AS clipped FROM messy""",
)
def clip(spark, sf):
    return messy(spark, sf).select(
        "id",
        scalar.clip("o_totalprice", 50_000.0, 400_000.0).alias("clipped"),
    )


@query(
    "log_ratio",
    f"""WITH {OC}, g AS (SELECT c_nationkey,
      sum(CASE WHEN batch_no = 1 THEN 1 ELSE 0 END)
        / CAST((SELECT count(*) FROM oc WHERE batch_no = 1) AS DOUBLE) AS e,
      sum(CASE WHEN batch_no = 2 THEN 1 ELSE 0 END)
        / CAST((SELECT count(*) FROM oc WHERE batch_no = 2) AS DOUBLE) AS a
      FROM oc GROUP BY 1)
    SELECT c_nationkey, round((greatest(a, 0.0001) - greatest(e, 0.0001))
      * ln(greatest(a, 0.0001) / greatest(e, 0.0001)), 6) AS term FROM g""",
)
def log_ratio(spark, sf):
    df = customers(spark, sf)
    first = F.count_if(F.col("batch_no") == 1)
    second = F.count_if(F.col("batch_no") == 2)
    n1, n2 = df.agg(first.alias("n")).scalar(), df.agg(
        second.alias("n")
    ).scalar()
    return (
        df.groupBy("c_nationkey")
        .agg((first / n1).alias("e"), (second / n2).alias("a"))
        .select("c_nationkey", r6(scalar.log_ratio("a", "e"), "term"))
    )


@query(
    "round4",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round_even(l_extendedprice * l_discount / 7, 4) AS rounded
    FROM lineitem""",
)
def round4(spark, sf):
    value = F.col("l_extendedprice") * F.col("l_discount") / 7
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scalar.round4(value).alias("rounded"),
    )


@query(
    "str_key",
    f"""WITH {MESSY} SELECT id,
    CASE WHEN o_totalprice IS NULL THEN 'nan' ELSE 'value' END AS price_key,
    CAST(c_nationkey AS VARCHAR) AS nation_key FROM messy""",
)
def str_key(spark, sf):
    key = scalar.str_key("o_totalprice")
    return messy(spark, sf).select(
        "id",
        F.when(key == "nan", key).otherwise("value").alias("price_key"),
        scalar.str_key("c_nationkey").alias("nation_key"),
    )


@query(
    "prefix_match",
    """SELECT p_partkey, starts_with(p_type, 'PROMO')
      OR starts_with(p_type, 'STANDARD') AS matches FROM part""",
)
def prefix_match(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        scalar.prefix_match("p_type", ["PROMO", "STANDARD"]).alias("matches"),
    )


@query(
    "format_detail",
    f"""WITH {OC} SELECT c_nationkey, printf('largest drop %+.4f in %s',
      avg(score) - avg(score_b), CAST(c_nationkey AS VARCHAR)) AS detail
    FROM oc GROUP BY c_nationkey""",
)
def format_detail(spark, sf):
    drops = (
        customers(spark, sf)
        .groupBy("c_nationkey")
        .agg((F.avg("score") - F.avg("score_b")).alias("drop"))
    )
    return drops.select(
        "c_nationkey",
        scalar.format_detail(
            "largest drop %+.4f in %s",
            "drop",
            F.col("c_nationkey").cast("string"),
        ).alias("detail"),
    )


DERIVED = [
    "log_premium",
    "age_to_vintage",
    "premium_to_age",
    "premium_to_vintage",
    "age_group",
    "premium_group",
    "no_insurance_but_damage",
    "age_premium",
    "licensed_adult",
    "region_channel",
    "vintage_group",
]


@query(
    "derived_features",
    f"""WITH {OC}, d AS (SELECT id, CAST(20 + o_custkey % 66 AS DOUBLE)
        AS age, CAST(id % 290 + 10 AS DOUBLE) AS vintage,
        o_totalprice AS premium, CASE WHEN c_nationkey = 3 THEN 0 ELSE 1 END
          AS licence, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS insured,
        in_debt, c_nationkey, c_mktsegment FROM oc),
    q AS (SELECT quantile_cont(premium, [0.2, 0.4, 0.6, 0.8]) AS c FROM d)
    SELECT id, round(ln(1 + premium), 6) AS log_premium,
      round(age / (vintage + 1), 6) AS age_to_vintage,
      round(premium / (age + 1), 6) AS premium_to_age,
      round(premium / (vintage + 1), 6) AS premium_to_vintage,
      CASE WHEN age <= 25 THEN 1 WHEN age <= 35 THEN 2 WHEN age <= 45 THEN 3
           WHEN age <= 55 THEN 4 ELSE 5 END AS age_group,
      CAST(1 + len(list_filter(c, lambda x: x < premium)) AS INTEGER)
        AS premium_group,
      CASE WHEN insured = 0 AND in_debt = 'Yes' THEN 1 ELSE 0 END
        AS no_insurance_but_damage,
      round(age * premium / 1000, 6) AS age_premium,
      CASE WHEN licence = 1 AND age >= 18 THEN 1 ELSE 0 END AS licensed_adult,
      concat(CAST(c_nationkey AS VARCHAR), '_', c_mktsegment)
        AS region_channel,
      CASE WHEN vintage <= 100 THEN 1 WHEN vintage <= 200 THEN 2 ELSE 3 END
        AS vintage_group
    FROM d, q""",
)
def derived_features(spark, sf):
    df = customers(spark, sf).select(
        "id",
        (20 + F.col("o_custkey") % 66).alias("age"),
        (F.col("id") % 290 + 10).alias("vintage"),
        F.col("o_totalprice").alias("premium"),
        F.when(F.col("c_nationkey") == 3, 0).otherwise(1).alias("licence"),
        F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("insured"),
        "in_debt",
        "c_nationkey",
        "c_mktsegment",
    )
    out = derive(
        df, "age", "vintage", "premium", "licence", "insured", "in_debt",
        "c_nationkey", "c_mktsegment",
    )
    return rounded(out.select("id", *DERIVED))
