"""The benchmark tables seen as customer tables, in Spark and in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity.functions.scalar import hash_key
from proclivity.session import shared_folder
from proclivity.spec import TableSpec

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = (
    "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY",
)
BANDS = (0, 100_000, 200_000, 300_000, 400_000, 1_000_000)
BAND_LABELS = ("0-100k", "100-200k", "200-300k", "300-400k", "400k+")
MARKER = 7

SPEC = TableSpec(
    id="id",
    target="y",
    high_card=("c_nationkey",),
    binary=("in_debt",),
    ordinal={"o_orderpriority": PRIORITIES},
    robust=("o_totalprice",),
    numeric=("c_acctbal",),
    allowed={
        "c_mktsegment": SEGMENTS,
        "in_debt": ("No", "Yes"),
        "o_orderpriority": PRIORITIES,
    },
    anomaly=("c_nationkey", MARKER),
    profile_numeric=("o_totalprice", "c_acctbal"),
    profile_categorical=("c_mktsegment", "o_orderpriority"),
    slice_columns=("c_mktsegment", "o_orderpriority"),
    slice_bands={"o_totalprice": (BANDS, BAND_LABELS)},
)

# balances may be negative in this table: a spec for full validation runs on
# the shifted balance instead
SCORING_SPEC = TableSpec(
    id="id",
    target="y",
    high_card=("c_nationkey",),
    binary=("in_debt",),
    ordinal={"o_orderpriority": PRIORITIES},
    robust=("o_totalprice",),
    numeric=("credit",),
    allowed={
        "in_debt": ("No", "Yes"),
        "o_orderpriority": PRIORITIES,
    },
    profile_numeric=("o_totalprice", "credit"),
    profile_categorical=("in_debt", "o_orderpriority"),
    slice_columns=("in_debt", "o_orderpriority"),
    slice_bands={"o_totalprice": (BANDS, BAND_LABELS)},
)


# Declared types, so that reading starts no job
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, "
    "c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, "
    "l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, "
    "p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, "
    "event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "documents": "doc_id bigint, text string, lang string, source string, "
    "n_chars bigint",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer as a propensity table.

    The join has no hint: adaptive execution broadcasts the customer side
    only if its measured size is small.
    """
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    joined = o.join(c, o.o_custkey == c.c_custkey)
    key = F.col("o_orderkey")
    return joined.select(
        key.alias("id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
        "o_totalprice",
        "c_acctbal",
        "o_orderpriority",
        "c_mktsegment",
        "o_custkey",
        "c_nationkey",
        F.when(F.col("c_acctbal") < 0, "Yes").otherwise("No").alias(
            "in_debt"
        ),
        "o_orderdate",
        F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("date"), 1)
        .otherwise(2)
        .alias("batch_no"),
        (((key * 37) % 1000).cast("double") / 1000).alias("score"),
        (((key * 53) % 1000).cast("double") / 1000).alias("score_b"),
    )


def creditors(spark: SparkSession, sf: str) -> DataFrame:
    """The propensity table with a balance that is never negative."""
    df = customers(spark, sf)
    return df.withColumn("credit", F.abs("c_acctbal"))


OC = """
oc AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
         o_totalprice, c_acctbal, o_orderpriority, c_mktsegment,
         o_custkey, c_nationkey,
         CASE WHEN c_acctbal < 0 THEN 'Yes' ELSE 'No' END AS in_debt,
         o_orderdate,
         CASE WHEN o_orderdate < DATE '1998-01-01' THEN 1 ELSE 2 END
           AS batch_no,
         CAST((o_orderkey * 37) % 1000 AS DOUBLE) / 1000 AS score,
         CAST((o_orderkey * 53) % 1000 AS DOUBLE) / 1000 AS score_b
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

MESSY_COLUMNS = [
    "id",
    "y",
    "o_totalprice",
    "c_acctbal",
    "o_orderpriority",
    "c_mktsegment",
    "o_custkey",
    "c_nationkey",
    "in_debt",
    "batch_no",
]


def messy(spark: SparkSession, sf: str) -> DataFrame:
    """The propensity table with known defects.

    Some prices are missing, some segments are unknown and some rows occur
    twice under another key; the defects follow from the key, so SQL can
    produce the same ones.
    """
    df = customers(spark, sf).select(*MESSY_COLUMNS)
    df = df.withColumns(
        {
            "o_totalprice": F.when(F.col("id") % 97 != 0, F.col("o_totalprice")),
            "c_mktsegment": F.when(
                F.col("id") % 101 == 0, "Unknown"
            ).otherwise(F.col("c_mktsegment")),
        }
    )
    again = df.filter(F.col("id") % 89 == 0).withColumn(
        "id", F.col("id") + 1_000_000_000
    )
    return df.unionByName(again)


MESSY = (
    OC
    + """,
once AS (
  SELECT id, y, CASE WHEN id % 97 <> 0 THEN o_totalprice END AS o_totalprice,
         c_acctbal, o_orderpriority,
         CASE WHEN id % 101 = 0 THEN 'Unknown' ELSE c_mktsegment END
           AS c_mktsegment,
         o_custkey, c_nationkey, in_debt, batch_no
  FROM oc),
messy AS (
  SELECT * FROM once
  UNION ALL
  SELECT id + 1000000000 AS id, y, o_totalprice, c_acctbal, o_orderpriority,
         c_mktsegment, o_custkey, c_nationkey, in_debt, batch_no
  FROM once WHERE id % 89 = 0)"""
)


def md5_sql(seed: int = 42, column: str = "id") -> str:
    """SQL of the hashed order key."""
    return f"md5(concat(CAST({column} AS VARCHAR), ':{seed}'))"


def order_key(seed: int = 42):
    """The hashed order key of the propensity table."""
    return hash_key("id", seed)


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared folder of the cluster."""
    return f"{shared_folder(spark)}/query-{uuid.uuid4().hex}"
