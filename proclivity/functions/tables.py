"""Helpers for small summary tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SMALL_ROWS = 5_000


def local_table(
    spark: SparkSession, rows: Sequence[Sequence[Any]], ddl: str
) -> DataFrame:
    """A few driver-side rows as a local relation.

    Arrow input becomes a local relation whose size the planner knows, so
    joins broadcast it by size and filters on it are folded.
    """
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    columns = [
        pa.array([r[i] for r in rows], type=f.type)
        for i, f in enumerate(schema)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema))


def settle(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Fix a summary table's rows when it is small, else return it unchanged.

    At most `max_rows + 1` rows are read. A settled table is a local relation:
    the planner knows its size and broadcasts it by itself, and plans built on
    top do not recompute the summary. A larger table stays a plan, so joins
    with it are ordinary shuffled joins.
    """
    found = df.limit(max_rows + 1).toArrow()
    if found.num_rows > max_rows:
        return df
    return df.sparkSession.createDataFrame(found)


def join_null_safe(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join where a null key matches a null key; keeps `left`'s keys."""
    renamed = right.select(
        *[
            F.col(c).alias(f"__r_{c}") if c in on else F.col(c)
            for c in right.columns
        ]
    )
    cond = None
    for c in on:
        part = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        cond = part if cond is None else cond & part
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__r_{c}" for c in on])
