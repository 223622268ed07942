"""Registry of named queries and their independent SQL answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `sql` answers it without this package."""

    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def r6(c: Column | str, name: str | None = None) -> Column:
    """Rounded to six decimals, keeping or giving a name."""
    if isinstance(c, str):
        name = name or c
        c = F.col(c)
    out = F.round(c, DIGITS)
    return out.alias(name) if name else out


def rounded(df: DataFrame) -> DataFrame:
    """All floating point columns rounded to six decimals."""
    return df.select(
        *[r6(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )
