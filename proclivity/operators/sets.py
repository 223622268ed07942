"""Set operations on batches and categories."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.scalar import str_key


def union_batches(*batches: DataFrame) -> DataFrame:
    """All rows of all batches, matched by column name."""
    out = batches[0]
    for batch in batches[1:]:
        out = out.unionByName(batch)
    return out


def except_allowed(
    df: DataFrame, column: str, allowed: Sequence[Any]
) -> DataFrame:
    """Observed values that are not allowed."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
        .select(column)
        .distinct()
    )


def union_keys(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Categories that occur in either table."""
    keys = a.select(str_key(column).alias("category")).distinct()
    more = b.select(str_key(column).alias("category")).distinct()
    return keys.union(more).distinct()
