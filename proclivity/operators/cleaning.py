"""Cleaning before training."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proclivity.functions.scalar import recode, str_key
from proclivity.operators.validate import missing
from proclivity.spec import TableSpec


def drop_anomaly(df: DataFrame, column: str, marker: Any) -> DataFrame:
    """Remove rows whose code equals the anomaly marker."""
    return df.filter(F.col(column) != F.lit(marker))


def complete(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where none of the columns is missing."""
    out = F.lit(True)
    for c in columns:
        out = out & ~missing(df, c)
    return out


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Remove rows with a missing value (null or NaN) in the columns."""
    return df.filter(complete(df, columns))


def drop_duplicates(df: DataFrame, id_col: str) -> DataFrame:
    """One row per distinct content; the smallest key is kept.

    Equal rows collapse on the map side, so a row copied very often costs
    one row per task in the shuffle.
    """
    content = [c for c in df.columns if c != id_col]
    kept = df.groupBy(*content).agg(F.min(id_col).alias(id_col))
    return kept.select(*df.columns)


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Anomaly filter, complete rows only, duplicates removed."""
    if spec.anomaly is not None:
        df = drop_anomaly(df, *spec.anomaly)
    df = drop_incomplete(df, [*spec.features, spec.target])
    return drop_duplicates(df, spec.id)


def clean_audit(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows left after each cleaning step and rows removed by it.

    All steps are counted in one pass: rows collapse to distinct contents
    with their multiplicity, and the steps are sums over the contents.
    """
    content = [c for c in df.columns if c != spec.id]
    normal = F.lit(True)
    if spec.anomaly is not None:
        column, marker = spec.anomaly
        normal = F.coalesce(F.col(column) != F.lit(marker), F.lit(False))
    whole = normal & complete(df, [*spec.features, spec.target])
    grouped = df.groupBy(*content).agg(F.count(F.lit(1)).alias("__n"))
    zero = F.lit(0)
    counts = grouped.agg(
        F.coalesce(F.sum("__n"), zero).alias("a"),
        F.coalesce(F.sum(F.when(normal, F.col("__n"))), zero).alias("b"),
        F.coalesce(F.sum(F.when(whole, F.col("__n"))), zero).alias("c"),
        F.count_if(whole).alias("d"),
    )
    steps = [
        ("input", "a", "a"),
        ("drop_anomaly", "b", "a"),
        ("drop_incomplete", "c", "b"),
        ("drop_duplicates", "d", "c"),
    ]
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("step_no"),
                        F.lit(step).alias("step"),
                        F.col(now).alias("n_rows"),
                        (F.col(before) - F.col(now)).alias("n_removed"),
                    )
                    for i, (step, now, before) in enumerate(steps)
                ]
            )
        )
    )


def select_features(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, features and target; all other columns are dropped."""
    keep = [spec.id, *spec.features, spec.target]
    return df.select(*[c for c in keep if c in df.columns])


def recode_columns(
    df: DataFrame, mappings: Mapping[str, Mapping[Any, Any]]
) -> DataFrame:
    """Replace values by literal lookups; unknown values become null."""
    return df.withColumns(
        {c: recode(c, dict(m)) for c, m in mappings.items()}
    )


def cast_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn code columns into their text form."""
    return df.withColumns({c: str_key(c) for c in columns})


def valid_for_profile(
    df: DataFrame, allowed: Mapping[str, Sequence[Any]]
) -> DataFrame:
    """Rows with allowed values and nothing missing, for a drift profile."""
    for c, values in allowed.items():
        df = df.filter(F.col(c).isin(list(values)))
    return drop_incomplete(df, df.columns)
