"""Writing results: every sink is a distributed write of a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_predictions(
    scored: DataFrame, path: str, fmt: str = "csv", id_col: str | None = None
) -> None:
    """Write key, probability and prediction."""
    keep = [c for c in (id_col,) if c] + ["probability", "prediction"]
    writer = scored.select(*keep).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write metric rows as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def write_importance(importance: DataFrame, path: str) -> None:
    """Write the importance table as CSV with a header."""
    importance.write.mode("overwrite").option("header", True).csv(path)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating point column."""
    return df.select(
        *[
            F.bround(c, digits).alias(c)
            if t in ("double", "float")
            else F.col(c)
            for c, t in df.dtypes
        ]
    )


def write_comparison(table: DataFrame, path: str) -> None:
    """Write the model comparison as CSV, rounded to four decimals."""
    rounded(table).write.mode("overwrite").option("header", True).csv(path)
