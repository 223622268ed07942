"""Reading customer tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingInput(FileNotFoundError):
    """The input path does not exist."""


def read_typed(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """Read with declared types; the header gives the column names.

    The schema is never inferred, so reading starts no extra job, and only
    `columns` are parsed.
    """
    try:
        reader = spark.read.schema(schema)
        if fmt == "csv":
            # columns are matched by name below, not by position
            df = reader.option("header", True).option(
                "enforceSchema", False
            ).csv(path)
        else:
            df = reader.format(fmt).load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(
                f"{path} not found; pass the path of an existing table"
            ) from err
        raise
    return df.select(*columns) if columns else df


def read_window(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """Read a list of batches; `batch_no` is 1, 2, ... and the last is new."""
    out = None
    for number, path in enumerate(paths, start=1):
        if schema is not None:
            part = read_typed(spark, path, schema, fmt=fmt)
        else:
            part = read_any(spark, path, fmt)
        part = part.withColumn("batch_no", F.lit(number))
        out = part if out is None else out.unionByName(
            part, allowMissingColumns=False
        )
    return out


def read_any(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a batch whose types are found by Spark (CSV) or stored (others)."""
    try:
        if fmt == "csv":
            return spark.read.csv(path, header=True, inferSchema=True)
        return spark.read.format(fmt).load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(f"{path} not found") from err
        raise


def head_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """First n rows in the order of a key (a table has no order of its own)."""
    return df.orderBy(order).limit(n)


def with_optional_key(df: DataFrame, id_col: str) -> tuple[DataFrame, bool]:
    """Tell whether the key column is there; scoring works without it."""
    return df, id_col in df.columns


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Size and SHA-256 of every file under a path.

    Spark's binary reader gives one row per file; use it on split files, a
    single file is held by one task while it is hashed.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def table_manifest(df: DataFrame) -> DataFrame:
    """Row count and a hash of all rows that does not depend on their order."""
    row_hash = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(row_hash).cast("string").alias("rows_hash"),
    )


def merge_params(
    defaults: Mapping[str, Any], override: Mapping[str, Any] | None
) -> dict[str, Any]:
    """Defaults with the user's values on top."""
    return {**defaults, **(override or {})}


def check_override(
    override: Mapping[str, Any] | None, model_names: Sequence[str]
) -> None:
    """An override fits one model's parameters, never several models."""
    if override and len(model_names) != 1:
        raise ValueError("parameter override needs exactly one model")
