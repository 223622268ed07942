"""Session helpers."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def ship_by_value(module: str) -> None:
    """Send a module's task functions with the job.

    Executors then need no copy of this package, only numpy and pandas.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def local_session(cpus: str | int = "*", app: str = "proclivity") -> SparkSession:
    """Build a local session for tests and the bench; a cluster has its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: the cluster's checkpoint directory.

    Only where the session names none and runs in one process (tests) a
    temporary folder is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        # set by the caller on the context, or by this function before
        folder = spark.sparkContext.getCheckpointDir()
    if folder is not None:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    folder = tempfile.mkdtemp(prefix="proclivity-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage of a table that is read many times: lost executors lose
    nothing, later passes read only the columns they need, and no executor
    memory is held. The folder lives as long as the cluster keeps its
    checkpoints.
    """
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
