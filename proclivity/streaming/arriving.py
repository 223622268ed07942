"""Scoring and drift of arriving files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proclivity.functions.scalar import threshold_decision
from proclivity.models.bundle import ModelBundle
from proclivity.operators.drift import KEYS, bin_counts, psi
from proclivity.operators.lookups import outer_shares
from proclivity.operators.validate import reject_reason


def read_arriving(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Stream of the files that appear in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def score_stream(arriving: DataFrame, bundle: ModelBundle) -> DataFrame:
    """Probability and decision per arriving row; no state."""
    keep = [bundle.spec.id] if bundle.spec.id in arriving.columns else []
    scored = bundle.probability(arriving, keep)
    return scored.withColumn(
        "prediction", threshold_decision("probability", bundle.threshold)
    )


def run_checked_scores(
    arriving: DataFrame, bundle: ModelBundle, out: str, checkpoint: str
) -> None:
    """Score what has arrived; rows that break a rule go to a sink of theirs.

    Each micro-batch writes `out/scores/batch=<n>` (key, probability,
    prediction) and `out/rejects/batch=<n>` (the row and its reason). Both are
    overwritten whole, so a batch that is repeated after a failure, even one
    between the two writes, leaves each row once. A bad row never ends the
    query.
    """
    spec = bundle.spec
    keep = [spec.id] if spec.id in arriving.columns else []

    def save(batch: DataFrame, number: int) -> None:
        # two sinks, one reading of what arrived
        marked = batch.withColumn(
            "reason", reject_reason(batch, spec)
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            marked.where("reason IS NOT NULL").write.mode(
                "overwrite"
            ).parquet(f"{out}/rejects/batch={number}")
            good = marked.where("reason IS NULL").drop("reason")
            bundle.probability(good, keep).withColumn(
                "prediction",
                threshold_decision("probability", bundle.threshold),
            ).write.mode("overwrite").parquet(f"{out}/scores/batch={number}")
        finally:
            marked.unpersist()

    query = (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(save)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def write_available(
    stream: DataFrame, out: str, checkpoint: str, mode: str = "append"
) -> None:
    """Write everything that has arrived to a parquet folder, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def window_bins(
    arriving: DataFrame,
    time: str,
    window: str,
    lateness: str,
    cuts: Mapping[str, Sequence[float]],
    categorical: Sequence[str],
) -> DataFrame:
    """Rows per bin and category in tumbling windows.

    State is one counter per (window, feature, bin) and is dropped once the
    watermark has passed the window.
    """
    timed = arriving.withWatermark(time, lateness).withColumn(
        "window", F.window(time, window)
    )
    return bin_counts(timed, cuts, categorical, ["window"])


def run_window_bins(bins: DataFrame, out: str, checkpoint: str) -> None:
    """Write every changed counter, tagged with its micro-batch."""

    def save(batch: DataFrame, number: int) -> None:
        # overwriting the folder of a batch makes a repeated batch harmless
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        bins.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_bins(spark: SparkSession, out: str) -> DataFrame:
    """Last written value of every counter."""
    written = spark.read.parquet(out)
    return written.groupBy(
        F.col("window.start").alias("window_start"), *KEYS
    ).agg(F.max_by("n", "batch").alias("n"))


def window_psi(bins: DataFrame, profile: DataFrame) -> DataFrame:
    """PSI per window and feature from counters and a stored profile."""
    totals = bins.groupBy("window_start", "feature").agg(
        F.sum("n").alias("total")
    )
    actual = bins.join(totals, ["window_start", "feature"]).select(
        "window_start", *KEYS, (F.col("n") / F.col("total")).alias("share")
    )
    # every window needs every profile cell: windows per feature are few
    expected = totals.select("window_start", "feature").join(
        profile.select(*KEYS, "share"), "feature"
    )
    joined = outer_shares(expected, actual, ["window_start", *KEYS])
    return psi(joined, ["window_start", "feature"])
