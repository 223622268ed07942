"""Model versions as an append-only event table.

Columns: the registry key columns (`by`, may be empty), `version`, `seq`,
`status`. The state of a version is its latest event; nothing is updated in
place, so concurrent readers and lost tasks cannot see half a change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANDIDATE = "candidate"
PRODUCTION = "production"
ARCHIVED = "archived"
REJECTED = "rejected"
ROLLED_BACK = "rolled_back"


def current_versions(
    events: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Latest status of every version."""
    return events.groupBy(*by, "version").agg(
        F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq")
    )


def production_version(
    events: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """The version in production (the last one promoted)."""
    live = current_versions(events, by).filter(
        F.col("status") == PRODUCTION
    )
    return live.groupBy(*by).agg(
        F.max_by("version", "seq").alias("version")
    )


def register(
    events: DataFrame, status: str, by: Sequence[str] = ()
) -> DataFrame:
    """Event of a new version `v{n + 1}`."""
    return events.groupBy(*by).agg(
        F.concat(
            F.lit("v"),
            (F.count_distinct("version") + 1).cast("string"),
        ).alias("version"),
        (F.coalesce(F.max("seq"), F.lit(0)) + 1).alias("seq"),
        F.lit(status).alias("status"),
    )


def _last_seq(events: DataFrame, by: Sequence[str]) -> DataFrame:
    return events.groupBy(*by).agg(F.max("seq").alias("last"))


def promote(
    events: DataFrame, chosen: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Events that archive the production version and promote the chosen.

    `chosen` has the key columns and `version`.
    """
    previous = production_version(events, by)
    return _two_events(
        events, previous, ARCHIVED, chosen, PRODUCTION, by
    )


def rollback(
    events: DataFrame,
    failed: DataFrame,
    previous: DataFrame,
    by: Sequence[str] = (),
) -> DataFrame:
    """Events that mark a failed version and restore the previous one."""
    return _two_events(
        events, failed, ROLLED_BACK, previous, PRODUCTION, by
    )


def _two_events(events, first, first_status, second, second_status, by):
    by = list(by)
    pair = first.select(
        *by, "version", F.lit(first_status).alias("status"),
        F.lit(1).alias("__step"),
    ).unionByName(
        second.select(
            *by, "version", F.lit(second_status).alias("status"),
            F.lit(2).alias("__step"),
        )
    )
    if by:
        pair = pair.join(_last_seq(events, by), by)
        last = F.col("last")
    else:
        last = _last_seq(events, by).scalar()
    return pair.select(
        *by, "version", (last + F.col("__step")).alias("seq"), "status"
    )


def cycle_status(
    data_ok: Column, quality_ok: Column, approved_by: Column, deploy_ok: Column
) -> Column:
    """Outcome of a cycle from its gates, approval and deploy check."""
    return (
        F.when(~data_ok, "rejected_data")
        .when(~quality_ok, "rejected_quality")
        .when(approved_by.isNull(), "not_approved")
        .when(~deploy_ok, ROLLED_BACK)
        .otherwise("deployed")
    )
