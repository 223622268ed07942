"""Model registry in a shared folder: events, profiles, reports, models."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity.functions.tables import local_table
from proclivity.models.bundle import ModelBundle
from proclivity.operators import registry as events_of
from proclivity.operators.drift import PROFILE_SCHEMA, store_profile
from proclivity.spec import TableSpec

EVENTS = "version string, seq long, status string, at string, meta string"
NOTES = "at string, level string, message string"
REPORTS = "cycle int, status string, report string"


def now() -> str:
    """Current UTC time in ISO format."""
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


class ModelRegistry:
    """Append-only tables under one folder; the state is always derived."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        """Open (or start) a registry in `root`."""
        self.spark = spark
        self.root = root.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not self._exists(path):
            return local_table(self.spark, [], schema)
        return self.spark.read.schema(schema).json(path)

    def _exists(self, path: str) -> bool:
        # Hadoop's file system API, so any storage the session knows works
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsc.hadoopConfiguration()
        return place.getFileSystem(conf).exists(place)

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").json(f"{self.root}/{name}")

    # --- versions ---

    def events(self) -> DataFrame:
        """All status events."""
        return self._table("events", EVENTS)

    def versions(self) -> DataFrame:
        """Current status of every version."""
        return events_of.current_versions(self.events())

    def production_version(self) -> str | None:
        """The version in production, if any."""
        row = events_of.production_version(self.events()).first()
        return row["version"] if row else None

    def status(self, version: str) -> str:
        """Current status of a version."""
        row = self.versions().filter(F.col("version") == version).first()
        if row is None:
            raise KeyError(version)
        return row["status"]

    def meta(self, version: str) -> dict[str, Any]:
        """Metadata stored when the version was registered."""
        row = (
            self.events()
            .filter((F.col("version") == version) & F.col("meta").isNotNull())
            .first()
        )
        if row is None:
            raise KeyError(version)
        return json.loads(row["meta"])

    def profile(self, version: str) -> DataFrame:
        """Drift profile of a version's training window."""
        stored = self._table("profiles", f"version string, {PROFILE_SCHEMA}")
        return stored.filter(F.col("version") == version).drop("version")

    def model_path(self, version: str) -> str:
        """Folder of a version's model."""
        return f"{self.root}/models/{version}"

    def load(self, version: str, spec: TableSpec) -> ModelBundle:
        """Load a version's model."""
        return ModelBundle.load(self.spark, self.model_path(version), spec)

    def _append_events(self, rows: DataFrame, meta: str | None) -> None:
        self._append(
            "events",
            rows.select(
                "version",
                "seq",
                "status",
                F.lit(now()).alias("at"),
                F.lit(meta).cast("string").alias("meta"),
            ),
        )

    def next_version(self) -> str:
        """Number of the version that is registered next."""
        return events_of.register(self.events(), "").first()["version"]

    def register(
        self,
        bundle: ModelBundle,
        status: str,
        meta: dict[str, Any],
        profile: DataFrame,
        saved: bool = False,
    ) -> str:
        """Record a model as the next version.

        `saved` tells that the model already lies in that version's folder.
        """
        rows = events_of.register(self.events(), status)
        version = rows.first()["version"]
        if not saved:
            bundle.save(self.model_path(version))
        self._append("profiles", store_profile(profile, version))
        self._append_events(rows, json.dumps(meta))
        return version

    def promote(self, version: str) -> str | None:
        """Put a version into production; the previous one is archived."""
        previous = self.production_version()
        chosen = self._versions_table(version)
        self._append_events(
            events_of.promote(self.events(), chosen), None
        )
        return previous

    def rollback(self, failed: str, previous: str | None) -> None:
        """Mark a version as rolled back and restore the previous one."""
        self._append_events(
            events_of.rollback(
                self.events(),
                self._versions_table(failed),
                self._versions_table(previous),
            ),
            None,
        )

    def _versions_table(self, version: str | None) -> DataFrame:
        rows = [] if version is None else [(version,)]
        return local_table(self.spark, rows, "version string")

    # --- logs ---

    def notify(self, level: str, message: str) -> None:
        """Append a notification for the people on duty."""
        row = [(now(), level, message)]
        self._append("notifications", local_table(self.spark, row, NOTES))

    def notifications(self) -> DataFrame:
        """The notification log."""
        return self._table("notifications", NOTES)

    def reports(self) -> DataFrame:
        """All cycle reports."""
        return self._table("cycles", REPORTS)

    def next_cycle(self) -> int:
        """Number of the next cycle."""
        return self.reports().count() + 1

    def save_report(self, report: dict[str, Any]) -> None:
        """Append a cycle report."""
        row = [(report["cycle"], report["status"], json.dumps(report))]
        self._append("cycles", local_table(self.spark, row, REPORTS))
