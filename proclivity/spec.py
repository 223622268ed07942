"""Description of a table: which column plays which role."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class TableSpec:
    """Column roles of one customer table.

    Every operator takes its columns as parameters; a spec only bundles them
    so that whole plans (training, scoring, a retraining cycle) can be run on
    any table.
    """

    id: str
    target: str
    high_card: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    ordinal: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    robust: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    allowed: Mapping[str, tuple[Any, ...]] = field(default_factory=dict)
    anomaly: tuple[str, Any] | None = None
    profile_numeric: tuple[str, ...] = ()
    profile_categorical: tuple[str, ...] = ()
    slice_columns: tuple[str, ...] = ()
    # column -> (edges, labels): right-closed bands used as a slice
    slice_bands: Mapping[str, tuple[tuple[float, ...], tuple[str, ...]]] = (
        field(default_factory=dict)
    )

    @property
    def features(self) -> list[str]:
        """All feature columns, in a fixed order."""
        return [
            *self.high_card,
            *self.binary,
            *self.ordinal,
            *self.robust,
            *self.numeric,
        ]

    @property
    def must_be_numeric(self) -> list[str]:
        """Columns that must be numeric and not negative."""
        return [*self.robust, *self.numeric, *self.high_card]
