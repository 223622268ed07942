"""All queries, by importing the modules that register them."""

from __future__ import annotations

from proclivity.plans import (
    data_queries,  # noqa: F401
    fit_queries,  # noqa: F401
    flagship,  # noqa: F401
    model_queries,  # noqa: F401
    profile_queries,  # noqa: F401
)
from proclivity.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
