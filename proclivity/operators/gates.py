"""Gates that a new model passes before it may replace the one in use.

Every gate compares one number with one limit, so a gate is that pair and a
sentence made from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.scalar import prefix_match
from proclivity.operators.lookups import slice_delta
from proclivity.operators.ranking import top_k
from proclivity.operators.validate import Gate, GateLimits

Metrics = Mapping[str, Any]

#: Gate, metric, and the limit of what the metric may lose.
LOSSES = (
    ("vs_champion_auc", "roc_auc", "max_auc_drop"),
    ("vs_champion_f1", "f1", "max_f1_drop"),
)


def floor_gate(new: Metrics, limits: GateLimits) -> Gate:
    """The area under the curve reaches the floor."""
    value, floor = new["roc_auc"], limits.min_auc
    return Gate(
        "min_auc", value >= floor, f"roc_auc is {value:.4f}, floor {floor:g}"
    )


def _loss(name: str, what: str, loss: float, limit: float) -> Gate:
    return Gate(
        name, loss <= limit, f"{what} loses {loss:.4f}, may lose {limit:g}"
    )


def loss_gate(
    name: str, new: Metrics, old: Metrics, limits: GateLimits
) -> Gate:
    """One of LOSSES: the metric loses no more than its limit."""
    metric, limit = next(x[1:] for x in LOSSES if x[0] == name)
    return _loss(
        name, metric, old[metric] - new[metric], getattr(limits, limit)
    )


def slices_gate(old: DataFrame, new: DataFrame, limits: GateLimits) -> Gate:
    """The slice that loses most loses no more than its limit."""
    where = F.concat_ws("=", "slice_col", "slice_value")
    # of equal losses the first slice in text order
    worst = (
        slice_delta(old, new)
        .select("drop", where.alias("slice"))
        .agg(F.min(F.struct((-F.col("drop")).alias("change"), "slice")))
        .first()[0]
    )
    if worst is None:
        return Gate("slices", True, "no slice in common")
    return _loss(
        "slices", worst["slice"], -worst["change"], limits.max_slice_auc_drop
    )


def top_features_gate(importance: DataFrame, expected: Sequence[str]) -> Gate:
    """The first features are all among the expected ones."""
    leading = top_k(importance, "importance", "feature", len(expected))
    row = leading.agg(
        F.count_if(~prefix_match("feature", expected)).alias("others"),
        F.array_join(F.sort_array(F.collect_list("feature")), ", ").alias(
            "names"
        ),
    ).first()  # as many rows as there are expected names
    return Gate("top_features", row["others"] == 0, f"led by {row['names']}")


def reload_gate(before: DataFrame, after: DataFrame, id_col: str) -> Gate:
    """A stored and reloaded model scores the control rows alike."""
    pairs = before.select(id_col, F.col("probability").alias("a")).join(
        after.select(id_col, F.col("probability").alias("b")), id_col
    )
    apart = F.abs(F.col("a") - F.col("b")) > 1e-8 + 1e-5 * F.abs("b")
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(apart, F.lit(True))).alias("apart"),
    ).first()
    return Gate(
        "load_test",
        row["n"] > 0 and row["apart"] == 0,
        f"{row['apart']} of {row['n']} control rows differ after reloading",
    )


def quality_gates(
    new: Metrics,
    new_slices: DataFrame,
    limits: GateLimits,
    old: Metrics | None = None,
    old_slices: DataFrame | None = None,
    importance: DataFrame | None = None,
) -> list[Gate]:
    """All gates that apply; without a model in use there is no loss."""
    out = [floor_gate(new, limits)]
    if old is not None:
        out += [loss_gate(name, new, old, limits) for name, *_ in LOSSES]
        out.append(slices_gate(old_slices, new_slices, limits))
    if importance is not None and limits.expected_top_features:
        out.append(top_features_gate(importance, limits.expected_top_features))
    return out
