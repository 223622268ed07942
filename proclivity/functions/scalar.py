"""Scalar column functions: all built-in expressions, no Python per row."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN_KEY = "nan"
MIN_SHARE = 1e-4


def col(c: Column | str) -> Column:
    """Accept a column or its name."""
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: Column | str, floating: bool = False) -> Column:
    """Null, or NaN where the column is a floating point number."""
    c = col(c)
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def str_key(c: Column | str) -> Column:
    """Category key: the text form; a missing value has its own key."""
    return F.coalesce(col(c).cast("string"), F.lit(NAN_KEY))


def age_band(
    c: Column | str, edges: Sequence[float], labels: Sequence[str]
) -> Column:
    """Right-closed bands: `edges[i] < x <= edges[i + 1]` is `labels[i]`.

    Values outside all bands (and missing values) get the missing key.
    """
    c = col(c)
    out = F.when(c <= edges[0], F.lit(NAN_KEY))
    for upper, label in zip(edges[1:], labels, strict=True):
        out = out.when(c <= upper, F.lit(label))
    return out.otherwise(F.lit(NAN_KEY))


def clip(
    c: Column | str, low: float | None = None, high: float | None = None
) -> Column:
    """Limit values to [low, high]; a missing value stays missing."""
    out = c = col(c)
    if low is not None:
        out = F.when(c < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(c > high, F.lit(high)).otherwise(out)
    return out


def log_ratio(
    actual: Column | str, expected: Column | str, floor: float = MIN_SHARE
) -> Column:
    """`(a - e) * ln(a / e)` with both shares raised to at least `floor`."""
    a = F.greatest(col(actual), F.lit(floor))
    e = F.greatest(col(expected), F.lit(floor))
    return (a - e) * F.ln(a / e)


def round4(c: Column | str) -> Column:
    """Four decimals, half to even, as gates and reports compare them."""
    return F.bround(col(c), 4)


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division where nothing divided by nothing is 0."""
    num, den = col(num), col(den)
    return F.when(den == 0, F.lit(0.0)).otherwise(
        num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    )


def prefix_match(c: Column | str, prefixes: Sequence[str]) -> Column:
    """True where the text starts with any of the prefixes."""
    c = col(c)
    out = F.lit(False)
    for prefix in prefixes:
        out = out | c.startswith(prefix)
    return out


def threshold_decision(score: Column | str, threshold: Any) -> Column:
    """1 where `score >= threshold` (inclusive), else 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (col(score) >= t).cast("int")


def recode(c: Column | str, mapping: dict[Any, Any]) -> Column:
    """Literal lookup; values not in the mapping become null."""
    c = col(c)
    out = None
    for key, value in mapping.items():
        hit = c == F.lit(key)
        out = F.when(hit, F.lit(value)) if out is None else out.when(
            hit, F.lit(value)
        )
    return out


def literal(value: Any) -> str:
    """SQL text of a Python value."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"double('{value!r}')"
    if isinstance(value, int):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def name(column: str) -> str:
    """Quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def comparison_tree(x: str, cuts: Sequence[Any], op: str) -> str:
    """SQL of the position of `x` among sorted cuts, by halving.

    `x op cut` decides for the lower half. The tree stays inside generated
    code and needs only log2(cuts) comparisons per row.
    """

    def build(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return (
            f"CASE WHEN {x} {op} {literal(cuts[mid])} "
            f"THEN {build(lo, mid)} ELSE {build(mid + 1, hi)} END"
        )

    return build(0, len(cuts))


#: Up to so many cuts are a tree of comparisons; a larger tree would be too
#: long a method to compile.
TREE_CUTS = 31


def step_index(column: str, cuts: Sequence[float]) -> Column:
    """Number of cut points `<= x`.

    A missing value fails every comparison and therefore lands in the last
    bin. Many cuts are searched in two steps, first among every k-th of them
    and then among the k that follow, with k about the root of their number.
    """
    x = f"cast({name(column)} AS DOUBLE)"
    cuts = [float(c) for c in cuts]
    if len(cuts) <= TREE_CUTS:
        return F.expr(comparison_tree(x, cuts, "<"))
    k = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + k] for i in range(0, len(cuts), k)]

    def listed(values: Sequence[float]) -> str:
        return f"array({', '.join(literal(v) for v in values)})"

    def below(values: str) -> str:
        return f"size(filter({values}, c -> c <= {x}))"

    # starts of groups that are not above x; 0 if x is below all cuts
    group = below(listed([g[0] for g in groups]))
    inside = below(
        f"element_at(array({', '.join(map(listed, groups))}), {group})"
    )
    return F.expr(
        f"CASE WHEN {x} IS NULL THEN {len(cuts)} "
        f"WHEN {x} < {literal(cuts[0])} THEN 0 "
        f"ELSE ({group} - 1) * {k} + {inside} END"
    )


def equal_width_bin(
    c: Column | str, low: Column, high: Column, bins: int
) -> Column:
    """Equal-width bin 0..bins-1; the last bin includes its upper edge."""
    c = col(c)
    pos = F.floor((c - low) * bins / F.nullif(high - low, F.lit(0.0)))
    return (
        F.when(c.isNull(), F.lit(None))
        .otherwise(F.least(F.coalesce(pos, F.lit(0)), F.lit(bins - 1)))
        .cast("int")
    )


def hash_key(id_col: Column | str, seed: int = 42) -> Column:
    """Reproducible random order key of a row, spread evenly over hex digits."""
    return F.md5(
        F.concat(col(id_col).cast("string"), F.lit(f":{seed}")).cast("binary")
    )


def format_detail(template: str, *cols: Column | str) -> Column:
    """Text with fixed decimals and signs, e.g. `largest drop %+.4f`."""
    return F.format_string(template, *[col(c) for c in cols])
