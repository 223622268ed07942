"""Dependence between columns of mixed types.

Spark builds one contingency table per column pair in a single aggregation
and reduces it to chi-square; the phi-K coefficient is then solved per pair
from a few marginal counts (Baak et al., "A new correlation coefficient
between categorical, ordinal and interval variables with Pearson
characteristics", 2020).
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.scalar import equal_width_bin, str_key
from proclivity.functions.tables import settle
from proclivity.session import ship_by_value

#: Cells of the normal distribution that are held at a time.
BLOCK_CELLS = 1_000_000

ship_by_value(__name__)


def binned(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    bins: int = 10,
) -> DataFrame:
    """Category key per column; numeric columns in equal-width bins."""
    ends = df.agg(
        *[
            F.struct(
                F.min(F.col(c).cast("double")).alias("lo"),
                F.max(F.col(c).cast("double")).alias("hi"),
            ).alias(c)
            for c in numeric
        ]
    ).first() if numeric else {}
    keys = []
    for c in numeric:
        low, high = F.lit(ends[c]["lo"]), F.lit(ends[c]["hi"])
        x = F.col(c).cast("double")
        keys.append(
            F.lpad(
                equal_width_bin(x, low, high, bins).cast("string"), 4, "0"
            ).alias(c)
        )
    keys += [str_key(c).alias(c) for c in categorical]
    return df.select(*keys)


def contingency(keys: DataFrame) -> DataFrame:
    """Cell counts of all column pairs: (col_a, col_b, a, b, n).

    Settled when small, so the margins do not scan the rows again.
    """
    pairs = itertools.combinations(keys.columns, 2)
    cells = F.array(
        *[
            F.struct(
                F.lit(p).alias("col_a"),
                F.lit(q).alias("col_b"),
                F.col(p).alias("a"),
                F.col(q).alias("b"),
            )
            for p, q in pairs
        ]
    )
    return settle(
        keys.select(F.inline(cells))
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("col_a", "col_b", "a", "b")
        .agg(F.count(F.lit(1)).alias("n")),
        max_rows=50_000,
    )


def chi_square(cells: DataFrame) -> DataFrame:
    """Pearson chi-square and Cramer's V of every pair.

    Uses sum(n^2 / (row * column)): only existing cells are needed, empty
    ones add nothing. Margins are sums over cells, not over rows; the shares
    of a level's cells add up to one, which counts the levels.
    """
    pair = ["col_a", "col_b"]
    rows = cells.groupBy(*pair, "a").agg(F.sum("n").alias("row_n"))
    cols = cells.groupBy(*pair, "b").agg(F.sum("n").alias("col_n"))
    n = F.col("n").cast("double")
    out = (
        cells.join(rows, [*pair, "a"])
        .join(cols, [*pair, "b"])
        .groupBy(*pair)
        .agg(
            F.sum("n").alias("n_rows"),
            F.round(F.sum(n / F.col("row_n"))).cast("long").alias("levels_a"),
            F.round(F.sum(n / F.col("col_n"))).cast("long").alias("levels_b"),
            F.count(F.lit(1)).alias("n_cells"),
            F.sum(n * n / (F.col("row_n") * F.col("col_n"))).alias("ratio"),
        )
    )
    chi2 = F.greatest(F.col("n_rows") * (F.col("ratio") - 1), F.lit(0.0))
    smaller = F.least("levels_a", "levels_b") - 1
    return out.select(
        *pair,
        "n_rows",
        "levels_a",
        "levels_b",
        "n_cells",
        chi2.alias("chi2"),
        F.when(
            smaller > 0, F.sqrt(chi2 / (F.col("n_rows") * smaller))
        ).alias("cramers_v"),
    )


def phik_matrix(keys: DataFrame) -> DataFrame:
    """Phi-K of every pair (noise pedestal subtracted), as a long table.

    Pairs are solved in parallel tasks from their marginal counts, whatever
    the number of levels; the work grows with the product of both numbers.
    """
    kept = contingency(keys)
    pair = ["col_a", "col_b"]
    stats = settle(chi_square(kept))
    margins = []
    for side in ("a", "b"):
        one = kept.groupBy(*pair, side).agg(F.sum("n").alias("m"))
        margins.append(
            one.groupBy(*pair).agg(
                F.transform(
                    F.sort_array(
                        F.collect_list(F.struct(F.col(side).alias("k"), "m"))
                    ),
                    lambda s: s["m"],
                ).alias(f"margin_{side}")
            )
        )
    solved = stats.join(margins[0], pair, "left").join(
        margins[1], pair, "left"
    )
    schema = (
        "col_a string, col_b string, chi2 double, cramers_v double, "
        "phik double"
    )
    return solved.mapInPandas(_solve_batches, schema)


def _solve_batches(batches):
    for pdf in batches:
        phik = [
            None
            if row.margin_a is None or row.margin_b is None
            else solve_phik(
                row.chi2,
                np.asarray(row.margin_a, float),
                np.asarray(row.margin_b, float),
                int(row.n_cells),
            )
            for row in pdf.itertuples()
        ]
        out = pdf[["col_a", "col_b", "chi2", "cramers_v"]].copy()
        out["phik"] = phik
        yield out


def solve_phik(
    chi2: float, margin_a: np.ndarray, margin_b: np.ndarray, n_cells: int
) -> float:
    """Correlation of the binned normal distribution with this chi-square."""
    levels_a, levels_b = len(margin_a), len(margin_b)
    if min(levels_a, levels_b) < 2:
        return 0.0
    n = margin_a.sum()
    empty = levels_a * levels_b - n_cells
    freedom = (levels_a - 1) * (levels_b - 1) - empty
    pedestal = max(freedom, 0) + 1.5 * np.sqrt(2 * max(freedom, 0))
    largest = n * min(levels_a - 1, levels_b - 1)
    if chi2 <= pedestal:
        return 0.0
    if chi2 >= largest:
        return 1.0
    scale = (largest - pedestal) / max(
        _normal_chi2(1.0, margin_a, margin_b), 1e-300
    )

    def gap(rho: float) -> float:
        return pedestal + scale * _normal_chi2(rho, margin_a, margin_b) - chi2

    # false position; the end that stays twice counts half (Illinois)
    (lo, low), (hi, high) = (0.0, pedestal - chi2), (1.0, largest - chi2)
    side = 0
    for _ in range(60):
        mid = (lo * high - hi * low) / (high - low)
        value = gap(mid)
        if value < 0:
            lo, low = mid, value
            high = high / 2 if side < 0 else high
            side = -1
        else:
            hi, high = mid, value
            low = low / 2 if side > 0 else low
            side = 1
        if hi - lo < 1e-12 or abs(value) <= 1e-12 * chi2:
            break
    return float(mid)


def _edges(margin: np.ndarray) -> np.ndarray:
    share = np.cumsum(margin)[:-1] / margin.sum()
    return np.array([NormalDist().inv_cdf(float(s)) for s in share])


def _normal_chi2(
    rho: float, margin_a: np.ndarray, margin_b: np.ndarray
) -> float:
    """Chi-square of a bivariate normal cut at the margins' quantiles."""
    n = margin_a.sum()
    pa, pb = margin_a / n, margin_b / n
    # cumulative shares with both ends; levels of a are taken in blocks
    ca, cb = (np.concatenate([[0.0], np.cumsum(p)]) for p in (pa, pb))
    ca[-1] = cb[-1] = 1.0
    ha = np.concatenate([[-np.inf], _edges(margin_a), [np.inf]])
    inner = _edges(margin_b)[None, :]
    step = max(1, BLOCK_CELLS // len(pb))
    total = 0.0
    for at in range(0, len(pa), step):
        end = min(at + step, len(pa))
        joint = _joint(rho, ca[at : end + 1], cb, ha[at : end + 1], inner)
        cell = np.diff(np.diff(joint, axis=0), axis=1)
        expected = np.outer(pa[at:end], pb)
        total += float((((cell - expected) ** 2) / expected).sum())
    return n * total


def _joint(
    rho: float, ca: np.ndarray, cb: np.ndarray, ha: np.ndarray, k: np.ndarray
) -> np.ndarray:
    """Chance of both below their cuts, for a block of the first's cuts."""
    if rho >= 1.0:
        return np.minimum.outer(ca, cb)
    joint = np.outer(ca, cb)
    here = np.isfinite(ha)
    h = ha[here][:, None]
    # Plackett: d Phi2 / d r is the normal density at correlation r;
    # r = sin(t) removes the square root in the denominator
    nodes, weights = np.polynomial.legendre.leggauss(48)
    top = np.arcsin(rho)
    added = np.zeros((len(h), k.shape[1]))
    for node, weight in zip(nodes, weights, strict=True):
        t = (node + 1) / 2 * top
        added += weight * np.exp(
            -(h * h - 2 * h * k * np.sin(t) + k * k) / (2 * np.cos(t) ** 2)
        )
    joint[here, 1:-1] += added * top / 2 / (2 * np.pi)
    return joint
