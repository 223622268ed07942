"""Sorted reports and top-k lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.exact import (
    bucket_count,
    rank_cuts,
    running_before,
    score_runs,
)
from proclivity.functions.scalar import hash_key
from proclivity.functions.tables import local_table


def top_k(df: DataFrame, value: str, name: str, k: int) -> DataFrame:
    """The k largest values, ties by name."""
    return df.orderBy(F.col(value).desc(), F.col(name)).limit(k)


def largest(df: DataFrame, value: str, name: str) -> DataFrame:
    """Name and value of the largest value; the first name wins a tie."""
    order = F.struct((-F.col(value)).alias("m"), F.col(name))
    return df.agg(
        F.min_by(name, order).alias(name), F.max(value).alias(value)
    )


def rank_trials(
    trials: DataFrame, score: str, out: str = "rank"
) -> DataFrame:
    """Rank parameter sets by score (a search has at most some hundreds)."""
    return trials.withColumn(
        out, F.rank().over(Window.orderBy(F.col(score).desc()))
    ).orderBy(out)


class TopShares:
    """Exact cut-offs of the top shares of a scored table.

    Order: score descending, ties in hashed key order. The cut-off of a share
    is a score and, inside that score, a key. Both are found without sorting
    rows: scores collapse to distinct values first, and only ties at a cut-off
    are looked at by key.
    """

    def __init__(
        self,
        df: DataFrame,
        id_col: str,
        score: str,
        shares: Sequence[float],
        seed: int = 42,
    ) -> None:
        """Find the cut-off of every share."""
        self.score = score
        self.key = hash_key(id_col, seed)
        buckets, self.n_rows = bucket_count(df, score)
        self.sizes = {s: round(s * self.n_rows) for s in shares}
        self._cut: dict[float, tuple[float, str | None]] = {}
        self._find(df, buckets)

    def _find(self, df: DataFrame, buckets: int) -> None:
        spark = df.sparkSession
        runs = score_runs(
            df, self.score, {"n": F.lit(1)}, buckets=buckets
        )
        placed = running_before(runs, self.score, ["n"])
        inside = F.lit(False)
        for size in set(self.sizes.values()):
            inside = inside | (
                (F.col("n_before") < size)
                & (F.col("n_before") + F.col("n") >= size)
            )
        # one score per wanted share
        edges = placed.filter(inside).collect()
        ties = []
        for share, size in self.sizes.items():
            for e in edges:
                if e["n_before"] < size <= e["n_before"] + e["n"]:
                    left = size - e["n_before"]
                    if left == e["n"]:
                        self._cut[share] = (e[self.score], None)
                    else:
                        ties.append((share, e[self.score], left))
        if ties:
            ranks = local_table(
                spark,
                [(s, i, left) for i, (_, s, left) in enumerate(ties)],
                f"{self.score} double, __cut int, __rank long",
            )
            widest = max(e["n"] for e in edges)
            at_edge = df.filter(
                F.col(self.score).isin([s for _, s, _ in ties])
            )
            keys = rank_cuts(
                at_edge, self.key, [self.score], ranks, widest
            )
            for row in keys.collect():
                share, score, _ = ties[row["__cut"]]
                self._cut[share] = (score, row["__key"])

    def inside(self, share: float):
        """Column: the row belongs to the top share."""
        if share not in self._cut:
            return F.lit(False)
        score, key = self._cut[share]
        x = F.col(self.score)
        if key is None:
            return x >= F.lit(score)
        return (x > F.lit(score)) | (
            (x == F.lit(score)) & (self.key <= F.lit(key))
        )


def call_list(
    scored: DataFrame,
    id_col: str,
    score: str,
    threshold: float | None = None,
    share: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """Customers by falling score: above a threshold or an exact top share."""
    if (threshold is None) == (share is None):
        raise ValueError("give either a threshold or a share")
    if threshold is not None:
        picked = scored.filter(F.col(score) >= threshold)
    else:
        tops = TopShares(scored, id_col, score, [share], seed)
        picked = scored.filter(tops.inside(share))
    return picked.select(id_col, score).orderBy(F.col(score).desc(), id_col)
