"""Exact ranks, quantiles and prefix sums without one big sorted partition.

Three building blocks carry every operator that depends on order:

* `rank_cuts` / `rank_part` - the key at given ranks of a hashed order. One
  histogram over the leading hex digits finds the digit groups that hold the
  ranks; only those groups are sorted. The rows themselves never move.
* `exact_quantiles` - order statistics of numeric columns. A mergeable sketch
  brackets each rank, a counting pass places the bracket, and only the values
  inside the bracket are sorted.
* `score_runs` - running totals along a score. Rows collapse to one row per
  distinct score (map-side combine), scores are cut in order-preserving
  buckets, windows run inside a bucket, bucket totals give the offsets.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from proclivity.functions.scalar import (
    comparison_tree,
    hash_key,
    literal,
    name,
    step_index,
)
from proclivity.functions.tables import join_null_safe, local_table, settle
from proclivity.session import staged

HEX_DIGITS = 4
LITERAL_STRATA = 64
SORT_ROWS = 1_000_000
PLAIN_ROWS = 50_000
SKETCH_ACCURACY = 10_000


# --- ranks in hashed order -------------------------------------------------


def stratum_counts(
    df: DataFrame, strata: Sequence[str]
) -> tuple[DataFrame, int | None]:
    """Rows per stratum as `__n`, and the largest stratum if it is known."""
    counts = settle(df.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n")))
    if counts.isLocal():
        return counts, max((r["__n"] for r in counts.collect()), default=0)
    return counts, None


def rank_cuts(
    df: DataFrame,
    key: Column,
    strata: Sequence[str],
    ranks: DataFrame,
    largest: int | None = None,
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Key of the row at each wanted rank.

    `ranks` has the strata columns, `__cut` and `__rank` (1-based rank inside
    the stratum in ascending key order). Result: strata, `__cut`, `__key`.
    The histogram has at most 16**hex_digits rows per stratum, and a digit
    group holds about 1 / 16**hex_digits of the rows, because keys are hashes.
    Where the largest stratum is known to be small it is sorted directly.
    """
    strata = list(strata)
    if largest is not None and largest <= SORT_ROWS:
        whole = Window.partitionBy(*strata).orderBy("__key")
        placed = df.select(*strata, key.alias("__key")).withColumn(
            "__rank", F.row_number().over(whole).cast("long")
        )
        return join_null_safe(placed, ranks, [*strata, "__rank"]).select(
            *strata, "__cut", "__key"
        )
    keyed = df.select(
        *strata, key.alias("__key")
    ).withColumn("__digits", F.substring("__key", 1, hex_digits))
    histogram = keyed.groupBy(*strata, "__digits").agg(
        F.count(F.lit(1)).alias("__size")
    )
    upto = Window.partitionBy(*strata).orderBy("__digits")
    groups = histogram.withColumn("__upto", F.sum("__size").over(upto))
    hit = _with_ranks(groups, ranks, strata).filter(
        (F.col("__rank") <= F.col("__upto"))
        & (F.col("__rank") > F.col("__upto") - F.col("__size"))
    )
    hit = settle(
        hit.select(
            *strata,
            "__digits",
            "__cut",
            (F.col("__rank") - F.col("__upto") + F.col("__size")).alias(
                "__within"
            ),
        )
    )
    # sort only the digit groups that hold a wanted rank
    wanted = hit.select(*strata, "__digits").distinct()
    inside = Window.partitionBy(*strata, "__digits").orderBy("__key")
    ranked = join_null_safe(
        keyed, wanted, [*strata, "__digits"], "left_semi"
    ).withColumn("__within", F.row_number().over(inside).cast("long"))
    return join_null_safe(
        ranked, hit, [*strata, "__digits", "__within"]
    ).select(*strata, "__cut", "__key")


def _with_ranks(
    groups: DataFrame, ranks: DataFrame, strata: list[str]
) -> DataFrame:
    if strata:
        return join_null_safe(groups, ranks, strata)
    # no strata: the wanted ranks are one short list
    listed = F.array(
        *[
            F.struct(
                F.lit(r["__cut"]).alias("__cut"),
                F.lit(r["__rank"]).alias("__rank"),
            )
            for r in ranks.collect()
        ]
    )
    return groups.select("*", F.inline(listed))


def rank_part(
    df: DataFrame,
    id_col: str,
    strata: Sequence[str],
    ranks: DataFrame,
    out: str,
    seed: int = 42,
    largest: int | None = None,
) -> DataFrame:
    """Number of wanted ranks each row lies behind, 0, 1, 2, ... as `out`.

    Cutting a stratum at ranks r1 < r2 gives part 0 (ranks 1..r1), part 1
    (r1+1..r2) and part 2. Rank 0 stands for "nothing": all rows are behind.
    """
    strata = list(strata)
    key = hash_key(id_col, seed)
    ranks = settle(ranks)
    positive = ranks.filter(F.col("__rank") > 0)
    cuts = settle(rank_cuts(df, key, strata, positive, largest))
    # a rank of 0 has the empty key, which lies before every row
    nothing = ranks.filter(F.col("__rank") <= 0).select(
        *strata, "__cut", F.lit("").alias("__key")
    )
    cuts = cuts.unionByName(nothing)
    per_stratum = settle(
        cuts.groupBy(*strata).agg(
            F.sort_array(F.collect_list("__key")).alias("__cuts")
        ),
        LITERAL_STRATA,
    )
    if per_stratum.isLocal():
        part = _part_sql(per_stratum.collect(), strata)
        return (
            df.withColumn("__key", key)
            .withColumn(out, F.expr(part))
            .drop("__key")
        )
    # many strata: an ordinary join instead of literals
    joined = join_null_safe(df, per_stratum, strata, "left")
    behind = F.size(F.filter("__cuts", lambda c: c < key))
    return joined.withColumn(
        out, F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(behind)
    ).drop("__cuts")


def _part_sql(rows: Sequence[Row], strata: Sequence[str]) -> str:
    """Cut keys as literals: a few comparisons per row and no join."""
    whens = []
    for row in rows:
        inside = comparison_tree("__key", row["__cuts"], "<=")
        if not strata:
            return inside
        same = " AND ".join(f"{name(c)} <=> {literal(row[c])}" for c in strata)
        whens.append(f"WHEN {same} THEN {inside}")
    return f"CASE {' '.join(whens)} ELSE 0 END" if whens else "0"


def ranks_table(
    df: DataFrame, ranks: Mapping[int, Column]
) -> DataFrame:
    """Long table of wanted ranks from columns of a per-stratum table."""
    strata = [c for c in df.columns if not c.startswith("__")]
    listed = F.array(
        *[
            F.struct(
                F.lit(cut).alias("__cut"), rank.cast("long").alias("__rank")
            )
            for cut, rank in ranks.items()
        ]
    )
    return df.select(*strata, F.inline(listed))


# --- order statistics --------------------------------------------------------


def exact_quantiles(
    df: DataFrame,
    probs: Mapping[str, Iterable[float]],
    sort_rows: int = SORT_ROWS,
    plain_rows: int = PLAIN_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, for several columns at once.

    Missing values are ignored. Columns up to `plain_rows` rows use the
    built-in exact percentile. Its one value map would grow with the data, so
    above that a sketch brackets every rank, one counting pass places the
    brackets, and only values inside them are sorted. Brackets are narrowed
    until none holds more than `sort_rows` rows (or a single value). Only the
    values at the wanted ranks reach the driver.
    """
    wanted = {c: sorted(set(p)) for c, p in probs.items()}
    data = df.select(*[_number(df, c).alias(c) for c in wanted])
    counts, brackets = _first_look(data, wanted, plain_rows, accuracy)
    found: dict[str, list[float | None]] = {}

    small = [c for c in wanted if counts[c] <= plain_rows]
    if small:
        row = data.agg(
            *[F.percentile(c, wanted[c]).alias(c) for c in small]
        ).first()
        for c in small:
            at = dict(zip(wanted[c], row[c] or [], strict=False))
            found[c] = [at.get(p) for p in probs[c]]
    if not brackets:
        return found

    brackets = _placed(data, counts, brackets)
    while any(b.size > sort_rows and not b.done for b in brackets):
        brackets = _narrowed(data, counts, brackets, sort_rows, accuracy)
    values = _values_at(data, brackets)
    for c in wanted:
        if c in found:
            continue
        row = []
        for p in probs[c]:
            pos = p * (counts[c] - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            a, b = values[(c, lo)], values[(c, hi)]
            row.append(a + (b - a) * (pos - lo))
        found[c] = row
    return found


@dataclass
class _Bracket:
    """Closed value range [low, high] that holds some 0-based ranks."""

    column: str
    low: float
    high: float
    ranks: set[int]
    below: int = 0
    size: int = 0
    tight: bool = False

    @property
    def done(self) -> bool:
        return self.tight or self.low == self.high

    @property
    def cuts(self) -> list[float]:
        # a value is inside when it is at or above the first and below the
        # second; NaN is above every number
        if self.high == math.inf:
            return [self.low, math.nan]
        return [self.low, math.nextafter(self.high, math.inf)]


def _number(df: DataFrame, c: str) -> Column:
    x = F.col(c).cast("double")
    if df.schema[c].dataType.typeName() in ("float", "double"):
        return F.when(~F.isnan(x), x)
    return x


def _sketch(x: str, steps: Sequence[float], accuracy: int) -> Column:
    listed = ", ".join(literal(float(s)) for s in steps)
    return F.expr(f"percentile_approx({x}, array({listed}), {accuracy})")


def _around(p: float, margin: float) -> list[float]:
    return [max(0.0, p - margin), min(1.0, p + margin)]


def _first_look(data, wanted, plain_rows, accuracy):
    """Row counts and, for large columns, one bracket per probability."""
    margin = 3.0 / accuracy
    looks = []
    for i, (c, ps) in enumerate(wanted.items()):
        steps = [s for p in ps for s in _around(p, margin)]
        looks.append(F.count(c).alias(f"n{i}"))
        looks.append(_sketch(name(c), steps, accuracy).alias(f"s{i}"))
    row = data.agg(*looks).first()
    counts, brackets = {}, []
    for i, (c, ps) in enumerate(wanted.items()):
        n = counts[c] = row[f"n{i}"]
        if n <= plain_rows:
            continue
        for j, p in enumerate(ps):
            low, high = row[f"s{i}"][2 * j : 2 * j + 2]
            pos = p * (n - 1)
            ranks = {math.floor(pos), math.ceil(pos)}
            brackets.append(_Bracket(c, low, high, ranks))
    return counts, brackets


def _merged(brackets: list[_Bracket]) -> dict[str, list[_Bracket]]:
    """Brackets per column in order, overlapping ones joined."""
    out: dict[str, list[_Bracket]] = {}
    for b in sorted(brackets, key=lambda b: (b.column, b.low, b.high)):
        row = out.setdefault(b.column, [])
        if row and b.low <= row[-1].high:
            last = row[-1]
            last.high = max(last.high, b.high)
            last.ranks |= b.ranks
            last.tight = last.tight or b.tight
        else:
            row.append(b)
    return out


def _positions(
    data: DataFrame, per_column: Mapping[str, list[_Bracket]]
) -> DataFrame:
    """Position of each column's value among the bracket ends, as rows.

    Odd positions are inside a bracket.
    """
    cells = []
    for i, (c, row) in enumerate(per_column.items()):
        ends = [x for b in row for x in b.cuts]
        cells.append(
            F.struct(
                F.lit(i).alias("c"),
                step_index(c, ends).alias("at"),
                F.col(c).alias("v"),
            )
        )
    # array_compact would leave generated code; missing values go here
    return data.select(F.inline(F.array(*cells))).filter(
        F.col("v").isNotNull()
    )


def _placed(data, counts, brackets) -> list[_Bracket]:
    """Count the rows below and inside every bracket in one pass."""
    per_column = _merged(brackets)
    rows = (
        _positions(data, per_column)
        .groupBy("c", "at")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    at = {(r["c"], r["at"]): r["n"] for r in rows}
    out = []
    for i, row in enumerate(per_column.values()):
        below, missed = 0, set()
        for j, b in enumerate(row):
            below += at.get((i, 2 * j), 0)
            b.below, b.size = below, at.get((i, 2 * j + 1), 0)
            below += b.size
            held = {r for r in b.ranks if b.below <= r < below}
            missed |= b.ranks - held
            b.ranks = held
        if missed:
            # outside the sketch's promise: look at the whole column
            ranks = missed.union(*[b.ranks for b in row])
            whole = _Bracket(row[0].column, -math.inf, math.inf, ranks)
            whole.size, whole.tight = counts[whole.column], True
            out.append(whole)
        else:
            out += [b for b in row if b.ranks]
    return out


def _narrowed(data, counts, brackets, sort_rows, accuracy):
    """Sketch again inside the wide brackets and place the smaller ones."""
    wide = [b for b in brackets if b.size > sort_rows and not b.done]
    kept = [b for b in brackets if b not in wide]
    looks = []
    for i, b in enumerate(wide):
        inside = f"{name(b.column)} BETWEEN {literal(b.low)} AND {literal(b.high)}"
        x = f"CASE WHEN {inside} THEN {name(b.column)} END"
        steps = [
            s
            for r in sorted(b.ranks)
            for s in _around((r - b.below) / (b.size - 1), 3.0 / accuracy)
        ]
        looks.append(_sketch(x, steps, accuracy).alias(f"s{i}"))
    ends = data.agg(*looks).first()
    for i, b in enumerate(wide):
        found = [
            _Bracket(b.column, *ends[f"s{i}"][2 * j : 2 * j + 2], {r})
            for j, r in enumerate(sorted(b.ranks))
        ]
        if any(f.low == b.low and f.high == b.high for f in found):
            # few distinct values: sorting them is cheap
            b.tight = True
            kept.append(b)
        else:
            kept += found
    return _placed(data, counts, kept)


def _values_at(data, brackets) -> dict[tuple[str, int], float]:
    """Values at the wanted ranks; sorts distinct values per bracket."""
    found: dict[tuple[str, int], float] = {}
    for b in brackets:
        if b.low == b.high:
            found.update({(b.column, r): b.low for r in b.ranks})
    per_column = _merged([b for b in brackets if b.low != b.high])
    if not per_column:
        return found
    runs = (
        _positions(data, per_column)
        .filter(F.col("at") % 2 == 1)
        .groupBy("c", "at", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("c", "at").orderBy("v")
    runs = runs.withColumn("upto", F.sum("n").over(upto))
    columns = list(per_column)
    inner = [
        (i, 2 * j + 1, r - b.below, r)
        for i, c in enumerate(columns)
        for j, b in enumerate(per_column[c])
        for r in b.ranks
    ]
    ranks = local_table(
        data.sparkSession, inner, "c int, at int, inner long, rank long"
    )
    hit = runs.join(ranks, ["c", "at"]).filter(
        (F.col("upto") > F.col("inner"))
        & (F.col("upto") - F.col("n") <= F.col("inner"))
    )
    for row in hit.collect():
        found[(columns[row["c"]], row["rank"])] = row["v"]
    return found


# --- running totals along a score --------------------------------------------


def bucket_count(
    df: DataFrame, column: str, bucket_rows: int = SORT_ROWS
) -> tuple[int, int]:
    """Buckets for the column's order, and the number of its values.

    One for every `bucket_rows` values, but no more than the session has
    shuffle partitions: buckets are there to run side by side, and a bucket's
    window may spill.
    """
    n = df.agg(F.count(column)).first()[0]
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, math.ceil(n / bucket_rows))), n


def score_runs(
    df: DataFrame,
    score: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    bucket_rows: int = SORT_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """One row per (by, score) with its sums and its order bucket `__bucket`.

    Buckets are Spark's range partitions of the collapsed scores. They are
    stored with their number, so every branch of a plan sees the same ones and
    no cut point stands in a plan, however many buckets there are. Correctness
    does not depend on where they begin. Missing scores come last.
    """
    if buckets is None:
        buckets, _ = bucket_count(df, score, bucket_rows)
    runs = df.groupBy(*by, score).agg(
        *[F.sum(c).alias(name) for name, c in sums.items()]
    )
    if buckets == 1:
        return runs.withColumn("__bucket", F.lit(0))
    placed = runs.repartitionByRange(buckets, F.col(score).asc_nulls_last())
    return staged(placed.withColumn("__bucket", F.spark_partition_id()))


def inside_bucket(
    by: Sequence[str], score: str, descending: bool = False
) -> Window:
    """Window over the rows of one bucket that come before the current one."""
    order = F.col(score).desc() if descending else F.col(score).asc()
    return (
        Window.partitionBy(*by, "__bucket")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def before_buckets(
    by: Sequence[str], descending: bool = False
) -> Window:
    """Window over the buckets (a row each) before the current one."""
    order = F.col("__bucket").desc() if descending else F.col("__bucket")
    return (
        Window.partitionBy(*by)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def running_before(
    runs: DataFrame,
    score: str,
    columns: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = True,
) -> DataFrame:
    """Add `<c>_before`: the total of `c` over all scores in front.

    Local prefix sums inside a bucket plus the totals of the buckets before
    it. The offsets table has one row per (by, bucket).
    """
    by = list(by)
    offsets = runs.groupBy(*by, "__bucket").agg(
        *[F.sum(c).alias(f"__t_{c}") for c in columns]
    )
    ahead = before_buckets(by, descending)
    offsets = offsets.select(
        *by,
        "__bucket",
        *[
            F.coalesce(F.sum(f"__t_{c}").over(ahead), F.lit(0)).alias(
                f"__o_{c}"
            )
            for c in columns
        ],
    )
    local = inside_bucket(by, score, descending)
    marked = runs.select(
        "*",
        *[
            F.coalesce(F.sum(c).over(local), F.lit(0)).alias(f"__l_{c}")
            for c in columns
        ],
    )
    out = join_null_safe(marked, offsets, [*by, "__bucket"])
    return out.select(
        *runs.columns,
        *[
            (F.col(f"__l_{c}") + F.col(f"__o_{c}")).alias(f"{c}_before")
            for c in columns
        ],
    ).drop("__bucket")
