"""Feature encoders.

Fitting computes a few statistics with Spark; the fitted encoder is a list of
SQL expressions with those statistics as literals. Transforming is therefore
a plain projection inside generated code, and Spark's own `SQLTransformer`
stores it with the model. Level codes and target means, whose number grows
with the data, are stored tables that a stage joins first (`dictionaries`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.exact import exact_quantiles
from proclivity.functions.tables import settle
from proclivity.operators.dictionaries import (
    Lookup,
    level_lookups,
    mean_lookups,
)
from proclivity.session import staged
from proclivity.functions.scalar import NAN_KEY, literal, name, str_key


def key_sql(column: str) -> str:
    """SQL of the category key of a column."""
    return f"coalesce(cast({name(column)} AS STRING), '{NAN_KEY}')"


@dataclass
class Encoder:
    """Fitted encoder: output name -> SQL expression, in output order.

    Expressions may name columns that `lookups` add from stored tables first.
    """

    expressions: dict[str, str] = field(default_factory=dict)
    lookups: list[Lookup] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        """Names of the encoded features."""
        return list(self.expressions)

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Encoded columns next to the columns to keep."""
        for lookup in self.lookups:
            df = lookup.transform(df)
        return df.select(
            *keep,
            *[F.expr(e).alias(n) for n, e in self.expressions.items()],
        )

    def stages(self, prefix: str = "x") -> tuple[list[Transformer], list[str]]:
        """The encoder as storable stages, with its physical columns."""
        physical = [f"__{prefix}{i}" for i in range(len(self.expressions))]
        parts = ", ".join(
            f"{e} AS {name(c)}"
            for c, e in zip(physical, self.expressions.values(), strict=True)
        )
        statement = f"SELECT *, {parts} FROM __THIS__"
        return [*self.lookups, SQLTransformer(statement=statement)], physical

    def __add__(self, other: Encoder) -> Encoder:
        return Encoder(
            {**self.expressions, **other.expressions},
            [*self.lookups, *other.lookups],
        )


# --- frequency --------------------------------------------------------------


def category_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of every category of several columns, in one pass."""
    total = df.agg(F.count(F.lit(1))).scalar()
    cells = [
        F.struct(F.lit(c).alias("column"), str_key(c).alias("category"))
        for c in columns
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column", "category")
        .agg((F.count(F.lit(1)) / total).alias("share"))
    )


def freq_tables(
    df: DataFrame, columns: Sequence[str], threshold: float = 0.01
) -> tuple[DataFrame, DataFrame]:
    """Common categories with their share, and the share of all rare ones.

    A common category has at least `threshold` of the rows, so there are at
    most 1 / threshold of them per column whatever the data size.
    """
    shares = category_shares(df, columns)
    common = shares.filter(F.col("share") >= threshold)
    rare = F.when(F.col("share") < threshold, F.col("share"))
    other = shares.groupBy("column").agg(
        F.coalesce(F.sum(rare), F.lit(0.0)).alias("share")
    )
    return common, other


def fit_frequency(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = 0.01,
) -> Encoder:
    """Frequency encoder: share of a common category, else the rare share."""
    if not columns:
        return Encoder()
    shares = category_shares(df, columns)
    is_common = F.col("share") >= threshold
    # common categories one by one, all rare ones as one row per column
    kept = (
        shares.groupBy(
            "column", F.when(is_common, F.col("category")).alias("category")
        )
        .agg(F.sum("share").alias("share"))
        .collect()
    )
    out = {}
    for c in columns:
        common = sorted(
            (r["category"], r["share"])
            for r in kept
            if r["column"] == c and r["category"] is not None
        )
        other = sum(
            r["share"]
            for r in kept
            if r["column"] == c and r["category"] is None
        )
        fallback = literal(float(other))
        if not common:
            out[c] = fallback
            continue
        pairs = ", ".join(
            f"{literal(k)}, {literal(float(v))}" for k, v in common
        )
        out[c] = (
            f"coalesce(try_element_at(map({pairs}), {key_sql(c)}), {fallback})"
        )
    return Encoder(out)


def freq_table_with_other(
    df: DataFrame, column: str, threshold: float, other: str = "OTHER"
) -> DataFrame:
    """Category map where the rare share is stored under its own name."""
    common, rest = freq_tables(df, [column], threshold)
    return common.select("category", "share").unionByName(
        rest.select(F.lit(other).alias("category"), "share")
    )


# --- scaling ----------------------------------------------------------------


def fit_robust(df: DataFrame, columns: Sequence[str]) -> Encoder:
    """(x - median) / IQR with exact quartiles; an IQR of 0 counts as 1."""
    if not columns:
        return Encoder()
    found = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    out = {}
    for c, (low, mid, high) in found.items():
        width = (high or 0.0) - (low or 0.0) or 1.0
        out[c] = (
            f"(cast({name(c)} AS DOUBLE) - {literal(float(mid or 0.0))})"
            f" / {literal(float(width))}"
        )
    return Encoder(out)


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Encoder:
    """(x - mean) / population deviation; a deviation of 0 counts as 1."""
    if not columns:
        return Encoder()
    sums = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        sums += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*sums).first()
    out = {}
    for i, c in enumerate(columns):
        mean, std = row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0
        out[c] = (
            f"(cast({name(c)} AS DOUBLE) - {literal(float(mean))})"
            f" / {literal(float(std))}"
        )
    return Encoder(out)


def fit_table_with_other(
    df: DataFrame, column: str, threshold: float, other: str
) -> Encoder:
    """Shares looked up in `freq_table_with_other`, stored once; values that
    the table lacks get the share of `other`."""
    table = staged(
        freq_table_with_other(df, column, threshold, other).select(
            F.col("category").alias("value"), F.col("share").alias("code")
        )
    )
    rest = table.where(F.col("value") == other).agg(F.max("code")).first()[0]
    place = f"__share_{column}"
    lookup = Lookup(
        inputCol=column,
        outputCol=place,
        miss=f"{float(rest or 0.0)!r}D",
        as_key=True,
        table=table.where(F.col("value") != other),
    )
    return Encoder({column: name(place)}, [lookup])


# --- levels -----------------------------------------------------------------


def fit_levels(
    df: DataFrame, columns: Sequence[str]
) -> dict[str, list[Any]]:
    """Sorted distinct values per column (numbers in numeric order).

    For one-hot columns, whose levels become columns. Codes and means of
    columns with many levels come from tables (`dictionaries`).
    """
    if not columns:
        return {}
    row = df.agg(
        *[F.sort_array(F.collect_set(c)).alias(c) for c in columns]
    ).first()
    return {c: list(row[c]) for c in columns}


def _unknown(column: str) -> str:
    text = f"'Found unknown level in column {column}: '"
    return f"raise_error(concat({text}, {key_sql(column)}))"


def fit_onehot(df: DataFrame, columns: Sequence[str]) -> Encoder:
    """One 0/1 column per level; of exactly two levels only the second.

    An unknown level is an error.
    """
    out = {}
    for c, levels in fit_levels(df, columns).items():
        known = ", ".join(literal(v) for v in levels)
        kept = levels[1:] if len(levels) == 2 else levels
        for level in kept:
            out[f"{c}_{level}"] = (
                f"CASE WHEN {name(c)} = {literal(level)} THEN 1 "
                f"WHEN {name(c)} IN ({known}) THEN 0 "
                f"ELSE {_unknown(c)} END"
            )
    return Encoder(out)


def _case(column: str, levels: Sequence[Any], miss: str) -> str:
    whens = " ".join(
        f"WHEN {name(column)} = {literal(v)} THEN {i}"
        for i, v in enumerate(levels)
    )
    return f"CASE {whens} ELSE {miss} END"


def fit_ordinal(levels: Mapping[str, Sequence[Any]]) -> Encoder:
    """Given level order -> 0..k-1; an unknown level is an error."""
    return Encoder(
        {c: _case(c, order, _unknown(c)) for c, order in levels.items()}
    )


def _level_column(column: str) -> str:
    return f"__level_{column}"


def fit_ordinal_learned(df: DataFrame, columns: Sequence[str]) -> Encoder:
    """Sorted levels -> 0..k-1; an unknown level is an error."""
    return _coded(df, columns, {c: _unknown(c) for c in columns})


def fit_category_index(df: DataFrame, columns: Sequence[str]) -> Encoder:
    """Category codes frozen at fit time; an unseen value becomes null."""
    return _coded(df, columns, {})


def _coded(
    df: DataFrame, columns: Sequence[str], miss: Mapping[str, str]
) -> Encoder:
    """Codes from stored tables of levels, of any size."""
    places = {c: _level_column(c) for c in columns}
    return Encoder(
        {c: name(place) for c, place in places.items()},
        level_lookups(df, places, miss),
    )


def category_dictionary(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their code, as a table (value, code).

    For dictionaries too large for literals. The distinct values are range
    partitioned and stored with their partition number, so the sort runs in
    parallel and every later pass sees the same partitions; the sizes of the
    partitions give the offsets.
    """
    values = (
        df.filter(F.col(column).isNotNull())
        .select(F.col(column).alias("value"))
        .distinct()
    )
    placed = staged(
        values.repartitionByRange("value").withColumn(
            "__part", F.spark_partition_id()
        )
    )
    ahead = Window.orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = settle(
        placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    ).select(
        "__part",
        F.coalesce(F.sum("__size").over(ahead), F.lit(0)).alias("__offset"),
    )
    inside = Window.partitionBy("__part").orderBy("value")
    return placed.join(offsets, "__part").select(
        "value",
        (F.col("__offset") + F.row_number().over(inside) - 1).alias("code"),
    )


def category_string(columns: Sequence[str]) -> Encoder:
    """Plain text form of the codes."""
    return Encoder({c: key_sql(c) for c in columns})


def passthrough(columns: Sequence[str]) -> Encoder:
    """Numbers as they are."""
    return Encoder({c: f"cast({name(c)} AS DOUBLE)" for c in columns})


# --- whole preprocessors ------------------------------------------------------


def fit_encoded_features(df: DataFrame, spec, threshold: float = 0.01):
    """Fully numeric features for linear models and forests."""
    return (
        fit_robust(df, spec.robust)
        + fit_standard(df, spec.numeric)
        + fit_frequency(df, spec.high_card, threshold)
        + fit_onehot(df, spec.binary)
        + fit_ordinal(spec.ordinal)
    )


def fit_scaled_features(df: DataFrame, spec) -> Encoder:
    """Scaled numbers and the ordinal code only; other columns stay raw."""
    return (
        fit_robust(df, spec.robust)
        + fit_standard(df, spec.numeric)
        + fit_ordinal(spec.ordinal)
    )


def fit_native_features(df: DataFrame, spec) -> Encoder:
    """Numbers as they are, learned and given level codes, category codes."""
    return (
        passthrough([*spec.robust, *spec.numeric])
        + fit_ordinal_learned(df, spec.binary)
        + fit_ordinal(spec.ordinal)
        + fit_category_index(df, spec.high_card)
    )


# --- target means ---------------------------------------------------------------


def target_mean_oof(
    df: DataFrame,
    column: str,
    target: str,
    fold: str,
    weight: float = 1.0,
    out: str = "target_mean",
) -> DataFrame:
    """Mean target of the category over the other folds, pulled to the mean.

    One aggregation by (category, fold); the means of "all folds but mine"
    follow from the totals. The join brings one small row per (category,
    fold); a hot category is split by adaptive execution.
    """
    y = F.col(target).cast("double")
    cells = settle(
        df.groupBy(str_key(column).alias("__k"), fold).agg(
            F.sum(y).alias("__s"), F.count(F.lit(1)).alias("__c")
        )
    )
    totals = cells.groupBy("__k").agg(
        F.sum("__s").alias("__ts"), F.sum("__c").alias("__tc")
    )
    prior = df.agg(F.avg(y)).scalar()
    means = settle(
        cells.join(totals, "__k").select(
            "__k",
            F.col(fold).alias("__f"),
            (
                (F.col("__ts") - F.col("__s") + prior * weight)
                / (F.col("__tc") - F.col("__c") + weight)
            ).alias(out),
        )
    )
    match = (str_key(column) == F.col("__k")) & (
        F.col(fold) == F.col("__f")
    )
    return df.join(means, match, "left").drop("__k", "__f")


def fit_target_mean(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    weight: float = 1.0,
) -> Encoder:
    """Mean target per category for scoring; unseen values get the mean.

    The means are a stored table, of any size. The rows that they are made of
    must not be trained on with them: use `target_mean_oof` there.
    """
    places = {c: f"__mean_{c}" for c in columns}
    return Encoder(
        {c: name(place) for c, place in places.items()},
        mean_lookups(df, places, target, weight),
    )


# --- derived columns -----------------------------------------------------------


def derived_features(
    df: DataFrame,
    age: str,
    vintage: str,
    premium: str,
    licence: str,
    insured: str,
    damage: str,
    region: str,
    channel: str,
    damage_yes: str = "Yes",
    premium_cuts: Sequence[float] | None = None,
    vintage_edges: Sequence[int] = (0, 100, 200, 300),
) -> DataFrame:
    """Eleven derived candidate features."""
    if premium_cuts is None:
        found = exact_quantiles(df, {premium: [0.2, 0.4, 0.6, 0.8]})
        premium_cuts = found[premium]
    a, v, p = (F.col(c).cast("double") for c in (age, vintage, premium))

    def bands(x, edges):
        # right-closed groups 1..k, 0 outside
        out = F.when(x <= edges[0], 0)
        for i, edge in enumerate(edges[1:], start=1):
            out = out.when(x <= edge, i)
        return out.otherwise(0)

    # right-closed quintiles: number of cut points below the value
    quintile = sum(
        ((p > F.lit(c)).cast("int") for c in premium_cuts), F.lit(1)
    )
    no_insurance = (F.col(insured) == 0) & (F.col(damage) == damage_yes)
    adult = (F.col(licence) == 1) & (a >= 18)
    return df.withColumns(
        {
            "log_premium": F.log1p(p),
            "age_to_vintage": a / (v + 1),
            "premium_to_age": p / (a + 1),
            "premium_to_vintage": p / (v + 1),
            # fixed values: age group edges
            "age_group": bands(a, (0, 25, 35, 45, 55, 100)),
            "premium_group": quintile,
            "no_insurance_but_damage": no_insurance.cast("int"),
            "age_premium": a * p / 1000,
            "licensed_adult": adult.cast("int"),
            "region_channel": F.concat_ws(
                "_", str_key(region), str_key(channel)
            ),
            "vintage_group": bands(v, tuple(vintage_edges)),
        }
    )
