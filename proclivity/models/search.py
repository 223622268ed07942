"""Hyper-parameter search on stratified folds."""

from __future__ import annotations

import itertools
import math
import random
import statistics
import time
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.tables import local_table
from proclivity.models.builders import PropensityModel
from proclivity.models.bundle import ModelBundle
from proclivity.models.training import evaluate
from proclivity.operators.sampling import stratified_folds
from proclivity.presets import CV_FOLDS, PARAM_GRIDS, SEARCH_RANGES, SEED
from proclivity.session import staged
from proclivity.spec import TableSpec

TRIALS = (
    "trial int, params string, fold_scores array<double>, score double, "
    "seconds double, state string"
)


def expand_grid(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """All combinations of a parameter grid."""
    keys = list(grid)
    return [
        dict(zip(keys, values, strict=True))
        for values in itertools.product(*grid.values())
    ]


def grid_search(
    name: str,
    df: DataFrame,
    spec: TableSpec,
    grid: Mapping[str, Sequence[Any]] | None = None,
    folds: int = CV_FOLDS,
    parallelism: int = 2,
    seed: int = SEED,
) -> tuple[dict[str, Any], float, DataFrame]:
    """Exhaustive search by cross-validated F1 of class 1.

    Spark's own cross-validator runs the fits; the folds are exact and
    stratified. Returns the best parameters, their score and all results.
    """
    combos = expand_grid(grid or PARAM_GRIDS[name])
    data = stratified_folds(df, spec.id, spec.target, folds, seed)
    data = staged(
        data.withColumn("__label", F.col(spec.target).cast("double"))
    )
    model = PropensityModel(name=name, spec=spec, settings={}, seed=seed)
    search = CrossValidator(
        estimator=model,
        estimatorParamMaps=[{model.settings: c} for c in combos],
        evaluator=MulticlassClassificationEvaluator(
            labelCol="__label", metricName="fMeasureByLabel", metricLabel=1.0
        ),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    found = search.fit(data)
    table = cv_results_table(df.sparkSession, found, combos)
    best = max(range(len(combos)), key=lambda i: found.avgMetrics[i])
    return combos[best], float(found.avgMetrics[best]), table


def cv_results_table(
    spark, found: CrossValidatorModel, combos: Sequence[Mapping[str, Any]]
) -> DataFrame:
    """Mean, deviation and rank of every parameter set."""
    rows = [
        (i, str(dict(c)), float(m), float(s))
        for i, (c, m, s) in enumerate(
            zip(combos, found.avgMetrics, found.stdMetrics, strict=True)
        )
    ]
    table = local_table(
        spark, rows, "set_no int, params string, mean_score double, std_score double"
    )
    by_score = Window.orderBy(F.col("mean_score").desc())
    return table.withColumn("rank", F.rank().over(by_score))


def fold_scores(
    name: str,
    data: DataFrame,
    spec: TableSpec,
    params: Mapping[str, Any],
    folds: int,
    metric: str = "f1",
    seed: int = SEED,
    earlier: Sequence[Sequence[float]] = (),
) -> tuple[list[float], str]:
    """Score per fold; stops early when the median rule prunes the trial.

    `data` has a `fold` column; `earlier` holds the fold scores of the trials
    before this one.
    """
    scores: list[float] = []
    for k in range(folds):
        train = data.filter(F.col("fold") != k)
        held = data.filter(F.col("fold") == k)
        fitted = PropensityModel(
            name=name, spec=spec, settings=dict(params), seed=seed
        ).fit(train)
        bundle = ModelBundle(name, fitted, spec, fitted.slots)
        scores.append(float(evaluate(bundle, held)[0][metric] or 0.0))
        if should_prune(scores, earlier):
            return scores, "PRUNED"
    return scores, "COMPLETE"


def should_prune(
    scores: Sequence[float],
    earlier: Sequence[Sequence[float]],
    startup: int = 2,
) -> bool:
    """The last fold score is below the median of earlier trials there."""
    fold = len(scores) - 1
    known = [t[fold] for t in earlier if len(t) > fold]
    return len(known) >= startup and scores[-1] < statistics.median(known)


def cv_score(
    name: str,
    df: DataFrame,
    spec: TableSpec,
    params: Mapping[str, Any] | None = None,
    folds: int = CV_FOLDS,
    metric: str = "f1",
    seed: int = SEED,
) -> float:
    """Mean score over stratified folds."""
    data = staged(stratified_folds(df, spec.id, spec.target, folds, seed))
    scores, _ = fold_scores(
        name, data, spec, params or {}, folds, metric, seed
    )
    return statistics.fmean(scores)


def draw(
    ranges: Mapping[str, tuple[str, float, float]], rng: random.Random
) -> dict[str, Any]:
    """One random parameter set."""
    out: dict[str, Any] = {}
    for key, (kind, low, high) in ranges.items():
        if kind == "uniform":
            out[key] = rng.uniform(low, high)
        elif kind == "log":
            out[key] = math.exp(rng.uniform(math.log(low), math.log(high)))
        elif kind == "int":
            out[key] = rng.randint(int(low), int(high))
        else:
            value = math.exp(rng.uniform(math.log(low), math.log(high)))
            out[key] = round(value)
    return out


def random_search(
    name: str,
    df: DataFrame,
    spec: TableSpec,
    n_trials: int = 30,
    folds: int = CV_FOLDS,
    ranges: Mapping[str, tuple[str, float, float]] | None = None,
    metric: str = "f1",
    seed: int = SEED,
    prune: bool = False,
) -> tuple[dict[str, Any], float, DataFrame]:
    """Seeded random search; returns best parameters, score, trial table."""
    rng = random.Random(seed)
    spark = df.sparkSession
    data = staged(stratified_folds(df, spec.id, spec.target, folds, seed))
    rows, history, sets = [], [], []
    for trial in range(n_trials):
        params = draw(ranges or SEARCH_RANGES[name], rng)
        start = time.perf_counter()
        scores, state = fold_scores(
            name, data, spec, params, folds, metric, seed,
            history if prune else (),
        )
        history.append(scores)
        sets.append(params)
        score = statistics.fmean(scores) if state == "COMPLETE" else None
        rows.append(
            (trial, str(params), scores, score,
             time.perf_counter() - start, state)
        )
    done = [r for r in rows if r[3] is not None]
    best = max(done, key=lambda r: r[3])
    return sets[best[0]], best[3], local_table(spark, rows, TRIALS)


def best_trial(trials: DataFrame, score: str = "score") -> DataFrame:
    """The complete trial with the best score; the first one wins a tie."""
    done = trials.filter(F.col("state") == "COMPLETE")
    order = F.struct((-F.col(score)).alias("m"), F.col("trial"))
    return done.agg(
        F.count(F.lit(1)).alias("n_complete"),
        F.min_by("trial", order).alias("trial"),
        F.max(score).alias(score),
    )


def median_pruning(
    fold_table: DataFrame, startup: int = 2
) -> DataFrame:
    """Which trials the median rule stops, from (trial, fold, score)."""
    before = Window.partitionBy("fold").orderBy("trial").rowsBetween(
        Window.unboundedPreceding, -1
    )
    judged = fold_table.select(
        "trial",
        "fold",
        "score",
        F.percentile("score", 0.5).over(before).alias("median_before"),
        F.count("score").over(before).alias("n_before"),
    )
    return judged.withColumn(
        "pruned",
        (F.col("n_before") >= startup)
        & (F.col("score") < F.col("median_before")),
    )
