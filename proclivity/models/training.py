"""Fit, evaluate and store models."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from proclivity.functions.tables import local_table
from proclivity.models.builders import PropensityModel
from proclivity.models.bundle import ModelBundle
from proclivity.operators.cleaning import clean, select_features
from proclivity.operators.evaluation import METRICS, classification_metrics
from proclivity.operators.sampling import stratified_sample, stratified_split
from proclivity.operators.validate import validate_features
from proclivity.session import staged
from proclivity.presets import SAMPLE_FRACTION, SEED, TEST_SIZE, THRESHOLD
from proclivity.sources.readers import check_override
from proclivity.sources.sinks import (
    write_comparison,
    write_importance,
    write_metrics,
)
from proclivity.spec import TableSpec


def prepare_split(
    raw: DataFrame,
    spec: TableSpec,
    frac: float = SAMPLE_FRACTION,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Clean, sample, check and split; one table with a `split` column.

    The split uses another seed than the sample: the sample keeps the rows
    with the smallest keys, which must not decide who is tested.
    """
    cleaned = staged(clean(select_features(raw, spec), spec))
    sample = stratified_sample(cleaned, spec.id, spec.target, frac, seed)
    validate_features(sample, spec)
    return staged(
        stratified_split(sample, spec.id, spec.target, test_size, seed + 1)
    )


def evaluate(
    bundle: ModelBundle,
    df: DataFrame,
    threshold: float | None = None,
    by: Sequence[str] = (),
) -> list[dict[str, Any]]:
    """Precision, recall, F1 and AUC of a model, one row per group."""
    target = bundle.spec.target
    scored = bundle.probability(df, [*by, target]).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        rows = classification_metrics(
            scored,
            target,
            "probability",
            bundle.threshold if threshold is None else threshold,
            by,
        ).collect()
    finally:
        scored.unpersist()
    return [row.asDict() for row in rows]


def fit_and_evaluate(
    name: str,
    split: DataFrame,
    spec: TableSpec,
    params: Mapping[str, Any] | None = None,
    threshold: float = THRESHOLD,
    seed: int = SEED,
) -> ModelBundle:
    """Fit one model on the train part; metrics on train and test."""
    train = split.filter(F.col("split") == "train")
    estimator = PropensityModel(
        name=name, spec=spec, settings=dict(params or {}), seed=seed
    )
    start = time.perf_counter()
    fitted = estimator.fit(train)
    seconds = time.perf_counter() - start
    bundle = ModelBundle(name, fitted, spec, fitted.slots, threshold)
    # both parts are scored and measured in one pass
    parts = {r["split"]: r for r in evaluate(bundle, split, by=["split"])}
    bundle.metrics = {
        "train": {m: parts["train"][m] for m in METRICS},
        "test": {m: parts["test"][m] for m in METRICS},
        "fit_seconds": round(seconds, 2),
        "n_train": parts["train"]["n_rows"],
        "n_test": parts["test"]["n_rows"],
    }
    if fitted.curve is not None:
        bundle.metrics["curve"] = fitted.curve
    return bundle


def curve_rows(spark, bundle: ModelBundle) -> DataFrame:
    """Held-out loss after each tree that was looked at, and those kept."""
    kept = bundle.pipeline.stages[-1].getNumTrees
    return local_table(
        spark,
        [
            (i, float(loss), i <= kept)
            for i, loss in enumerate(bundle.metrics["curve"], 1)
        ],
        "trees int, loss double, kept boolean",
    )


def metric_rows(spark, bundles: Sequence[ModelBundle]) -> DataFrame:
    """Comparison table: test metrics and fit time of several models."""
    rows = [
        (
            b.model_name,
            *[float(b.metrics["test"][m] or 0.0) for m in METRICS],
            b.metrics["fit_seconds"],
        )
        for b in bundles
    ]
    return local_table(
        spark,
        rows,
        "model string, precision double, recall double, f1 double, "
        "roc_auc double, fit_seconds double",
    )


def save_run(bundle: ModelBundle, out_dir: str, spark) -> str:
    """Write model, metrics and importance to `out_dir/<model name>`."""
    path = f"{out_dir}/{bundle.model_name}"
    bundle.save(f"{path}/model")
    write_metrics(metric_rows(spark, [bundle]), f"{path}/metrics")
    write_importance(bundle.importance(spark), f"{path}/feature_importance")
    if "curve" in bundle.metrics:
        curve_rows(spark, bundle).write.mode("overwrite").parquet(
            f"{path}/validation_curve"
        )
    return path


def train_models(
    names: Sequence[str],
    split: DataFrame,
    spec: TableSpec,
    out_dir: str | None = None,
    threshold: float = THRESHOLD,
    params: Mapping[str, Any] | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Fit several models on one split and compare them on its test part.

    Give a split that is stored (`prepare_split` stores it), not one that is
    computed anew for every pass.
    """
    check_override(params, names)
    spark = split.sparkSession
    bundles = []
    for name in names:
        bundle = fit_and_evaluate(name, split, spec, params, threshold, seed)
        if out_dir is not None:
            save_run(bundle, out_dir, spark)
        bundles.append(bundle)
    table = metric_rows(spark, bundles)
    if out_dir is not None:
        write_comparison(table, f"{out_dir}/comparison")
    return table
