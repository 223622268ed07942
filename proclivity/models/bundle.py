"""A fitted model with its threshold and feature names."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity import __version__
from proclivity.functions.scalar import threshold_decision
from proclivity.functions.tables import local_table
from proclivity.operators.validate import validate_features
from proclivity.presets import THRESHOLD
from proclivity.spec import TableSpec

KIND = "propensity-model"


@dataclass
class ModelBundle:
    """Fitted pipeline plus what is needed to use it."""

    model_name: str
    pipeline: PipelineModel
    spec: TableSpec
    feature_names: list[str]
    threshold: float = THRESHOLD
    metrics: dict[str, Any] = field(default_factory=dict)
    package_version: str = __version__

    def probability(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Columns to keep and the probability of class 1, unchecked."""
        scored = self.pipeline.transform(df)
        return scored.select(
            *keep,
            vector_to_array("probability")[1].alias("probability"),
        )

    def predict(self, df: DataFrame) -> DataFrame:
        """Check the rows, then give key, probability and 0/1 decision."""
        validate_features(df, self.spec)
        keep = [self.spec.id] if self.spec.id in df.columns else []
        scored = self.probability(df, keep)
        return scored.withColumn(
            "prediction", threshold_decision("probability", self.threshold)
        )

    def importance(self, spark: SparkSession) -> DataFrame:
        """Importance per encoded feature, largest first."""
        model = self.pipeline.stages[-1]
        if isinstance(model, LogisticRegressionModel):
            values = [abs(float(v)) for v in model.coefficients.toArray()]
        else:
            values = [float(v) for v in model.featureImportances.toArray()]
        rows = list(zip(self.feature_names, values, strict=True))
        table = local_table(
            spark, rows, "feature string, importance double"
        )
        return table.orderBy(F.col("importance").desc(), "feature")

    def save(self, path: str) -> str:
        """Write the pipeline and a one-row metadata table."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        meta = {
            "model_name": self.model_name,
            "threshold": self.threshold,
            "feature_names": self.feature_names,
            "metrics": self.metrics,
            "package_version": self.package_version,
            "features": self.spec.features,
        }
        local_table(
            spark, [(KIND, json.dumps(meta))], "kind string, meta string"
        ).coalesce(1).write.mode("overwrite").json(f"{path}/bundle")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str, spec: TableSpec) -> ModelBundle:
        """Read a bundle; anything else at the path is refused."""
        try:
            row = spark.read.schema("kind string, meta string").json(
                f"{path}/bundle"
            ).first()
        except Exception as err:
            raise TypeError(f"{path} does not contain a model") from err
        if row is None or row["kind"] != KIND:
            raise TypeError(f"{path} does not contain a model")
        meta = json.loads(row["meta"])
        if meta["features"] != spec.features:
            raise TypeError(f"{path} was fitted on other columns")
        return ModelBundle(
            model_name=meta["model_name"],
            pipeline=PipelineModel.load(f"{path}/pipeline"),
            spec=spec,
            feature_names=meta["feature_names"],
            threshold=meta["threshold"],
            metrics=meta["metrics"],
            package_version=meta["package_version"],
        )


def linear_score_sql(
    expressions: list[str], weights: list[float], intercept: float
) -> str:
    """A linear model as one SQL expression of its encoded features."""
    terms = " + ".join(
        f"({float(w)!r}D) * ({e})"
        for e, w in zip(expressions, weights, strict=True)
    )
    return f"1D / (1D + exp(-(({float(intercept)!r}D) + {terms})))"
