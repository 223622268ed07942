"""Classifiers by name: a feature stage and an MLlib estimator.

Model names and user-facing parameters follow the published configuration;
they are translated to MLlib parameters here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations
from typing import Any

from pyspark import SparkContext, keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param import Param, Params
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proclivity.operators import encoders as enc
from proclivity.operators.dictionaries import (
    level_lookups,
    mean_lookups,
    ordered_means,
)
from proclivity.presets import BEST_PARAMS, RARE_SHARE, SEED
from proclivity.sources.readers import merge_params
from proclivity.spec import TableSpec

FEATURES = "__features"
LABEL = "__label"
WEIGHT = "__weight"


def class_sizes(df: DataFrame, target: str) -> dict[Any, int]:
    """Rows per class."""
    rows = df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[target]: r["n"] for r in rows}


def balanced_weights(sizes: Mapping[Any, int]) -> dict[Any, float]:
    """Weight n / (2 * n_class) of each class."""
    total = sum(sizes.values())
    return {label: total / (2 * n) for label, n in sizes.items()}


def class_weight(
    df: DataFrame, target: str, out: str, positive: float | None = None
) -> DataFrame:
    """Weight column: balanced, or `positive` for class 1 and 1 for class 0."""
    if positive is not None:
        w = F.when(F.col(target) == 1, F.lit(float(positive))).otherwise(1.0)
        return df.withColumn(out, w)
    return df.withColumn(
        out, _weight_of(balanced_weights(class_sizes(df, target)), target)
    )


def _weight_of(weights: Mapping[Any, float], target: str) -> Column:
    value = F.lit(None).cast("double")
    for label, w in weights.items():
        value = F.when(F.col(target) == label, F.lit(w)).otherwise(value)
    return value


class FeatureStages:
    """Fitted feature stages and the names of the vector slots.

    `train` prepares the rows that the stages were fitted on, where these
    must not see their own labels; without it the stages do.
    """

    def __init__(
        self,
        stages: list,
        names: list[str],
        bins: int = 32,
        train: Callable[[DataFrame], DataFrame] | None = None,
    ):
        """Keep stages, slot names and the bins tree learners need."""
        self.stages = stages
        self.names = names
        self.bins = bins
        self.train = train or self.transform

    def transform(self, df: DataFrame) -> DataFrame:
        """Features of rows that are scored."""
        for stage in self.stages:
            df = stage.transform(df)
        return df


def encoded_stages(df: DataFrame, spec: TableSpec) -> FeatureStages:
    """Fully numeric features."""
    encoder = enc.fit_encoded_features(df, spec, RARE_SHARE)
    stages, physical = encoder.stages()
    assemble = VectorAssembler(inputCols=physical, outputCol=FEATURES)
    return FeatureStages([*stages, assemble], encoder.names)


def native_stages(
    df: DataFrame, spec: TableSpec, max_bins: int = 32
) -> FeatureStages:
    """Numbers as they are and codes with category meaning.

    Tree learners get a bin for every level of the codes, however many.
    """
    plain = (
        enc.passthrough([*spec.robust, *spec.numeric])
        + enc.fit_ordinal_learned(df, spec.binary)
        + enc.fit_ordinal(spec.ordinal)
    )
    return _with_categories(df, plain, spec.high_card, max_bins)


def _with_categories(df, plain, columns, max_bins) -> FeatureStages:
    places = {c: f"__c{i}" for i, c in enumerate(columns)}
    lookups = level_lookups(df, places, for_trees=True)
    sizes = [x.getOrDefault(x.size) for x in lookups]
    stages, physical = plain.stages("x") if plain.expressions else ([], [])
    assemble = VectorAssembler(
        inputCols=[*physical, *places.values()], outputCol=FEATURES
    )
    return FeatureStages(
        [*stages, *lookups, assemble],
        [*plain.names, *columns],
        max([max_bins, *sizes]),
    )


def target_mean_stages(
    df: DataFrame, spec: TableSpec, max_bins: int = 32
) -> FeatureStages:
    """Numbers and level codes; codes as their mean target.

    Rows are trained on with the means of other folds, and scored with those
    of all training rows.
    """
    numbers = (
        enc.passthrough([*spec.robust, *spec.numeric])
        + enc.fit_ordinal_learned(df, spec.binary)
        + enc.fit_ordinal(spec.ordinal)
    )
    return _with_means(
        df, spec, numbers, list(spec.high_card), max_bins, _fold_means
    )


#: Folds of the target means that a model is trained on.
MEAN_FOLDS = 5


def _fold_means(
    rows: DataFrame, places: dict[str, str], target: str, keys: list[str]
) -> DataFrame:
    """Means of the other folds, so no row's label is in its features."""
    rows = rows.withColumn(
        "__fold", F.pmod(F.xxhash64(*keys), F.lit(MEAN_FOLDS))
    )
    for c, out in places.items():
        rows = enc.target_mean_oof(rows, c, target, "__fold", out=out)
    return rows.drop("__fold")


def _with_means(
    df: DataFrame,
    spec: TableSpec,
    plain: enc.Encoder,
    columns: list[str],
    max_bins: int,
    own_means: Callable,
    before: list | None = None,
) -> FeatureStages:
    """Plain features and target means of the columns, which the stages
    `before` may make; `own_means` are those of the training rows."""
    before = before or []
    places = {c: f"__m{i}" for i, c in enumerate(columns)}
    prepared = df
    for stage in before:
        prepared = stage.transform(prepared)
    lookups = mean_lookups(prepared, places, spec.target)
    stages, physical = plain.stages("x") if plain.expressions else ([], [])
    assemble = VectorAssembler(
        inputCols=[*physical, *places.values()], outputCol=FEATURES
    )

    def train(rows: DataFrame) -> DataFrame:
        keys = [spec.id] if spec.id in rows.columns else rows.columns
        for stage in before:
            rows = stage.transform(rows)
        rows = own_means(rows, places, spec.target, keys)
        for stage in [*stages, assemble]:
            rows = stage.transform(rows)
        return rows

    return FeatureStages(
        [*before, *stages, *lookups, assemble],
        [*plain.names, *columns],
        max_bins,
        train,
    )


def all_categorical_stages(
    df: DataFrame, spec: TableSpec, max_bins: int = 32
) -> FeatureStages:
    """Every value of every column as a category, and pairs of the columns
    that are categories by nature; each by its ordered target mean."""
    single = [
        *spec.robust,
        *spec.numeric,
        *spec.high_card,
        *spec.binary,
        *spec.ordinal,
    ]
    nature = [*spec.high_card, *spec.binary, *spec.ordinal]
    pairs = {
        f"{a} & {b}": f"concat_ws('\\u0001', {enc.key_sql(a)}, {enc.key_sql(b)})"
        for a, b in combinations(nature, 2)
    }
    before = []
    if pairs:
        parts = ", ".join(f"{e} AS {enc.name(n)}" for n, e in pairs.items())
        before = [SQLTransformer(statement=f"SELECT *, {parts} FROM __THIS__")]
    return _with_means(
        df,
        spec,
        enc.Encoder(),
        [*single, *pairs],
        max_bins,
        ordered_means,
        before,
    )


# --- estimators -----------------------------------------------------------------


def _logreg(p: dict, weight_sum: float, bins: int, seed: int):
    return LogisticRegression(
        regParam=1.0 / (p["C"] * weight_sum),
        elasticNetParam=p["l1_ratio"],
        standardization=False,
        maxIter=p.get("max_iter", 1000),
        tol=p.get("tol", 1e-6),
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
    )


def _forest(p: dict, weight_sum: float, bins: int, seed: int):
    return RandomForestClassifier(
        numTrees=p["n_estimators"],
        maxDepth=p["max_depth"],
        featureSubsetStrategy=str(p["max_features"]),
        subsamplingRate=float(p["max_samples"]),
        minInstancesPerNode=p["min_samples_leaf"],
        maxBins=max(bins, p.get("max_bins", 32)),
        seed=seed,
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
    )


def _boosting(p: dict, weight_sum: float, bins: int, seed: int):
    settings = {}
    if "validation_col" in p and "early_stopping_rounds" not in p:
        settings["validationIndicatorCol"] = p["validation_col"]
        settings["validationTol"] = p.get("validation_tol", 0.01)
    return GBTClassifier(
        maxIter=p["n_estimators"],
        maxDepth=p["max_depth"],
        stepSize=p["learning_rate"],
        subsamplingRate=p.get("subsample", 1.0),
        featureSubsetStrategy=str(float(p.get("colsample_bytree", 1.0))),
        maxBins=max(bins, p.get("max_bins", 32)),
        checkpointInterval=10,
        seed=seed,
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        **settings,
    )


def patience_stop(curve: Sequence[float], rounds: int) -> tuple[int, int]:
    """(trees to keep, trees looked at) of a curve of losses.

    The curve is read until `rounds` trees in a row bring no new least loss;
    the trees up to the first least loss are kept.
    """
    best = 0
    for i, loss in enumerate(curve):
        if loss < curve[best]:
            best = i
        elif i - best >= rounds:
            return best + 1, i + 1
    return best + 1, len(curve)


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first n trees of a boosted model."""
    java = SparkContext._active_spark_context._gateway.jvm
    ml = java.org.apache.spark.ml
    trees = model._java_obj.trees()
    made = JavaWrapper._new_java_obj(
        "org.apache.spark.ml.classification.GBTClassificationModel",
        model.uid,
        JavaWrapper._new_java_array(
            [trees[i] for i in range(n)],
            ml.regression.DecisionTreeRegressionModel,
        ),
        JavaWrapper._new_java_array(model.treeWeights[:n], java.double),
        model.numFeatures,
        model.numClasses,
    )
    return GBTClassificationModel(made).setFeaturesCol(model.getFeaturesCol())


def fit_with_patience(
    estimator: GBTClassifier,
    train: DataFrame,
    held_out: DataFrame,
    rounds: int,
) -> tuple[GBTClassificationModel, list[float]]:
    """The boosted model cut where the held-out loss stops falling.

    All trees are fitted on the training rows; one pass over the held-out
    rows gives the mean log loss after each tree (staged predictions).
    """
    model = estimator.fit(train)
    curve = list(model.evaluateEachIteration(held_out))
    kept, seen = patience_stop(curve, rounds)
    return first_trees(model, kept), curve[:seen]


BUILDERS: dict[str, tuple[Callable, Callable, str]] = {
    "logreg": (encoded_stages, _logreg, "logreg"),
    "random_forest": (encoded_stages, _forest, "random_forest"),
    "gbt": (native_stages, _boosting, "gbt"),
    "gbt_categorical": (target_mean_stages, _boosting, "gbt_categorical"),
    "gbt_all_categorical": (
        all_categorical_stages, _boosting, "gbt_categorical",
    ),
}
MODEL_NAMES = list(BUILDERS)

#: Parameters that each learner has; any other name is refused.
BOOSTING_NAMES = frozenset(
    "n_estimators max_depth learning_rate subsample colsample_bytree "
    "scale_pos_weight max_bins validation_col validation_tol "
    "early_stopping_rounds".split()
)
PARAMETER_NAMES = {
    "logreg": frozenset(("C", "l1_ratio", "max_iter", "tol")),
    "random_forest": frozenset(
        "n_estimators max_depth max_features max_samples min_samples_leaf "
        "class_weight max_bins".split()
    ),
    "gbt": BOOSTING_NAMES,
    "gbt_categorical": BOOSTING_NAMES,
    "gbt_all_categorical": BOOSTING_NAMES,
}


def model_params(
    name: str, params: Mapping[str, Any] | None = None
) -> dict[str, Any]:
    """Tuned parameters of a model with overrides; unknown names fail."""
    if name not in BUILDERS:
        raise ValueError(f"Unknown model {name!r}; choose from {MODEL_NAMES}")
    if unknown := sorted(set(params or {}) - PARAMETER_NAMES[name]):
        raise ValueError(f"{name} has no parameters {unknown}")
    return merge_params(BEST_PARAMS[BUILDERS[name][2]], params)


class PropensityModel(Estimator):
    """Features, class weights and classifier as one estimator.

    Everything that is learned, the encoders included, is learned inside
    `fit`, so cross-validation never leaks from the held-out fold.
    """

    settings = Param(
        Params._dummy(), "settings", "model parameters to override"
    )

    @keyword_only
    def __init__(self, *, name=None, spec=None, settings=None, seed=SEED):
        """Name one of `MODEL_NAMES`; settings override its parameters."""
        super().__init__()
        model_params(name, settings)
        self.name = name
        self.spec = spec
        self.seed = seed
        self.slots: list[str] = []
        self._set(settings=settings or {})

    def feature_stages(self, df: DataFrame) -> FeatureStages:
        """Fit the feature stages on the training rows."""
        build = BUILDERS[self.name][0]
        return build(df, self.spec)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        p = model_params(self.name, self.getOrDefault(self.settings))
        target = self.spec.target
        known = dataset
        if p.get("early_stopping_rounds") and "validation_col" in p:
            # nothing is learned from the held-out rows
            known = dataset.where(~F.col(p["validation_col"]))
        features = self.feature_stages(known)
        sizes = class_sizes(known, target)
        if self.name == "logreg" or p.get("class_weight") == "balanced":
            weights = balanced_weights(sizes)
        else:
            weights = {0: 1.0, 1: float(p.get("scale_pos_weight", 1.0))}
        if known is dataset:
            prepared = features.train(dataset)
        else:
            prepared = features.train(known).unionByName(
                features.transform(dataset.where(F.col(p["validation_col"]))),
                allowMissingColumns=True,
            )
        extra = [p["validation_col"]] if "validation_col" in p else []
        # the learners cache their own form of the rows; a second copy here
        # would only take memory from them
        ready = prepared.select(
            FEATURES,
            F.col(target).cast("double").alias(LABEL),
            _weight_of(weights, target).alias(WEIGHT),
            *extra,
        )
        # balanced weights add up to the number of rows
        estimator = BUILDERS[self.name][1](
            p, float(sum(sizes.values())), features.bins, self.seed
        )
        rounds = p.get("early_stopping_rounds")
        if rounds:
            if not extra:
                raise ValueError("early stopping needs a validation_col")
            held_out = F.col(extra[0])
            model, curve = fit_with_patience(
                estimator,
                ready.where(~held_out),
                ready.where(held_out),
                rounds,
            )
        else:
            model, curve = estimator.fit(ready), None
        fitted = PipelineModel([*features.stages, model])
        fitted.slots = features.names
        fitted.curve = curve
        self.slots = features.names
        return fitted

    def copy(self, extra=None):
        """Copy with parameter overrides (used by cross-validation)."""
        that = super().copy(extra)
        that.name, that.spec, that.seed = self.name, self.spec, self.seed
        return that
