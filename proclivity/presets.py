"""Ready-made settings for the default customer table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T

from proclivity.spec import TableSpec

# Column names, allowed values, age bands, thresholds and tuned
# parameters have to equal the published ones for equal results.
CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Age", T.ShortType()),
        T.StructField("Driving_License", T.ByteType()),
        # double, never float: 39.2 must compare equal to the marker
        T.StructField("Region_Code", T.DoubleType()),
        T.StructField("Previously_Insured", T.ByteType()),
        T.StructField("Vehicle_Age", T.StringType()),
        T.StructField("Vehicle_Damage", T.StringType()),
        T.StructField("Annual_Premium", T.DoubleType()),
        T.StructField("Policy_Sales_Channel", T.DoubleType()),
        T.StructField("Vintage", T.ShortType()),
        T.StructField("Response", T.ByteType()),
    ]
)

AGE_EDGES = (0, 29, 39, 49, 59, 200)
AGE_LABELS = ("20-29", "30-39", "40-49", "50-59", "60+")

CUSTOMER_SPEC = TableSpec(
    id="id",
    target="Response",
    high_card=("Region_Code", "Policy_Sales_Channel"),
    binary=(
        "Gender",
        "Vehicle_Damage",
        "Previously_Insured",
        "Driving_License",
    ),
    ordinal={"Vehicle_Age": ("< 1 Year", "1-2 Year", "> 2 Years")},
    robust=("Annual_Premium",),
    numeric=("Age", "Vintage"),
    allowed={
        "Gender": ("Female", "Male"),
        "Vehicle_Damage": ("No", "Yes"),
        "Vehicle_Age": ("< 1 Year", "1-2 Year", "> 2 Years"),
        "Driving_License": (0, 1),
        "Previously_Insured": (0, 1),
    },
    anomaly=("Region_Code", 39.2),
    profile_numeric=("Age", "Annual_Premium", "Vintage"),
    profile_categorical=(
        "Gender",
        "Vehicle_Age",
        "Vehicle_Damage",
        "Previously_Insured",
    ),
    slice_columns=("Gender", "Vehicle_Age"),
    slice_bands={"Age": (AGE_EDGES, AGE_LABELS)},
)

SAMPLE_FRACTION = 0.03
TEST_SIZE = 0.25
CV_FOLDS = 3
SEED = 42
THRESHOLD = 0.5
RARE_SHARE = 0.01

# Tuned parameters per model. The two boosting models differ in
# how they see the codes (plain codes, or codes with category meaning).
BEST_PARAMS: dict[str, dict[str, Any]] = {
    "logreg": {"C": 100, "l1_ratio": 0.1},
    "random_forest": {
        "n_estimators": 50,
        "max_depth": 10,
        "max_features": 0.5,
        "max_samples": 0.1,
        "min_samples_leaf": 50,
        "class_weight": "balanced",
    },
    "gbt": {
        "max_depth": 9,
        "learning_rate": 0.017023810747318804,
        "n_estimators": 753,
        "subsample": 0.9233625854586776,
        "colsample_bytree": 0.9398069633632562,
        "scale_pos_weight": 3.5183751581022755,
    },
    "gbt_categorical": {
        "n_estimators": 171,
        "learning_rate": 0.06439694378125348,
        "max_depth": 7,
        "subsample": 0.8,
        "scale_pos_weight": 2.966658829058813,
        "colsample_bytree": 0.5350507509284778,
        "max_bins": 202,
    },
}

# Grids of the exhaustive search.
PARAM_GRIDS: dict[str, dict[str, list[Any]]] = {
    "logreg": {
        "C": [0.001, 0.01, 0.1, 1, 10, 100],
        "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9],
    },
    "random_forest": {
        "n_estimators": [50],
        "max_depth": [8, 10],
        "min_samples_leaf": [50, 70],
        "max_features": ["sqrt", 0.5],
        "max_samples": [0.1, 0.2],
    },
    "gbt": {
        "n_estimators": [100, 200],
        "learning_rate": [0.05, 0.1],
        "max_depth": [5, 7],
        "scale_pos_weight": [3, 5],
    },
    "gbt_categorical": {
        "n_estimators": [100, 200],
        "learning_rate": [0.05, 0.1],
        "max_depth": [6, 8],
        "scale_pos_weight": [1, 3],
    },
}

# Ranges of the random search, as (kind, low, high).
SEARCH_RANGES: dict[str, dict[str, tuple[str, float, float]]] = {
    "logreg": {"C": ("log", 0.001, 100), "l1_ratio": ("uniform", 0, 1)},
    "random_forest": {
        "n_estimators": ("int", 50, 100),
        "max_depth": ("int", 5, 30),
        "max_features": ("uniform", 0.1, 0.9),
        "max_samples": ("uniform", 0.1, 0.5),
        "min_samples_leaf": ("intlog", 10, 100),
    },
    "gbt": {
        "max_depth": ("int", 3, 12),
        "learning_rate": ("log", 0.01, 0.3),
        "n_estimators": ("int", 100, 1000),
        "subsample": ("uniform", 0.5, 1.0),
        "colsample_bytree": ("uniform", 0.5, 1.0),
        "scale_pos_weight": ("uniform", 1, 20),
    },
    "gbt_categorical": {
        "n_estimators": ("int", 100, 200),
        "learning_rate": ("uniform", 0.05, 0.1),
        "max_depth": ("int", 6, 8),
        "scale_pos_weight": ("uniform", 1, 3),
        "colsample_bytree": ("uniform", 0.1, 1.0),
        "max_bins": ("int", 32, 255),
    },
}
