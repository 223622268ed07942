"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from proclivity.plans.queries import QUERIES
from proclivity.session import local_session

# one or more per topic; BENCH_QUERIES=all or a comma list picks others
HEADLINE = [
    "flagship",
    "data_gates",
    "drop_duplicates",
    "clean_audit",
    "stratified_sample",
    "stratified_split",
    "stratified_folds",
    "cut_batches",
    "describe_all",
    "pct_histogram",
    "quantile_cuts",
    "chi2_matrix",
    "near_duplicates",
    "map_back_share",
    "freq_encode",
    "encoded_features",
    "target_mean_oof",
    "score_linear_sql",
    "roc_auc_exact",
    "roc_auc_continuous",
    "slice_report",
    "threshold_sweep",
    "best_f1_threshold",
    "gains_table",
    "pr_auc",
    "bootstrap_ci",
    "numeric_profile",
    "drift_report",
    "batch_overview",
    "quality_gates",
    "registry_current",
    "cycle_status",
    "fit_logreg",
    "fit_random_forest",
    "fit_gbt",
    "fit_gbt_categorical",
    "score_batch",
    "retrain_cycle",
    "stream_drift",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    picked = os.environ.get("BENCH_QUERIES", "")
    names = HEADLINE
    if picked:
        names = list(QUERIES) if picked == "all" else picked.split(",")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    # start the engine once, so the first query is not charged for it
    QUERIES["class_balance"](spark, sf).collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        # every row is computed, none is sent to the driver
        QUERIES[name](spark, sf).write.format("noop").mode(
            "overwrite"
        ).save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
            }
        )
    )


if __name__ == "__main__":
    main()
