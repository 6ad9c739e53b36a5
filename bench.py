"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from labelwright.plans import QUERIES
from labelwright.session import local_session
from labelwright.sources.scratch import discard

HEADLINE = (
    "noise_flip",
    "noise_sweep",
    "noise_transitions",
    "stratified_split",
    "stratified_folds",
    "feature_noise",
    "standardize",
    "knn_suspects",
    "knn_suspects_scaled",
    "detection_effectiveness",
    "classification_report",
    "roc_auc_continuous",
    "noise_level_curve",
    "robustness_metrics",
    "cv_summary",
    "class_histogram",
    "correlation_matrix",
    "check_class_variance",
    "train_random_forest",
    "train_logistic",
    "pca_projection",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    QUERIES["class_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        discard(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
