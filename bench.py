"""Time the headline queries at ``$BENCH_SF_DIR``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from queries import registry  # noqa: E402
from sparkmine.session import local_session  # noqa: E402

HEADLINE = (
    "preprocess_default", "preprocess_outlier", "correlation", "histogram_30", "boxplot", "stratified_split",
    "pca_projection", "knn_euclidean", "radius_neighbors", "k_distance_percentiles", "kmeans_lloyd", "kmeans_sweep",
    "silhouette_rows", "calinski_harabasz", "davies_bouldin", "dbscan", "average_linkage", "envelope_scores",
    "local_outlier_factor", "isolation_forest", "mutual_information", "select_l1", "best_numeric_split", "tree_stump",
    "random_forest", "knn_classify_uniform", "linear_svm", "kernel_svm_rbf", "metric_summary", "auc", "multiclass_auc",
    "grid_search_knn", "random_search_svm",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    registry.QUERIES["profile"](spark, sf_dir).collect()  # start-up is not timed
    registry.QUERIES["nearest_centroid"](spark, sf_dir).count()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
