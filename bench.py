"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder with the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feature_minmax_l2", "vector_keep_scale_normalize", "pca_project", "summary_stats", "missing_profile",
    "drop_missing", "tolerant_cast", "csv_roundtrip", "csv_sniff", "idempotent_pending", "random_split",
    "stratified_split", "holdout_split", "within_threshold", "confusion_matrix", "roc_points", "chart_histogram",
    "chart_box", "chart_line", "linreg_score", "dt_score", "rf_score", "gbt_score", "cv_grid", "leaderboard",
    "train_and_score_all", "embedding_classifier", "batch_classification", "top_class", "image_preprocess",
    "image_features",
]
# Minutes long at full settings, so that the start of the JVM does not show: no untimed pass.
LONG = {"gbt_score", "leaderboard"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from terrasift.plans.catalog import QUERIES
    from terrasift.session import build_session, clear_scratch

    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                          checkpoint_dir=tempfile.mkdtemp(prefix="bench-"), extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    names = [name for name in HEADLINE if not only or name in only]
    # One untimed pass over small tables, where there are any, so that the
    # timings show the queries and not the start of the JVM and the workers.
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in [x for x in names if x not in LONG] if os.path.isdir(small) else []:
        QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}))


if __name__ == "__main__":
    main()
