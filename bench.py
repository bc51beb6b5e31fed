"""Time the headline queries and print one JSON line.

Results go to the no-op sink, so that every row and column is computed and nothing is
pulled to the driver.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from lastmile.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "traffic_profile", "clean_text", "parse_numeric", "drop_exact_duplicates", "clean_regression",
    "clean_eda", "missing_report", "value_counts", "numeric_summary", "outliers_iqr", "corr_matrix",
    "business_rules", "box_stats", "feat_logistics", "feat_precision", "feat_error_focused",
    "tercile_label", "rank_percent", "risk_score", "group_mean_encode", "split_stratified", "impute",
    "scale_standard", "reg_metrics_full", "tolerance_accuracy", "segment_metrics", "cls_metrics",
    "reg_linear_full", "reg_tree", "reg_knn",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lastmile-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        # Larger methods are not compiled by the JVM and run interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # start the executors
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
