"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and once for the clock; its whole result is consumed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from panelloom.bindings import QUERIES
from panelloom.session import configure, intermediates

HEADLINE = [
    "annual_rollup", "next_year_target", "weighted_mean_fallback", "valid_key_semi_join", "pad_key_left_join",
    "share_family", "dominant_bridge", "area_weighted_rate", "zscore_in_group", "pct_rank_in_group",
    "group_quantiles", "event_rate_per_1k", "category_pivot", "panel_assembly", "temporal_split_summary",
    "cv_fold_summary", "column_profile", "corr_pairs", "corr_audit", "error_summary_by_model",
    "fit_metrics_by_model", "best_worst_examples", "ridge_fit_predict", "text_round_trip", "category_totals_long",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            with intermediates(spark):
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
