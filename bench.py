"""Time the headline queries and print one JSON line.

Each query is run to the end with every column, without collecting rows: once to warm up, then
the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recordflow import TUNING  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = (
    "premium_by_vehicle",
    "valid_split_counts",
    "valid_rows",
    "reject_rows",
    "reject_breakdown",
    "quality_summary",
    "duplicate_percentage",
    "step_add_fields",
    "field_hash_sha256",
    "field_lookup_large",
    "dedupe_subset",
    "dedupe_any",
    "join_inner",
    "join_left",
    "join_full",
    "join_semi",
    "join_condition",
    "union_distinct",
    "agg_all",
    "agg_lineitem",
    "pivot_sum",
    "win_row_number",
    "win_rank",
    "win_lag",
    "run_stats_by_spec",
    "stage_detail",
    "recent_errors",
    "text_search",
    "sink_partitioned",
    "flow_archive",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("recordflow-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in TUNING.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    seconds = {}
    for name in names:
        best = None
        for attempt in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
            if attempt:
                best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 4)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
