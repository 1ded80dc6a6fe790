"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   input folder (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_QUERIES  comma-separated keys (default: the headline set; ``all`` for all)

Each query runs once on the smallest input to compile, then once on the clock.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload import QUERIES  # noqa: E402

HEADLINE = [
    "pending_scan",
    "hash_keys",
    "valid_split",
    "left_enrich",
    "json_array_rows",
    "kv_string_agg",
    "eav_rollup",
    "eav_rollup_all",
    "eav_rollup_listkeys",
    "json_value",
    "json_prefix_split",
    "json_children",
    "mapped_select",
    "mapped_select_value",
    "expire_on_match",
    "expire_changed_hash",
    "insert_new_or_changed",
    "scd2_apply",
    "scd2_apply_always",
    "scd1_upsert",
    "latest_per_key",
    "mark_processed",
    "level_pivot",
    "level_update",
    "reversion_with_children",
    "customer_load",
    "account_structure_load",
    "product_configuration_load",
    "contacts_load",
    "mapped_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    keys = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("histflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Compile before the clock: each query once on the smallest input beside this one.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for key in keys if os.path.isdir(small) else []:
        QUERIES[key](spark, small).write.format("noop").mode("overwrite").save()

    seconds = {}
    for key in keys:
        started = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - started, 3)
        print(key, seconds[key], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
