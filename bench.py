"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query runs twice into a sink that discards rows; the better time counts, so that
code generation and class loading are left out. Loads and the stream write their tables.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = [
    "scan_csv",
    "scan_json_pages",
    "landing_incremental",
    "validate_full",
    "validate_incremental",
    "quarantine_full",
    "mark_duplicates_full",
    "mark_duplicates_incremental",
    "new_rows_anti_join",
    "existing_natural_keys",
    "daily_metrics",
    "top_category",
    "daily_account_summary",
    "run_metrics",
    "sink_full_load",
    "incremental_two_runs",
    "stream_ingest",
]
ROUNDS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txnmill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(ROUNDS):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        seconds[name] = round(best, 3)
        print(f"{name}: {best:.2f}s", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
