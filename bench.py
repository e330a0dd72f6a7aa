"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the table directory, BENCH_CPUS the number of threads. Each query runs
once to warm up and then three times to the end; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from barloom.catalog.queries import QUERIES

HEADLINE = [
    "monthly_overview_orders",
    "monthly_overview_lineitem",
    "monthly_overview_decimal",
    "monthly_overview_carry",
    "weekday_overview_orders",
    "change_both_bases_lineitem",
    "month_open_close",
    "month_open_close_newest",
    "bars_latest_wins",
    "bars_upsert",
    "refresh_changed_years",
    "clean_decimal_comma",
    "event_log_as_bars",
    "rows_of_successful_loads",
    "audit_runs_folded",
    "files_not_loaded",
    "bar_files_round_trip",
    "table_replace_slices",
    "load_and_refresh",
    "load_and_refresh_incremental",
    "lineitem_files_to_staging",
]
REPEATS = 3


def timed(function) -> float:
    start = time.perf_counter()
    function()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("barloom-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="barloom-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        def finish(query=QUERIES[name]):
            query(spark, directory).write.format("noop").mode("overwrite").save()

        finish()
        seconds[name] = round(statistics.median(timed(finish) for _ in range(REPEATS)), 3)
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
