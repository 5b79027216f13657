"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   directory of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     threads (default 8)
BENCH_REPEAT   timed runs of each query, the best counts (default 3)

A query is timed from building it to having computed every row and column of its result.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarmac.registry import QUERIES  # noqa: E402

HEADLINE = (
    "clean_flights",
    "cleaning_funnel",
    "quality_summary",
    "rows_by_month",
    "top_carriers",
    "top_origins",
    "carrier_airport_stats",
    "nested_carrier_report",
    "airport_month_bands",
    "top_causes",
    "top_causes_window",
    "nested_airport_report",
    "json_report_roundtrip",
    "csv_scan",
    "tolerant_parse",
    "csv_roundtrip",
    "exact_subset",
    "bernoulli_subset",
    "subset_ladder",
    "seeded_shuffle",
)


def timed(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tarmac-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(QUERIES["carrier_airport_stats"], spark, sf_dir)  # start-up is not a query's cost
    seconds = {name: round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(repeat)), 3) for name in HEADLINE}
    spark.stop()
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(match.group(1)) if match else None,
            }
        )
    )


if __name__ == "__main__":
    main()
