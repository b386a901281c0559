"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace

from pyspark.sql import SparkSession

from tracewarden import scan_lines
from tracewarden.queries import inputs
from tracewarden.queries.catalog import QUERIES

HEADLINE = [
    "parsed_timestamps",
    "text_log_lines",
    "gap_report",
    "gap_report_one_source",
    "gap_context_arrays",
    "error_burst_counts",
    "error_bursts",
    "hash_chain",
    "segmented_chain",
    "placement_scores",
    "timelines",
    "scan_summary",
    "file_scan_summary",
    "csv_report",
    "activity_periods",
]


def one_source_scan(spark, folder):
    """The whole scan of all events as a single source, spread over blocks."""
    config = replace(inputs.CONFIG, block_lines=5_000)
    return scan_lines(inputs.single_source_lines(spark, folder), config).summary


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: QUERIES[name] for name in HEADLINE} | {"one_source_scan": one_source_scan}
    QUERIES["gap_report"](spark, folder).write.format("noop").mode("overwrite").save()  # warm the session

    seconds = {}
    for name, query in runs.items():
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    lines = spark.read.parquet(f"{folder}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "log_lines": lines,
                "scan_lines_per_second": round(lines / seconds["scan_summary"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
