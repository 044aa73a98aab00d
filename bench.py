"""Time the headline queries once each, after a short warm-up; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from rowharbor.plans.catalogue import QUERIES

HEADLINE = [
    "scan_csv_roundtrip",
    "scan_multiline_text",
    "scan_multiline_split",
    "record_numbers",
    "cast_with_errors",
    "upsert_full",
    "upsert_few",
    "delete_ids",
    "last_write_wins_lines",
    "delta_keyed",
    "apply_delta",
    "delta_multiset",
    "publish_file_upsert",
    "replace_by_changes",
    "grouped_view",
    "column_statistics_quick",
    "check_columns",
    "match_columns",
    "update_metadata",
    "stage_durations",
    "commit_state",
    "replace_layers",
    "ingest_files",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rowharbor-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no stack per expression
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["grouped_view"](spark, sf_dir).collect()  # starts the session's machinery
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
