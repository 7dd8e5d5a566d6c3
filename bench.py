"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the local threads.
Each query's result is written to Spark's noop sink, after one untimed run of
a small query that warms the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.queries import QUERIES  # noqa: E402

HEADLINE = (
    "scan_csv",
    "csv_quoted_text",
    "csv_records_in_ranges",
    "enforce_schema",
    "lenient_casts",
    "cast_failures",
    "trim_strings",
    "dedup_by_key",
    "dedup_newest",
    "transform_chain",
    "null_profile",
    "duplicate_keys",
    "quality_report",
    "quality_gate",
    "orphan_rows",
    "reference_report",
    "file_manifest",
    "table_profile",
    "landing_metadata",
    "landed_rows",
    "landed_multiline",
    "landed_files",
    "metadata_violations",
    "duplicate_content",
    "publish_overwrite",
    "upsert_merge",
    "upsert_partitions",
    "silver_job",
    "incremental_landing",
    "incremental_merge",
    "incremental_unique",
    "incremental_orphans",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or HEADLINE
    QUERIES["dedup_by_key"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
