"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores.
Each query runs cold once, then warm; the warm time counts. Rows go to a sink
that reads all of them and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from isotherm.queries import tables as t  # noqa: E402
from isotherm.queries.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "daily_extremes",
    "daily_extremes_per_file",
    "csv_ingest",
    "tsv_ingest",
    "json_ingest",
    "xml_ingest",
    "mixed_ingest",
    "detect_by_content",
    "parse_notifications",
    "dead_letter_counts",
    "read_objects",
    "notification_ingest",
    "payload_files",
    "document_outcomes",
    "append_table",
    "dedupe_table",
    "latest_rows",
    "delimited_scan",
    "delimited_scan_outcomes",
]


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    scratch = tempfile.mkdtemp(prefix="isotherm-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("isotherm-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in only or HEADLINE:
        cold[name] = round(run(spark, name, sf_dir), 3)
        warm[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
    events = t.table(spark, sf_dir, "events").count()
    files = t.observations(spark, sf_dir).select("user_id", "part").distinct().count()
    rates = {
        name: {"observations_per_sec": round(events / warm[name]), "files_per_sec": round(files / warm[name])}
        for name in warm
        if name.endswith("_ingest")
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_warm_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "rates": rates,
                "cpus": cpus,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
