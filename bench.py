"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS
(timed runs per query; the median counts), BENCH_QUERIES (comma-separated names).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from obslake.plans.catalog import QUERIES
from obslake.session import SETTINGS

HEADLINE = [
    "window_aggregate_1m",
    "window_aggregate_1d_sales",
    "window_aggregate_last_metadata",
    "merge_aggregates_7d",
    "enrich_metadata",
    "fold_cdc",
    "cdc_enrich",
    "cdc_enrich_in_order",
    "enriched_windows",
    "extract_log_fields",
    "parse_log_metrics",
    "decode_metric_events",
    "external_flatten",
    "external_table",
    "query_series",
    "upsert_aggregates",
    "streaming_window_aggregate",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("obslake-bench")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session()
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    found = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
