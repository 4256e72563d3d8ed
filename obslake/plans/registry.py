"""Named queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def aggregate_output(df: DataFrame, *metadata: str) -> DataFrame:
    """Window aggregates with rounded doubles and epoch-millisecond bounds."""
    return df.select(
        "metric_name",
        "service_id",
        *metadata,
        F.round("sum_value", 4).alias("sum_value"),
        "min_value",
        "max_value",
        "count_value",
        F.round("avg_value", 8).alias("avg_value"),
        F.unix_millis("window_start").alias("window_start_ms"),
        F.unix_millis("window_end").alias("window_end_ms"),
    )


MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


def aggregate_sql(source: str, width: int, extra: str = "") -> str:
    """Unrounded window aggregates of a metrics view."""
    return f"""
SELECT metric_name, service_id, {extra}
       sum(value) AS sum_value, min(value) AS min_value, max(value) AS max_value,
       count(value) AS count_value, sum(value) / count(value) AS avg_value,
       timestamp_ms // {width} * {width} AS window_start_ms,
       timestamp_ms // {width} * {width} + {width} AS window_end_ms
FROM {source} GROUP BY metric_name, service_id, timestamp_ms // {width}"""


def aggregate_output_sql(source: str, *metadata: str) -> str:
    columns = "".join(f"{m}, " for m in metadata)
    return f"""
SELECT metric_name, service_id, {columns}round(sum_value, 4) AS sum_value, min_value, max_value,
       count_value, round(avg_value, 8) AS avg_value, window_start_ms, window_end_ms
FROM {source}"""
