"""Stored aggregates: upsert, range queries, file listing and seed rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.jobs import rollup
from obslake.operators.serving import query_aggregates, query_series
from obslake.operators.windows import window_aggregate
from obslake.plans import metrics as _metrics  # noqa: F401  (defines the window views)
from obslake.plans import views
from obslake.plans.compose import enriched_windows
from obslake.plans.registry import HOUR, MINUTE, aggregate_output, aggregate_output_sql, aggregate_sql, query
from obslake.plans.views import SQL, with_sql
from obslake.session import new_shared_path
from obslake.sinks.aggregates import compact_aggregates, upsert_aggregates, write_aggregates_parquet
from obslake.sinks.topics import insert_if_absent
from obslake.sources.files import list_data_files
from obslake.sources.tables import read_aggregates, read_service_metadata

SALES = ("sales.A", "svc-7", datetime(1996, 1, 1), datetime(2000, 12, 31))
VIEWS = ("view", "svc-7", datetime(2024, 1, 5), datetime(2024, 1, 25))


def _where(metric: str, service: str, frm: datetime, to: datetime) -> str:
    return f"""WHERE metric_name = '{metric}' AND service_id = '{service}'
  AND window_start_ms >= epoch_ms(TIMESTAMP '{frm}') AND window_end_ms <= epoch_ms(TIMESTAMP '{to}')"""


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_aggregate(views.sales_metrics(spark, sf_dir), "1 day")


@query("query_aggregates", with_sql("sales_metrics", "sales_1d", body=f"""
SELECT metric_name, service_id, round(avg_value, 8) AS avg_value, min_value, max_value, count_value,
       window_start_ms, window_end_ms FROM sales_1d {_where(*SALES)} ORDER BY window_start_ms"""))
def range_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = query_aggregates(_daily(spark, sf_dir), *SALES)
    return found.select(
        "metric_name", "service_id", F.round("avg_value", 8).alias("avg_value"), "min_value", "max_value",
        "count_value", F.unix_millis("window_start").alias("window_start_ms"),
        F.unix_millis("window_end").alias("window_end_ms"),
    )


def _series_sql(source: str, request: tuple) -> str:
    return f"""
SELECT window_start_ms AS timestamp_ms, round(avg_value, 8) AS value FROM {source} {_where(*request)}
ORDER BY timestamp_ms"""


def _points(df: DataFrame) -> DataFrame:
    return df.select(F.unix_millis("timestamp").alias("timestamp_ms"), F.round("value", 8).alias("value"))


@query("query_series", with_sql("sales_metrics", "sales_1d", body=_series_sql("sales_1d", SALES)))
def range_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(query_series(_daily(spark, sf_dir), *SALES))


@query("query_series_stored", with_sql("metrics", "windows_1m", body=_series_sql("windows_1m", VIEWS)))
def range_series_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series from the partitioned table."""
    path = new_shared_path(spark, "aggregates")
    upsert_aggregates(window_aggregate(views.metrics(spark, sf_dir)), path)
    return _points(query_series(read_aggregates(spark, path, between=VIEWS[2:]), *VIEWS))


SQL["large_1m"] = aggregate_sql("(SELECT * FROM metrics WHERE value > 100)", MINUTE)


_UPSERTED = with_sql("metrics", "windows_1m", "large_1m", body=aggregate_output_sql("""(
SELECT * FROM large_1m UNION ALL
SELECT * FROM windows_1m a WHERE NOT EXISTS (SELECT 1 FROM large_1m b
  WHERE a.metric_name = b.metric_name AND a.service_id = b.service_id AND a.window_start_ms = b.window_start_ms))"""))


def _upserted_table(spark: SparkSession, sf_dir: str) -> str:
    path = new_shared_path(spark, "upserted")
    rows = views.metrics(spark, sf_dir)
    upsert_aggregates(window_aggregate(rows), path)
    upsert_aggregates(window_aggregate(rows.filter("value > 100")), path)
    return path


@query("upsert_aggregates", _UPSERTED)
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All minute windows, then a second set that replaces those it has in common."""
    return aggregate_output(read_aggregates(spark, _upserted_table(spark, sf_dir)))


@query("compact_aggregates", _UPSERTED)
def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table after its hours were brought down to one version each."""
    path = _upserted_table(spark, sf_dir)
    compact_aggregates(spark, path, keep_seconds=0)
    return aggregate_output(read_aggregates(spark, path))


_RANGE = ("view", "svc-7", datetime(2024, 1, 5, 22, 30), datetime(2024, 1, 24, 3, 15))


@query("query_aggregates_stored", _UPSERTED + f" {_where(*_RANGE)}")
def range_aggregates_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range that begins and ends within a day, from a table of several versions, some of them compacted."""
    path = new_shared_path(spark, "ranged")
    rows = views.metrics(spark, sf_dir)
    upsert_aggregates(window_aggregate(rows), path)
    compact_aggregates(spark, path, keep_seconds=0)
    upsert_aggregates(window_aggregate(rows.filter("value > 100")), path)
    table = read_aggregates(spark, path, between=_RANGE[2:])
    # The sum is not part of an answer; it is average times count.
    found = query_aggregates(table, *_RANGE).withColumn("sum_value", F.col("avg_value") * F.col("count_value"))
    return aggregate_output(found)


# The roll-up runs over the whole table, then again over some days whose minutes were replaced.
_AGAIN = (datetime(2024, 1, 10), datetime(2024, 1, 20))
_AGAIN_SQL = f"window_start_ms >= epoch_ms(TIMESTAMP '{_AGAIN[0]}') AND window_end_ms <= epoch_ms(TIMESTAMP '{_AGAIN[1]}')"
SQL["minutes_now"] = f"""
SELECT * FROM windows_1m WHERE NOT ({_AGAIN_SQL})
UNION ALL SELECT * FROM large_1m WHERE {_AGAIN_SQL}
UNION ALL SELECT * FROM windows_1m a WHERE {_AGAIN_SQL} AND NOT EXISTS (SELECT 1 FROM large_1m b
  WHERE a.metric_name = b.metric_name AND a.service_id = b.service_id AND a.window_start_ms = b.window_start_ms)"""
SQL["rolled_1h"] = f"""
SELECT metric_name, service_id, sum(sum_value) AS sum_value, min(min_value) AS min_value, max(max_value) AS max_value,
       CAST(sum(count_value) AS BIGINT) AS count_value, sum(sum_value) / sum(count_value) AS avg_value,
       window_start_ms // {HOUR} * {HOUR} AS window_start_ms, window_start_ms // {HOUR} * {HOUR} + {HOUR} AS window_end_ms
FROM minutes_now GROUP BY 1, 2, 8, 9"""


@query("rollup_stored", with_sql("metrics", "windows_1m", "large_1m", "minutes_now", "rolled_1h", body=aggregate_output_sql("rolled_1h")))
def rollup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored minutes rolled up to a stored table of hours, which a second run brings up to date in part."""
    minutes, hours = new_shared_path(spark, "minutes"), new_shared_path(spark, "hours")
    rows = views.metrics(spark, sf_dir)
    upsert_aggregates(window_aggregate(rows), minutes)
    rollup.run(spark, minutes, hours, datetime(2024, 1, 1), datetime(2025, 1, 1))
    upsert_aggregates(window_aggregate(rows.filter("value > 100")), minutes)
    rollup.run(spark, minutes, hours, *_AGAIN)
    return aggregate_output(read_aggregates(spark, hours))


def _copied(spark: SparkSession, sf_dir: str) -> str:
    path = new_shared_path(spark, "copy")
    rows = enriched_windows(
        views.metrics(spark, sf_dir), views.service_metadata(spark, sf_dir), window="1 hour"
    )
    write_aggregates_parquet(rows, path, batch_id=0)
    write_aggregates_parquet(rows, path, batch_id=0)
    return path


@query("aggregates_parquet", with_sql("metrics", "windows_1h", "service_metadata", body="""
SELECT environment, window_date, count(*) AS n_windows, CAST(sum(count_value) AS BIGINT) AS n_events FROM (
  SELECT w.count_value, CAST(make_timestamp(window_start_ms * 1000) AS DATE) AS window_date,
         CASE WHEN s.service_id IS NULL THEN 'unknown' ELSE s.environment END AS environment
  FROM windows_1h w LEFT JOIN service_metadata s ON w.service_id = s.service_id)
GROUP BY 1, 2"""))
def aggregates_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per directory of the Parquet copy after the same micro-batch was written twice."""
    return spark.read.parquet(_copied(spark, sf_dir)).groupBy("environment", "window_date").agg(
        F.count("*").alias("n_windows"), F.sum("count_value").alias("n_events")
    )


@query("list_data_files", with_sql("metrics", "service_metadata", body="""
SELECT DISTINCT 'environment=' || environment || '/window_date=' || day AS directory FROM (
  SELECT strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS day,
         CASE WHEN s.service_id IS NULL THEN 'unknown' ELSE s.environment END AS environment
  FROM metrics m LEFT JOIN service_metadata s ON m.service_id = s.service_id)
WHERE environment LIKE 'prod%'"""))
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directories of the files whose name starts with a text that ends inside a directory name."""
    files = list_data_files(spark, _copied(spark, sf_dir), "environment=prod")
    return files.select(F.substring_index("name", "/", 2).alias("directory")).distinct()


@query("insert_if_absent", with_sql("service_metadata", body="""
SELECT * FROM service_metadata UNION ALL
SELECT 'svc-' || c_custkey, c_name, c_mktsegment, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM customer
WHERE 'svc-' || c_custkey NOT IN (SELECT service_id FROM service_metadata)"""))
def seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers offered as services to a table that already holds the suppliers."""
    path = new_shared_path(spark, "metadata")
    text = F.lit(None).cast("string")
    offered = views.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("svc-"), F.col("c_custkey").cast("string")).alias("service_id"),
        F.col("c_name").alias("service_name"), F.col("c_mktsegment").alias("team"),
        text.alias("environment"), text.alias("region"),
    )
    insert_if_absent(views.service_metadata(spark, sf_dir), path, "service_id")
    insert_if_absent(offered, path, "service_id")
    return read_service_metadata(spark, path)
