"""Log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.operators.logs import extract_log_fields, log_to_metric, parse_log_metrics
from obslake.operators.enrich import enrich_with_metadata, union_normalized
from obslake.operators.windows import window_aggregate
from obslake.plans import metrics as _metrics  # noqa: F401  (defines the shared views)
from obslake.plans import views
from obslake.plans.registry import HOUR, aggregate_output, aggregate_output_sql, query
from obslake.plans.views import SQL, with_sql
from obslake.session import new_shared_path
from obslake.sinks.files import archive_raw_logs, write_logs_parquet
from obslake.sources.files import read_log_text

# The same pattern in the checker's regular-expression dialect.
_PATTERN = r"(\d{4}-\d{2}-\d{2}T[\d:.]+Z)\s+\[(\w+)\]\s+\[([^\]]+)\]\s+(.*)"
_GROUPS = "['timestamp', 'level', 'service_id', 'message']"
_TRIM = "trim(value, ' ' || chr(9) || chr(13) || chr(10))"

SQL["extracted"] = f"""
SELECT g.timestamp AS timestamp, g.level AS level, g.service_id AS service_id, g.message AS message,
       value AS raw_line, TRY_CAST(left(g.timestamp, 10) AS DATE) AS date
FROM (SELECT value, regexp_extract(value, '{_PATTERN}', {_GROUPS}) AS g FROM log_lines)
WHERE g.timestamp <> ''"""
# A fixed time for lines whose timestamp is no calendar date; jobs use the current time.
NOW_MS = 1_717_200_000_000
SQL["parsed"] = f"""
SELECT 'log.event' AS metric_name, 1.0::DOUBLE AS value, g.service_id AS service_id,
       upper(g.level) AS parsed_level, g.message AS log_message,
       coalesce(epoch_us(TRY_CAST(replace(g.timestamp, 'Z', '') AS TIMESTAMP)) // 1000, {NOW_MS}) AS timestamp_ms
FROM (SELECT value, regexp_extract({_TRIM}, '^(?:{_PATTERN})$', {_GROUPS}) AS g FROM log_lines)
WHERE g.timestamp <> ''"""
SQL["log_metrics"] = """
SELECT p.*,
       CASE WHEN s.service_id IS NULL THEN 'Unknown Service' ELSE s.service_name END AS service_name,
       CASE WHEN s.service_id IS NULL THEN 'unknown' ELSE s.team END AS team,
       CASE WHEN s.service_id IS NULL THEN 'unknown' ELSE s.environment END AS environment,
       CASE WHEN s.service_id IS NULL THEN 'unknown' ELSE s.region END AS region
FROM parsed p LEFT JOIN service_metadata s ON p.service_id = s.service_id"""

_EXTRACTED_SQL = with_sql("log_lines", "extracted", body="SELECT * FROM extracted")


@query("extract_log_fields", _EXTRACTED_SQL)
def extract_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_log_fields(views.log_lines(spark, sf_dir))


@query("archive_then_extract_logs", _EXTRACTED_SQL)
def archive_then_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines through the archive tree and the level/date table and back."""
    raw, structured = new_shared_path(spark, "logs-raw"), new_shared_path(spark, "logs")
    archive_raw_logs(views.log_lines(spark, sf_dir), raw)
    write_logs_parquet(extract_log_fields(read_log_text(spark, raw)), structured)
    columns = ["timestamp", "level", "service_id", "message", "raw_line", "date"]
    return spark.read.parquet(structured).select(*columns)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_log_metrics(views.log_lines(spark, sf_dir), now=F.timestamp_millis(F.lit(NOW_MS)))


@query("parse_log_metrics", with_sql("log_lines", "parsed", body="""
SELECT *, 'count' AS unit, service_id AS service_name, 'unknown' AS environment FROM parsed"""))
def parse_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select(
        "metric_name", "value", "service_id", "parsed_level", "log_message", "timestamp_ms",
        "unit", "service_name", "environment",
    )


_LOG_COLUMNS = [
    "metric_name", "value", "service_id", "parsed_level", "log_message",
    "service_name", "team", "environment", "region",
]


def _log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_to_metric(_parsed(spark, sf_dir), views.service_metadata(spark, sf_dir))


@query("log_to_metric", with_sql("log_lines", "service_metadata", "parsed", "log_metrics", body="SELECT * FROM log_metrics"))
def log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log_metrics(spark, sf_dir).select(*_LOG_COLUMNS, "timestamp_ms")


@query(
    "log_event_windows",
    with_sql("log_lines", "parsed", body=f"""
{aggregate_output_sql(f'''(SELECT metric_name, service_id, sum(value) AS sum_value, min(value) AS min_value,
   max(value) AS max_value, count(value) AS count_value, sum(value) / count(value) AS avg_value,
   timestamp_ms // {HOUR} * {HOUR} AS window_start_ms, timestamp_ms // {HOUR} * {HOUR} + {HOUR} AS window_end_ms
 FROM parsed GROUP BY metric_name, service_id, timestamp_ms // {HOUR})''')}"""),
)
def log_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parsed(spark, sf_dir).drop("service_name", "environment")
    return aggregate_output(window_aggregate(rows, "1 hour"))


@query(
    "union_normalized",
    with_sql("metrics", "service_metadata", "enriched", "log_lines", "parsed", "log_metrics", body="""
SELECT metric_name, value, service_id, timestamp_ms, service_name, team, environment, region,
       CAST(NULL AS VARCHAR) AS parsed_level, CAST(NULL AS VARCHAR) AS log_message FROM enriched
UNION ALL
SELECT metric_name, value, service_id, timestamp_ms, service_name, team, environment, region,
       parsed_level, log_message FROM log_metrics"""),
)
def union_all_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    structured = enrich_with_metadata(
        views.metrics(spark, sf_dir), views.service_metadata(spark, sf_dir)
    )
    rows = union_normalized(structured, _log_metrics(spark, sf_dir))
    return rows.select(
        "metric_name", "value", "service_id", "timestamp_ms",
        "service_name", "team", "environment", "region", "parsed_level", "log_message",
    )
