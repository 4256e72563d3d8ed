"""Windows, metadata lookup and change-feed queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.operators.cdc import cdc_enrich, cdc_enrich_in_order, fold_cdc
from obslake.operators.enrich import enrich_with_metadata
from obslake.operators.ingest import decode_cdc
from obslake.operators.windows import merge_aggregates, window_aggregate
from obslake.plans import views
from obslake.plans.compose import enriched_windows
from obslake.plans.registry import (
    DAY, HOUR, MINUTE, aggregate_output, aggregate_output_sql, aggregate_sql, query,
)
from obslake.plans.views import SQL, with_sql
from obslake.schemas import METADATA
from obslake.session import cut_lineage

SQL["windows_1m"] = aggregate_sql("metrics", MINUTE)
SQL["windows_1h"] = aggregate_sql("metrics", HOUR)
SQL["sales_1d"] = aggregate_sql("sales_metrics", DAY)
_LAST = "arg_max(struct_pack(s := service_name, e := environment), (timestamp_ms, arrival)) AS last,"
SQL["labelled_1m"] = aggregate_sql("labelled_metrics", MINUTE, _LAST)
SQL["labelled_7d"] = aggregate_sql("labelled_metrics", 7 * DAY, _LAST)


@query("window_aggregate_1m", with_sql("metrics", "windows_1m", body=aggregate_output_sql("windows_1m")))
def window_aggregate_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_output(window_aggregate(views.metrics(spark, sf_dir)))


@query("window_aggregate_1d_sales", with_sql("sales_metrics", "sales_1d", body=aggregate_output_sql("sales_1d")))
def window_aggregate_1d_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_output(window_aggregate(views.sales_metrics(spark, sf_dir), "1 day"))


@query(
    "window_aggregate_last_metadata",
    with_sql(
        "labelled_metrics", "labelled_7d",
        body=aggregate_output_sql("labelled_7d", "last.s AS service_name", "last.e AS environment"),
    ),
)
def window_aggregate_last_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = window_aggregate(views.labelled_metrics(spark, sf_dir), "7 days", order_by=("arrival",))
    return aggregate_output(rows, "service_name", "environment")


@query(
    "merge_aggregates_7d",
    with_sql("labelled_metrics", "labelled_1m", body=aggregate_output_sql(f"""(
SELECT metric_name, service_id,
       arg_min(last.s, window_start_ms) FILTER (last.s IS NOT NULL) AS service_name,
       arg_min(last.e, window_start_ms) FILTER (last.e IS NOT NULL) AS environment,
       sum(sum_value) AS sum_value, min(min_value) AS min_value, max(max_value) AS max_value,
       CAST(sum(count_value) AS BIGINT) AS count_value, sum(sum_value) / sum(count_value) AS avg_value,
       window_start_ms // {7 * DAY} * {7 * DAY} AS window_start_ms,
       window_start_ms // {7 * DAY} * {7 * DAY} + {7 * DAY} AS window_end_ms
FROM labelled_1m GROUP BY metric_name, service_id, window_start_ms // {7 * DAY})""", "service_name", "environment")),
)
def merge_aggregates_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = window_aggregate(views.labelled_metrics(spark, sf_dir), order_by=("arrival",))
    return aggregate_output(merge_aggregates(minutes, "7 days"), "service_name", "environment")


SQL["enriched"] = """
SELECT m.metric_name, m.value, m.service_id, m.timestamp_ms, m.arrival,
       CASE WHEN s.service_id IS NULL THEN 'Unknown Service' ELSE s.service_name END AS service_name,
       CASE WHEN s.service_id IS NULL THEN 'unknown' ELSE s.team END AS team,
       CASE WHEN s.service_id IS NULL THEN 'unknown' ELSE s.environment END AS environment,
       CASE WHEN s.service_id IS NULL THEN 'unknown' ELSE s.region END AS region
FROM metrics m LEFT JOIN service_metadata s ON m.service_id = s.service_id"""
_ENRICHED = ["metric_name", "value", "service_id", "timestamp_ms", "arrival", *METADATA]
_ENRICHED_SQL = with_sql("metrics", "service_metadata", "enriched", body="SELECT * FROM enriched")


@query("enrich_metadata", _ENRICHED_SQL)
def enrich_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_with_metadata(
        views.metrics(spark, sf_dir), views.service_metadata(spark, sf_dir)
    ).select(*_ENRICHED)


@query("enrich_metadata_shuffled", _ENRICHED_SQL)
def enrich_metadata_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join used for lookup tables too large to broadcast."""
    return enrich_with_metadata(
        views.metrics(spark, sf_dir), views.service_metadata(spark, sf_dir), limit_bytes=-1
    ).select(*_ENRICHED)


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_cdc(views.cdc_changes(spark, sf_dir), ["timestamp_ms", "seq"])


@query("fold_cdc", with_sql("cdc_changes", "cdc_snapshot", body="SELECT * FROM cdc_snapshot"))
def fold_cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir)


@query("decode_cdc", with_sql("cdc_changes", body="""
SELECT coalesce(op, 'c') AS op, service_id, service_name, team, environment, region FROM cdc_changes"""))
def decode_cdc_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_cdc(views.cdc_json(spark, sf_dir)).drop("key")


@query(
    "cdc_enrich",
    with_sql("metrics", "service_metadata", "enriched", "cdc_changes", "cdc_snapshot", body="""
SELECT e.metric_name, e.value, e.service_id, e.timestamp_ms, e.arrival,
       coalesce(c.service_name, e.service_name) AS service_name, coalesce(c.team, e.team) AS team,
       coalesce(c.environment, e.environment) AS environment, coalesce(c.region, e.region) AS region
FROM enriched e LEFT JOIN cdc_snapshot c ON e.service_id = c.service_id"""),
)
def cdc_enrich_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = cut_lineage(_snapshot(spark, sf_dir))
    return cdc_enrich(enrich_metadata(spark, sf_dir), snapshot)


@query(
    "cdc_enrich_in_order",
    with_sql("sales_metrics", "cdc_changes", body="""
, last_changes AS (
  SELECT service_id, timestamp_ms, arg_max(struct_pack(
           op := op, service_name := service_name, team := team, environment := environment), seq) AS c
  FROM cdc_changes GROUP BY service_id, timestamp_ms)
SELECT m.metric_name, m.value, m.service_id, m.timestamp_ms,
       CASE WHEN coalesce(l.c.op, '') <> 'd' THEN l.c.service_name END AS service_name,
       coalesce(CASE WHEN coalesce(l.c.op, '') <> 'd' THEN l.c.team END, 'none') AS team,
       CASE WHEN coalesce(l.c.op, '') <> 'd' THEN l.c.environment END AS environment
FROM sales_metrics m ASOF LEFT JOIN last_changes l
  ON m.service_id = l.service_id AND m.timestamp_ms >= l.timestamp_ms"""),
)
def cdc_enrich_at_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lit(None).cast("string")
    rows = views.sales_metrics(spark, sf_dir).select(
        "*", text.alias("service_name"), F.lit("none").alias("team"), text.alias("environment")
    )
    return cdc_enrich_in_order(rows, views.cdc_changes(spark, sf_dir), "timestamp_ms", ["seq"])


@query(
    "enriched_windows",
    with_sql("metrics", "service_metadata", "enriched", "cdc_changes", "cdc_snapshot", body=f"""
SELECT * FROM ({aggregate_output_sql('''(
  SELECT metric_name, service_id, any_value(service_name) AS service_name, any_value(environment) AS environment,
         sum(value) AS sum_value, min(value) AS min_value, max(value) AS max_value,
         count(value) AS count_value, sum(value) / count(value) AS avg_value,
         timestamp_ms // 60000 * 60000 AS window_start_ms,
         timestamp_ms // 60000 * 60000 + 60000 AS window_end_ms
  FROM (SELECT e.metric_name, e.value, e.service_id, e.timestamp_ms,
               coalesce(c.service_name, e.service_name) AS service_name,
               coalesce(c.environment, e.environment) AS environment
        FROM enriched e LEFT JOIN cdc_snapshot c ON e.service_id = c.service_id)
  GROUP BY metric_name, service_id, timestamp_ms // 60000)''', "service_name", "environment")})"""),
)
def enriched_windows_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enriched_windows(
        views.metrics(spark, sf_dir),
        views.service_metadata(spark, sf_dir),
        cut_lineage(_snapshot(spark, sf_dir)),
    )
    return aggregate_output(rows, "service_name", "environment")
