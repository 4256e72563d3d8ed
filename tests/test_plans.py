"""What the physical plans must look like."""

import re

from pyspark.sql import functions as F

from obslake.operators.ingest import decode_cdc, decode_metric_events, decode_normalized
from obslake.operators.logs import extract_log_fields, parse_log_metrics
from obslake.operators.windows import window_aggregate
from obslake.plans import views
from obslake.plans.catalog import QUERIES
from tests.conftest import plan_of


def test_text_is_parsed_once(spark):
    df = spark.createDataFrame([("x",)], "value string").repartition(1)
    for decoded in (*decode_metric_events(df), decode_normalized(df), decode_cdc(df)):
        assert plan_of(decoded).count("from_json(") == 1
    for parsed in (extract_log_fields(df), parse_log_metrics(df)):
        assert plan_of(parsed).count("regexp_extract(") == 1


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    plan = plan_of(QUERIES["window_aggregate_1d_sales"](spark, sf_dir))
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_suppkey", "l_extendedprice", "l_returnflag", "l_shipdate"}


def test_filters_reach_the_scan(spark, sf_dir):
    df = window_aggregate(views.metrics(spark, sf_dir).filter(F.col("metric_name") == "view"))
    assert "EqualTo(event_type,view)" in plan_of(df)


def test_no_python_in_the_plans(spark, sf_dir):
    """Batch queries stay in the JVM and never join without a key."""
    for name in ("enriched_windows", "cdc_enrich", "extract_log_fields", "decode_metric_events", "merge_aggregates_7d"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert not re.search(r"Python|MapInPandas|Cartesian|NestedLoop", plan)


def test_windows_shuffle_partial_rows_only(spark, sf_dir):
    plan = plan_of(QUERIES["enriched_windows"](spark, sf_dir))
    tree = plan.split("\n(1)")[0]
    assert len(re.findall(r"\bExchange\b", tree)) == 1
