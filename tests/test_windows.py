import math
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from obslake.operators.windows import merge_aggregates, window_aggregate
from tests.conftest import plan_of

SCHEMA = (
    "metric_name string, service_id string, service_name string, environment string, "
    "value double, timestamp_ms long, offset long"
)
T0 = 1705312800000  # 2024-01-15T10:00:00Z


def events(spark, values, metric="cpu.usage", service="svc-api", start=T0):
    rows = [(metric, service, "API Service", "production", float(v), start + i, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "values, expected",
    [
        ([75.0], (75.0, 75.0, 75.0, 1, 75.0)),
        ([10, 50, 90], (150.0, 10.0, 90.0, 3, 50.0)),
        ([200, 400, 600], (1200.0, 200.0, 600.0, 3, 400.0)),
        ([42.5], (42.5, 42.5, 42.5, 1, 42.5)),
        ([-5, -1, -3], (-9.0, -5.0, -1.0, 3, -3.0)),
    ],
)
def test_measures(spark, values, expected):
    row = window_aggregate(events(spark, values)).first()
    assert (row.sum_value, row.min_value, row.max_value, row.count_value, row.avg_value) == expected


def test_metadata_and_bounds(spark):
    df = spark.createDataFrame(
        [("network.bytes", "svc-edge", "Edge Service", "production", 1000.0, T0 + 59_999, 1)], SCHEMA
    )
    row = window_aggregate(df).select(
        "*", F.unix_millis("window_start").alias("s"), F.unix_millis("window_end").alias("e")
    ).first()
    assert (row.metric_name, row.service_id, row.service_name, row.environment) == (
        "network.bytes", "svc-edge", "Edge Service", "production",
    )
    assert (row.s, row.e) == (T0, T0 + 60_000)


def test_last_event_gives_the_metadata(spark):
    rows = [
        ("m", "s", "old", "a", 1.0, T0 + 5, 9),
        ("m", "s", "tie-1", "b", 1.0, T0 + 7, 1),
        ("m", "s", "tie-2", None, 1.0, T0 + 7, 2),
    ]
    row = window_aggregate(spark.createDataFrame(rows, SCHEMA), order_by=("offset",)).first()
    assert (row.service_name, row.environment, row.count_value) == ("tie-2", None, 3)


def test_null_service_is_a_group_of_its_own(spark):
    rows = [("m", None, None, None, 1.0, T0, 1), ("m", "null", None, None, 2.0, T0, 2)]
    assert window_aggregate(spark.createDataFrame(rows, SCHEMA)).count() == 2


def test_nan_spreads_to_all_measures(spark):
    row = window_aggregate(events(spark, [1.0, float("nan"), 3.0])).first()
    assert all(math.isnan(v) for v in (row.sum_value, row.min_value, row.max_value, row.avg_value))


def test_without_metadata_columns(spark):
    row = window_aggregate(events(spark, [1, 2]).drop("service_name", "environment")).first()
    assert (row.sum_value, row.service_name, row.environment) == (3.0, None, None)


def test_input_is_hashed_not_sorted(spark):
    """The two aggregations below the last shuffle, which see all events, are hash aggregations."""
    plan = plan_of(window_aggregate(events(spark, [1]), order_by=("offset",)))
    tree = plan.split("\n(1)")[0]
    kinds = re.findall(r"(\w+Aggregate)", tree)
    assert kinds[-2:] == ["HashAggregate", "HashAggregate"] and len(kinds) == 4


def test_merge_rolls_up(spark):
    df = events(spark, [10, 20]).unionByName(events(spark, [30, 40], start=T0 + 60_000))
    row = merge_aggregates(window_aggregate(df), "1 hour").first()
    assert (row.sum_value, row.min_value, row.max_value, row.count_value, row.avg_value) == (100, 10, 40, 4, 25)


AGG = (
    "metric_name string, service_id string, service_name string, environment string, sum_value double, "
    "min_value double, max_value double, count_value long, avg_value double, window_start timestamp, window_end timestamp"
)


def test_empty_rows_count_for_nothing(spark):
    at = lambda m: F.timestamp_millis(F.lit(T0 + m * 60_000))
    empty = ("m", "s", None, "prod", 0.0, 0.0, 0.0, 0, 0.0, None, None)
    full = ("m", "s", "Name", None, 12.0, 5.0, 7.0, 2, 6.0, None, None)
    build = lambda row, m: spark.createDataFrame([row], AGG).withColumns({"window_start": at(m), "window_end": at(m + 1)})
    both = merge_aggregates(build(empty, 0).unionByName(build(full, 1))).first()
    assert (both.min_value, both.max_value, both.count_value, both.avg_value) == (5.0, 7.0, 2, 6.0)
    assert (both.service_name, both.environment) == ("Name", "prod")
    none = merge_aggregates(build(empty, 0)).first()
    assert (none.sum_value, none.min_value, none.max_value, none.count_value, none.avg_value) == (0, 0, 0, 0, 0)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(-1000, 1000), st.integers(0, 7_199_999), st.sampled_from("ab"), st.booleans()),
        min_size=1, max_size=30,
    )
)
def test_merging_any_split_equals_one_pass(spark, points):
    rows = [("m", s, "n", "e", float(v), T0 + t, i, part) for i, (v, t, s, part) in enumerate(points)]
    df = spark.createDataFrame(rows, SCHEMA + ", part boolean")
    halves = [window_aggregate(df.filter(F.col("part") == p)) for p in (True, False)]
    merged = merge_aggregates(halves[0].unionByName(halves[1]), "1 hour")
    whole = window_aggregate(df, "1 hour")
    order = ["service_id", "window_start"]
    assert merged.orderBy(*order).collect() == whole.orderBy(*order).collect()
