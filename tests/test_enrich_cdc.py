import json

import pytest
from pyspark.sql import functions as F

from obslake.operators.cdc import cdc_enrich, cdc_enrich_in_order, fold_cdc
from obslake.operators.dimension import hot_keys, measured_bytes, with_salt
from obslake.operators.enrich import enrich_with_metadata, union_normalized
from obslake.operators.ingest import decode_cdc
from obslake.plans.compose import enriched_windows
from obslake.operators.windows import window_aggregate
from obslake.sources.tables import seed_metadata
from tests.conftest import plan_of

EVENT = "metric_name string, value double, unit string, service_id string, tags map<string,string>, timestamp timestamp"
CHANGE = "op string, service_id string, service_name string, team string, environment string, region string, seq long"
META = "service_id string, service_name string, team string, environment string, region string"


def events(spark, *services):
    df = spark.createDataFrame([("m", 1.0, "count", s, None, None) for s in services], EVENT)
    return df.withColumn("timestamp", F.timestamp_millis(F.lit(1705314600123)))


@pytest.mark.parametrize("limit, rows", [(1 << 20, 10), (-1, 10), (-1, 1)])
def test_lookup_defaults_and_nulls(spark, limit, rows):
    meta = seed_metadata(spark).unionByName(
        spark.createDataFrame([("svc-null", "No Team", None, None, None)], META)
    )
    df = enrich_with_metadata(events(spark, "svc-api", "svc-api", "nobody", "svc-null", None), meta, limit_bytes=limit, rows_per_task=rows)
    found = df.collect()
    rows = {r.service_id: r for r in found}
    assert (len(found), len(rows)) == (5, 4)
    got = lambda s: (rows[s].service_name, rows[s].team, rows[s].environment, rows[s].region)
    assert got("svc-api") == ("API Service", "platform", "production", "us-east-1")
    assert got("nobody") == ("Unknown Service", "unknown", "unknown", "unknown")
    assert got(None) == ("Unknown Service", "unknown", "unknown", "unknown")
    assert got("svc-null") == ("No Team", None, None, None)
    assert rows["svc-api"].timestamp_ms == 1705314600123


def test_broadcast_only_below_the_limit(spark):
    meta = seed_metadata(spark)
    assert 0 < measured_bytes(meta) < 2000
    small = plan_of(enrich_with_metadata(events(spark, "a"), meta))
    assert "BroadcastHashJoin" in small
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan_of(enrich_with_metadata(events(spark, "a"), meta, limit_bytes=10))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in large and "_salt" in large


def test_hot_keys_get_one_salt_per_share_of_rows(spark):
    df = spark.range(100).select(F.when(F.col("id") < 90, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
    hot = hot_keys(df, "k", rows_per_task=20)
    assert [tuple(r) for r in hot.collect()] == [("hot", 5)]
    salted = with_salt(df.unionByName(df.withColumn("k", F.lit(None).cast("string"))), "k", hot, ["id"])
    per_key = {r.k: r.n for r in salted.groupBy("k").agg(F.countDistinct("_salt").alias("n")).collect()}
    assert per_key["hot"] == 5 and per_key[None] > 50 and per_key["k95"] == 1
    assert hot_keys(df, "k", rows_per_task=1000) is None


def test_missing_timestamp_becomes_now(spark):
    df = enrich_with_metadata(events(spark, "a").withColumn("timestamp", F.lit(None).cast("timestamp")), seed_metadata(spark))
    assert df.select((F.unix_millis(F.current_timestamp()) - F.col("timestamp_ms")).alias("age")).first().age == 0


def test_union_fills_absent_columns(spark):
    both = union_normalized(events(spark, "a"), events(spark, "b").withColumn("parsed_level", F.lit("INFO")))
    assert {(r.service_id, r.parsed_level) for r in both.collect()} == {("a", None), ("b", "INFO")}


def changes(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], CHANGE)


def test_fold(spark):
    df = changes(
        spark,
        ("c", "a", "A1", "t", "prod", "r"),
        ("u", "a", "A2", None, None, None),
        ("c", "b", "B", "t", "prod", "r"),
        ("D", "b", None, None, None, None),
        ("c", "c", "C1", "t", None, None),
        ("d", "c", None, None, None, None),
        (None, "c", "C2", None, None, None),
        ("c", None, "X", None, None, None),
        ("c", "  ", "X", None, None, None),
    )
    rows = {r.service_id: tuple(r)[1:] for r in fold_cdc(df, ["seq"]).collect()}
    assert rows == {"a": ("A2", None, None, None), "c": ("C2", None, None, None)}


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_override_only_with_non_null(spark, limit):
    metrics = enrich_with_metadata(events(spark, "svc-api", "svc-worker", None), seed_metadata(spark))
    snapshot = spark.createDataFrame([("svc-api", "New", None, "canary", None)], META)
    out = cdc_enrich(metrics, snapshot, limit_bytes=limit)
    rows = {r.service_id: r for r in out.collect()}
    api = rows["svc-api"]
    assert (api.service_name, api.team, api.environment, api.region) == ("New", "platform", "canary", "us-east-1")
    assert rows["svc-worker"].service_name == "Worker Service" and rows[None].service_name == "Unknown Service"
    assert out.columns == metrics.columns


@pytest.mark.parametrize("rows_per_task", [1, 2, 100])
def test_override_in_arrival_order(spark, rows_per_task):
    metrics = spark.createDataFrame(
        [("s", "orig", "t0", t, float(t)) for t in (1, 2, 3, 4, 5, 6)] + [(None, "orig", "t0", 3, 0.0)],
        "service_id string, service_name string, team string, at long, value double",
    )
    feed = spark.createDataFrame(
        [("c", "s", "v1", None, 2, 1), ("u", "s", "v2", "t2", 4, 2), ("u", "s", "v3", "t3", 4, 3), ("d", "s", None, None, 6, 4)],
        "op string, service_id string, service_name string, team string, at long, seq long",
    )
    out = cdc_enrich_in_order(metrics, feed, "at", ["seq"], rows_per_task=rows_per_task)
    got = {(r.service_id, r.at): (r.service_name, r.team) for r in out.collect()}
    assert got == {
        ("s", 1): ("orig", "t0"), ("s", 2): ("v1", "t0"), ("s", 3): ("v1", "t0"), ("s", 4): ("v3", "t3"),
        ("s", 5): ("v3", "t3"), ("s", 6): ("orig", "t0"), (None, 3): ("orig", "t0"),
    }
    earlier = spark.createDataFrame(
        [("r", "s", "before", None, None, None)],
        "op string, service_id string, service_name string, team string, at long, seq long",
    )
    first = cdc_enrich_in_order(metrics, feed.unionByName(earlier), "at", ["seq"], rows_per_task=rows_per_task).filter("at = 1")
    assert first.first().service_name == "before"


def test_decode_both_feed_shapes(spark):
    row = {"service_id": "s", "service_name": "N", "team": None, "environment": "e", "region": "r"}
    texts = [
        json.dumps({"op": "u", "serviceId": "s", "serviceName": "N", "environment": "e", "region": "r", "extra": 1}),
        json.dumps({"op": "c", "before": None, "after": row}),
        json.dumps({"payload": {"op": "d", "before": row, "after": None}}),
        "not json",
        None,
    ]
    out = decode_cdc(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq long"))
    rows = {r.seq: (r.op, r.service_id, r.service_name, r.team, r.environment, r.region) for r in out.collect()}
    assert rows == {i: (op, "s", "N", None, "e", "r") for i, op in enumerate("ucd")}


def test_aggregating_first_equals_enriching_first(spark):
    df = events(spark, "svc-api", "svc-api", "nobody")
    snapshot = spark.createDataFrame([("svc-api", "New", None, "canary", None)], META)
    early = window_aggregate(cdc_enrich(enrich_with_metadata(df, seed_metadata(spark)), snapshot))
    late = enriched_windows(df.withColumn("timestamp_ms", F.unix_millis("timestamp")), seed_metadata(spark), snapshot)
    assert sorted(early.collect()) == sorted(late.select(*early.columns).collect())
