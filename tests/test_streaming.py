import datetime
import itertools
import json
import os
import random
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.serializers import CPickleSerializer
from pyspark.sql import functions as F

from obslake.operators.windows import window_aggregate
from obslake.plans.catalog import ORACLES, QUERIES
from obslake.schemas import METRIC_AGGREGATE
from obslake.session import PARTITIONS, STATE_STORE, rocksdb_state
from obslake.sinks.topics import print_user_events
from obslake.sources.tables import read_aggregates, seed_metadata
from obslake.sources.topics import read_topic
from obslake.streaming import cdc, flows
from obslake.streaming.cdc import apply_changes, latest_snapshot, start_cdc_snapshot
from obslake.streaming.ordered import BUCKETS, _in_order, cdc_enrich_stream

ONCE = {"availableNow": True}
T0 = 1705312800000
NORMALIZED = (
    "metric_name string, service_id string, service_name string, team string, environment string, "
    "region string, value double, timestamp_ms long, offset long"
)


_clock = itertools.count(1_700_000_000)


def put(path, name, *records):
    """One file of the stream; later files get later modification times."""
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in records))
    at = next(_clock)
    os.utime(f"{path}/{name}.json", (at, at))


def metric(value, at, offset=0, service="s", **more):
    return {"metric_name": "m", "service_id": service, "service_name": "orig", "environment": "e", "value": value, "timestamp_ms": T0 + at, "offset": offset, **more}


def stream(spark, path, schema=NORMALIZED):
    os.makedirs(path, exist_ok=True)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def drain(query):
    query.processAllAvailable()
    query.stop()


def windows(spark, name):
    rows = spark.sql(f"select *, unix_millis(window_start) - {T0} as at from {name}").collect()
    return sorted((r.at, r.sum_value, r.count_value, r.service_name) for r in rows)


def test_watermark_closes_windows_and_drops_late_events(spark, tmp_path):
    src = str(tmp_path / "in")
    query = (
        window_aggregate(stream(spark, src), order_by=("offset",))
        .writeStream.outputMode("append").format("memory").queryName("late")
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    )
    put(src, "1", metric(1.0, 1000, 1), metric(2.0, 1000, 2, service_name="last"))
    query.processAllAvailable()
    put(src, "2", metric(10.0, 64_999, 3))
    query.processAllAvailable()
    assert windows(spark, "late") == []
    put(src, "3", metric(4.0, 59_999, 4, service_name="kept"))
    query.processAllAvailable()
    put(src, "4", metric(20.0, 65_000, 5))
    query.processAllAvailable()
    assert windows(spark, "late") == [(0, 7.0, 3, "kept")]
    put(src, "5", metric(99.0, 59_999, 6))
    put(src, "6", metric(1.0, 300_000, 7))
    drain(query)
    assert windows(spark, "late") == [(0, 7.0, 3, "kept"), (60_000, 30.0, 2, "orig")]


def test_stream_equals_batch_without_late_events(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [metric(float(i), i * 9_000, i, service=f"s{i % 3}") for i in range(60)]
    for i in range(0, 60, 20):
        put(src, f"{i:03d}", *rows[i:i + 20])
    put(src, "999", metric(0.0, 10_000_000, 99, service="close"))
    out = str(tmp_path / "out")
    (
        window_aggregate(stream(spark, src), order_by=("offset",)).writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(**ONCE).start().awaitTermination()
    )
    order = ["service_id", "window_start"]
    got = spark.read.schema(METRIC_AGGREGATE).parquet(out).orderBy(*order).collect()
    batch = window_aggregate(spark.read.schema(NORMALIZED).json(src), order_by=("offset",))
    assert got == batch.filter("service_id <> 'close'").orderBy(*order).collect() and len(got) > 20


CHANGE = "op string, service_id string, service_name string, team string, environment string, region string, seq long"


def change(op, service, name, seq):
    return {"op": op, "service_id": service, "service_name": name, "seq": seq}


def test_snapshot_follows_the_feed(spark, tmp_path):
    src, path = str(tmp_path / "cdc"), str(tmp_path / "snap")
    assert latest_snapshot(spark, path).count() == 0
    put(src, "1", change("c", "a", "A1", 1), change("c", "b", "B1", 2))
    run = lambda: start_cdc_snapshot(stream(spark, src, CHANGE), path, str(tmp_path / "ck"), ["seq"], ONCE).awaitTermination()
    names = lambda: {r.service_id: r.service_name for r in latest_snapshot(spark, path).collect()}
    run()
    assert names() == {"a": "A1", "b": "B1"}
    put(src, "2", change("u", "a", "A2", 3), change("d", "b", None, 4))
    run()
    assert names() == {"a": "A2"}
    # The same micro-batch again gives the same version.
    apply_changes(spark.read.schema(CHANGE).json(f"{src}/2.json"), path, 1, ["seq"])
    assert names() == {"a": "A2"}


def test_aggregates_to_both_sinks_with_a_snapshot_read_per_batch(spark, tmp_path):
    src, snap, table, copy, ck = (str(tmp_path / n) for n in ("in", "snap", "table", "copy", "ck"))
    feed = lambda *rows: spark.createDataFrame([(o, s, n, None, None, None, q) for o, s, n, q in rows], CHANGE)
    run = lambda: flows.start_aggregates(
        stream(spark, src), table, copy, ck, snapshot=lambda: latest_snapshot(spark, snap), trigger=ONCE, order_by=("offset",)
    ).awaitTermination()
    names = lambda: [(r.service_name, r.sum_value) for r in read_aggregates(spark, table).orderBy("window_start").collect()]
    put(src, "1", metric(1.0, 0, 1), metric(2.0, 70_000, 2))
    run()
    assert names() == [("orig", 1.0)]
    apply_changes(feed(("c", "s", "renamed", 1)), snap, 0, ["seq"])
    put(src, "2", metric(3.0, 200_000, 3))
    run()
    assert names() == [("orig", 1.0), ("renamed", 2.0)]
    assert spark.read.parquet(copy).count() == 2


def topic(spark, path, *values, key=None):
    put(path, f"{len(os.listdir(path)) if os.path.isdir(path) else 0}", *[{"key": key, "value": v} for v in values])
    return read_topic(spark, "t", format="json", path=path)


def test_structured_and_log_metrics_reach_the_normalized_topic(spark, tmp_path):
    out = str(tmp_path / "normalized")
    sink = {"topic": "metrics.normalized", "format": "json", "path": out}
    lookup = lambda: seed_metadata(spark)
    good = json.dumps({"metricName": "cpu", "value": "5", "serviceId": "svc-api", "timestamp": "2024-01-15T10:30:00Z"})
    events = topic(spark, str(tmp_path / "a"), good, "{bad")
    flows.start_structured(events, lookup, sink, str(tmp_path / "ck1"), str(tmp_path / "rejects"), ONCE).awaitTermination()
    lines = topic(spark, str(tmp_path / "b"), "2024-01-15T10:31:00Z [warn] [svc-worker] slow", "noise")
    flows.start_log_metrics(lines, lookup, sink, str(tmp_path / "ck2"), ONCE).awaitTermination()
    assert spark.read.option("recursiveFileLookup", "true").json(str(tmp_path / "rejects")).first().raw_value == "{bad"
    found = flows.normalized_stream(read_topic(spark, "t", streaming=False, format="json", path=out)).orderBy("timestamp_ms").collect()
    assert [(r.metric_name, r.service_name, r.value, r.parsed_level) for r in found] == [
        ("cpu", "API Service", 5.0, None), ("log.event", "Worker Service", 1.0, "WARN"),
    ]


def test_metric_ingest(spark, tmp_path):
    bodies, out, bad = (str(tmp_path / n) for n in ("bodies", "out", "bad"))
    os.makedirs(bodies)
    good = '{"metricName":"m","value":2,"serviceId":"s","timestamp":5}'
    Path(bodies, "a.txt").write_text(f'[{good},7]\n[{good},{{"metricName":" ","serviceId":"s","timestamp":5}}]\n{good}\n')
    source = spark.readStream.text(bodies).withColumnRenamed("value", "body")
    sink = {"topic": "t", "format": "json", "path": out}
    flows.start_metric_ingest(source, sink, str(tmp_path / "ck"), bad, ONCE).awaitTermination()
    assert [json.loads(r.value)["metricName"] for r in spark.read.json(out).collect()] == ["m", "m"]
    reasons = sorted(r.reject_reason for r in spark.read.json(bad).collect())
    assert reasons == ["body is not a JSON array", "element is not an object", "metricName must not be blank"]


def test_archive_and_landing_streams(spark, tmp_path):
    logs, raw = str(tmp_path / "logs"), str(tmp_path / "raw")
    flows.start_log_archive(topic(spark, logs, "line one", " two "), raw, str(tmp_path / "ck1"), ONCE).awaitTermination()
    assert sorted(r.value for r in spark.read.text(raw).select("value").collect()) == [" two ", "line one"]
    ext, landed, bad = (str(tmp_path / n) for n in ("ext", "landed", "bad"))
    source = topic(spark, ext, '{"a":1}', "nope", key="api 1")
    for q in flows.start_external_landing(source, landed, str(tmp_path / "ck2"), bad, ONCE):
        q.awaitTermination()
    rows = spark.read.json(landed).collect()
    assert [(r._source_api, r._data.a, r.source) for r in rows] == [("api 1", 1, "api_1")]
    assert spark.read.json(bad).first().payload == "nope"


def test_user_event_lines(spark, tmp_path):
    schema = "user_id string, event_type string, service_id string, environment string, timestamp_ms long"
    src = str(tmp_path / "u")
    put(src, "1", {"user_id": "u", "event_type": "LOGIN", "service_id": "s", "environment": "p", "timestamp_ms": 1})
    drain(print_user_events(stream(spark, src, schema), "memory", "printed"))
    assert spark.table("printed").first().line == "[UserEvent] userId=u type=LOGIN service=s env=p ts=1"


def test_snapshot_versions_go_by_age(spark, tmp_path):
    path = str(tmp_path / "snap")
    rows = lambda n: spark.createDataFrame([("c", f"s{n}", "a", None, None, None, n)], CHANGE)
    versions = lambda kind: [v for v in os.listdir(f"{path}{kind}") if v.startswith("version=") or v.isdigit()]
    # One bucket: every version replaces the one before as a whole.
    for n in range(3):
        apply_changes(rows(n), path, n, ["seq"], buckets=1)
    assert len(versions("")) == len(versions("/pointers")) == 3
    apply_changes(rows(3), path, 3, ["seq"], keep_seconds=-1)
    # The newest two stay: one may be read, one was just written.
    assert len(versions("")) == len(versions("/pointers")) == 2
    assert latest_snapshot(spark, path).count() == 4


def test_snapshot_writes_only_buckets_that_change(spark, tmp_path):
    path = str(tmp_path / "snap")
    feed = lambda *rows: spark.createDataFrame([(o, s, n, None, None, None, q) for o, s, n, q in rows], CHANGE)
    names = lambda: {r.service_id: r.service_name for r in latest_snapshot(spark, path).collect()}
    written = lambda n: [b for b in os.listdir(f"{path}/version={n:020d}") if b.startswith("bucket=")]
    apply_changes(feed(*[("c", f"s{i}", "old", i) for i in range(200)], ("c", None, "x", 900), ("c", " ", "x", 901)), path, 0, ["seq"])
    assert len(written(0)) > 40 and len(names()) == 200
    apply_changes(feed(("u", "s7", "new", 300)), path, 1, ["seq"])
    assert len(written(1)) == 1 and names() == {f"s{i}": "new" if i == 7 else "old" for i in range(200)}
    # Nothing but rows without a service: no version.  All services of a bucket deleted: no folder.
    apply_changes(feed(("c", None, "x", 301)), path, 2, ["seq"])
    assert not os.path.exists(f"{path}/version={2:020d}")
    apply_changes(feed(*[("d", f"s{i}", None, 400 + i) for i in range(200)]), path, 3, ["seq"], keep_seconds=-1)
    assert written(3) == [] and names() == {}
    apply_changes(feed(("c", "s7", "again", 700)), path, 4, ["seq"], keep_seconds=-1)
    assert names() == {"s7": "again"}
    assert not os.path.exists(f"{path}/version={0:020d}")


def test_a_snapshot_version_that_stopped_is_written_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "snap")
    feed = lambda name: spark.createDataFrame([("c", "s", name, None, None, None, 1)], CHANGE)
    apply_changes(feed("first"), path, 0, ["seq"])
    with monkeypatch.context() as m:
        m.setattr(cdc, "write_whole", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            apply_changes(feed("second"), path, 1, ["seq"])
    assert [r.service_name for r in latest_snapshot(spark, path).collect()] == ["first"]
    apply_changes(feed("second"), path, 1, ["seq"])
    assert [r.service_name for r in latest_snapshot(spark, path).collect()] == ["second"]


def test_lookup_is_read_again_after_its_time(spark):
    reads = []

    def read():
        reads.append(1)
        return seed_metadata(spark)

    held = flows.refreshed(read, 3600)
    assert held() is held() and len(reads) == 1
    fresh = flows.refreshed(read, 0)
    assert fresh() is not fresh() and len(reads) == 3


ORDERED = "service_id string, team string, value double, tags map<string,string>, timestamp timestamp, timestamp_ms long, offset long"
FEED = "op string, service_id string, team string, timestamp_ms long, seq long"


def test_changes_in_arrival_order_over_restarts(spark, tmp_path):
    def event(at, value, service="a", offset=0):
        tags = {"x": "y"} if value != 3.0 else None
        return {"service_id": service, "team": "own", "value": value, "tags": tags, "timestamp": "2024-01-15T10:00:00.123456Z", "timestamp_ms": T0 + at, "offset": offset}

    def update(at, seq, team, op="u", service="a"):
        return {"op": op, "service_id": service, "team": team, "timestamp_ms": None if at is None else T0 + at, "seq": seq}

    src, feed, out, ck = (str(tmp_path / n) for n in ("in", "feed", "out", "ck"))

    def run():
        metrics, changes = (spark.readStream.schema(k).json(p) for k, p in ((ORDERED, src), (FEED, feed)))
        cdc_enrich_stream(metrics, changes, "timestamp_ms", "seq", "offset").writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", ck
        ).trigger(**ONCE).start().awaitTermination()
        rows = spark.read.schema(ORDERED).parquet(out).collect()
        assert all(r.tags == ({"x": "y"} if r.value != 3.0 else None) and r.timestamp.microsecond == 123456 for r in rows)
        return sorted((r.timestamp_ms - T0, r.value, r.team) for r in rows)

    # The watermark is 5000 after the first run; what comes after it waits, also at a service of its own.
    put(src, "1", event(10_000, 9.0), event(1000, 1.0), event(5001, 5.0), event(3000, 2.0), event(5000, 4.0), event(5000, 3.0, "b"))
    put(feed, "1", update(5000, 3, "C"), update(2000, 1, "A"), update(5000, 2, "B"), update(10_000, 9, None, "D"), update(None, 0, "early", "c", "b"), update(4000, 5, "x", "u", " "))
    first = [(1000, 1.0, "own"), (3000, 2.0, "A"), (5000, 3.0, "early"), (5000, 4.0, "C")]
    assert run() == first
    # Later than the watermark is late, on either stream; a service that is null passes unchanged.
    put(src, "2", event(5000, 4.5), event(20_000, 7.0), event(9000, 6.0, None))
    put(feed, "2", update(5000, 4, "late"), update(20_000, 10, "Z"))
    second = first + [(5001, 5.0, "C"), (9000, 6.0, "own"), (10_000, 9.0, "own")]
    assert run() == second
    put(src, "3", event(40_000, 8.0), event(20_000, 7.5, offset=1))
    put(feed, "3", update(40_000, 11, "Y"))
    assert run() == second + [(20_000, 7.0, "Z"), (20_000, 7.5, "Z")]


def test_changes_in_order_with_the_state_store_spark_begins_with(spark, tmp_path):
    """The query sets what its state needs, for its own streams; rows without a time follow the SQL."""
    day = lambda n: None if n is None else datetime.datetime(2024, 1, 1 + n)
    orders = [(1, 5, "P", 2, 300000.0), (2, 5, "O", 8, 1.0), (3, 5, "F", 14, 1.0), (4, 6, "P", None, 1.0), (5, None, "P", 1, 1.0), (6, 7, "O", 29, 1.0), (7, 5, "O", 8, 150000.0)]
    items = [(5, n, float(n)) for n in range(0, 30, 3)] + [(6, 20, 1.0), (7, 28, 2.0), (None, 9, 3.0), (5, None, 4.0)]
    spark.createDataFrame(
        [(k, c, s, day(d), p, "1-URGENT") for k, c, s, d, p in orders],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_totalprice double, o_orderpriority string",
    ).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        [(k, day(d), v, "N") for k, d, v in items], "l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double, l_returnflag string"
    ).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = spark.conf.get(STATE_STORE)
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(STATE_STORE, plain)
    try:
        got = QUERIES["streaming_cdc_in_order"](spark, str(tmp_path))
        assert spark.conf.get(STATE_STORE) == plain
    finally:
        spark.conf.set(STATE_STORE, before)
    con = duckdb.connect()
    for name in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(ORACLES["streaming_cdc_in_order"])
    columns = [d[0] for d in want.description]
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
    assert {r.service_name for r in got.collect()} == {None, "Release 1", "Release 7"}


def test_state_in_order_is_called_by_buckets_not_by_services(spark, tmp_path):
    """A timer, a list of what waits and a table of states serve all services of a bucket."""
    services, src, feed, out = 3000, str(tmp_path / "in"), str(tmp_path / "feed"), str(tmp_path / "out")
    put(src, "1", *[{"service_id": f"s{n}", "team": "own", "value": 1.0, "timestamp_ms": T0 + n % 7} for n in range(services)])
    put(feed, "1", *[{"op": "u", "service_id": f"s{n}", "team": f"t{n}", "timestamp_ms": T0, "seq": n} for n in range(0, services, 2)])
    put(src, "2", {"service_id": "s0", "value": 2.0, "timestamp_ms": T0 + 60_000})
    put(feed, "2", {"op": "d", "service_id": "s1", "timestamp_ms": T0 + 60_000})
    metrics, changes = (spark.readStream.schema(k).json(p) for k, p in ((ORDERED, src), (FEED, feed)))
    query = cdc_enrich_stream(metrics, changes, "timestamp_ms", "seq").writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "ck")
    ).trigger(**ONCE).start()
    query.awaitTermination()
    timers = [p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress]
    assert 0 < max(timers) <= BUCKETS < services
    rows = spark.read.schema(ORDERED).parquet(out).collect()
    assert {r.service_id: r.team for r in rows} == {f"s{n}": "own" if n % 2 else f"t{n}" for n in range(services)}
    assert len(rows) == services


def test_a_new_stream_may_have_fewer_parts_of_its_state(spark):
    before = spark.conf.get(PARTITIONS)
    for asked, got in ((2, "2"), (10_000, before), (None, before)):
        with pytest.raises(KeyError), rocksdb_state(spark, asked):
            assert spark.conf.get(PARTITIONS) == got
            raise KeyError
        assert spark.conf.get(PARTITIONS) == before


def test_services_of_one_bucket_keep_apart(spark, tmp_path):
    """Random rows over several runs against a plain loop, with hardly any buckets."""
    rnd, runs, events, updates, seen = random.Random(4), 4, [], [], set()
    for n in range(600):
        at = rnd.randrange(80) * 500
        service = rnd.choice(["a", "b", "b\tc", 'd"', "", " ", "é", None])
        if n % 3:
            events.append({"service_id": service, "team": "own", "value": float(n), "timestamp_ms": T0 + at, "offset": n})
        else:
            op, team = rnd.choice("cudD"), rnd.choice(["x\ty", "z", None])
            updates.append({"op": op, "service_id": service, "team": team, "timestamp_ms": T0 + at, "seq": n if (service, at) in seen else None})
            seen.add((service, at))
    # Each run is one of equal time spans; the last row of both lets all others pass.
    events.append({"service_id": "a", "team": "own", "value": -1.0, "timestamp_ms": T0 + 90_000, "offset": 0})
    updates.append({"op": "u", "service_id": "a", "team": "end", "timestamp_ms": T0 + 90_000, "seq": 0})
    src, feed, out, ck = (str(tmp_path / n) for n in ("in", "feed", "out", "ck"))
    for run in range(runs):
        for rows, folder in ((events, src), (updates, feed)):
            put(folder, str(run), *[r for r in rows if min(runs - 1, (r["timestamp_ms"] - T0) // 10_000) == run])
        metrics, changes = (spark.readStream.schema(k).json(p) for k, p in ((ORDERED, src), (FEED, feed)))
        cdc_enrich_stream(metrics, changes, "timestamp_ms", "seq", "offset", buckets=2).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", ck
        ).trigger(**ONCE).start().awaitTermination()
    want = []
    for e in events[:-1]:
        before = [u for u in updates if u["service_id"] == e["service_id"] and (u["service_id"] or "").strip() and u["timestamp_ms"] <= e["timestamp_ms"]]
        last = max(before, key=lambda u: (u["timestamp_ms"], -1 if u["seq"] is None else u["seq"]), default=None)
        team = None if last is None or last["op"].lower() == "d" else last["team"]
        want.append((e["offset"], e["service_id"], e["value"], "own" if team is None else team))
    got = [(r.offset, r.service_id, r.value, r.team) for r in spark.read.schema(ORDERED).parquet(out).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {"x\ty", "z", "own"} == {r[3] for r in got}


def test_the_processor_of_changes_is_read_where_the_package_is_not(tmp_path):
    """Spark reads it in a worker beside the driver, too, which has no files given to the executors."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    read = "import pickle, sys; print(type(pickle.load(sys.stdin.buffer)).__mro__[1].__name__, 'obslake' in sys.modules)"
    ran = subprocess.run([sys.executable, "-c", read], input=CPickleSerializer().dumps(_in_order()), cwd=tmp_path, env=env, capture_output=True)
    assert ran.stdout.decode().split() == ["StatefulProcessor", "False"], ran.stderr.decode()


def test_stream_aggregation_is_hashed(spark, tmp_path):
    src = str(tmp_path / "in")
    put(src, "1", metric(1.0, 0), metric(2.0, 500_000))
    query = (
        window_aggregate(stream(spark, src), order_by=("offset",))
        .writeStream.outputMode("append").format("memory").queryName("hashed").option("checkpointLocation", str(tmp_path / "ck")).start()
    )
    query.processAllAvailable()
    plan = query._jsq.explainInternal(False)
    query.stop()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" in plan and plan.count("StateStoreSave") >= 2


def test_metadata_of_equal_events_is_the_same_in_batch_and_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    put(src, "1", metric(1.0, 1000, 1, service_name="x"), metric(2.0, 1000, 1, service_name="y", environment=None), metric(3.0, 900_000, 9, service="close"))
    out = str(tmp_path / "out")
    (
        window_aggregate(stream(spark, src), order_by=("offset",)).writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(**ONCE).start().awaitTermination()
    )
    batch = window_aggregate(spark.read.schema(NORMALIZED).json(src), order_by=("offset",)).filter("service_id = 's'").collect()
    assert spark.read.schema(METRIC_AGGREGATE).parquet(out).collect() == batch and batch[0].service_name == "y"
