import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from obslake.operators.external import external_transform
from obslake.operators.logs import extract_log_fields
from obslake.operators.serving import query_series
from obslake.schemas import METRIC_AGGREGATE
from obslake.sinks import aggregates as agg, files, keyed
from obslake.sinks.files import land_external, write_external_parquet
from obslake.sinks.jdbc import jdbc_mode
from obslake.sinks.shapes import read_kept
from obslake.sinks.topics import insert_if_absent, write_topic
from obslake.sources.files import list_data_files, read_external_ndjson, read_external_table, read_log_text
from obslake.sources.tables import SEED_METADATA, read_aggregates, read_service_metadata, seed_metadata
from obslake.sources.topics import read_topic, topic_options
from tests.conftest import plan_of
from tests.test_serving import AT, MINUTE, aggregates


def rows_of(spark, table):
    df = read_aggregates(spark, table).orderBy("metric_name", "window_start")
    return [(r.metric_name, r.avg_value) for r in df.collect()]


def test_upsert_replaces_and_keeps(spark, tmp_path):
    table = str(tmp_path / "t")
    agg.upsert_aggregates(aggregates(spark, 1.0, 2.0, 3.0), table)
    agg.upsert_aggregates(aggregates(spark, 7.0, metric="other", start=AT + timedelta(hours=5)), table)
    untouched = {f for f in os.listdir(f"{table}/window_date=2024-01-15/window_hour=15")}
    fix = aggregates(spark, 20.0, start=AT + MINUTE).unionByName(aggregates(spark, 9.0, metric="new"))
    agg.upsert_aggregates(fix, table)
    expected = [("cpu.usage", 1.0), ("cpu.usage", 20.0), ("cpu.usage", 3.0), ("new", 9.0), ("other", 7.0)]
    assert rows_of(spark, table) == expected
    assert {f for f in os.listdir(f"{table}/window_date=2024-01-15/window_hour=15")} == untouched
    agg.upsert_aggregates(fix, table)
    assert rows_of(spark, table) == expected


def test_upsert_handles_null_keys_and_doubles_in_one_batch(spark, tmp_path):
    table = str(tmp_path / "t")
    keyless = aggregates(spark, 1.0).withColumn("service_id", F.lit(None).cast("string"))
    agg.upsert_aggregates(keyless, table)
    agg.upsert_aggregates(keyless.withColumn("avg_value", F.lit(2.0)), table)
    assert rows_of(spark, table) == [("cpu.usage", 2.0)]
    twice = aggregates(spark, 5.0).unionByName(aggregates(spark, 6.0).withColumn("count_value", F.lit(61).cast("long")))
    agg.upsert_aggregates(twice, str(tmp_path / "u"))
    assert rows_of(spark, str(tmp_path / "u")) == [("cpu.usage", 6.0)]


def test_an_attempt_that_stopped_is_not_read_and_its_repeat_replaces_it(spark, tmp_path, monkeypatch):
    table, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    agg.upsert_aggregates(aggregates(spark, 1.0, 2.0), table)
    monkeypatch.setattr(keyed, "remove", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        agg.upsert_aggregates(aggregates(spark, 5.0), table, stage=stage)
    monkeypatch.undo()
    assert rows_of(spark, table) == [("cpu.usage", 1.0), ("cpu.usage", 2.0)]
    agg.upsert_aggregates(aggregates(spark, 6.0), table, stage=stage)
    assert rows_of(spark, table) == [("cpu.usage", 6.0), ("cpu.usage", 2.0)]
    hour = os.listdir(f"{table}/window_date=2024-01-15/window_hour=10")
    assert len(hour) == 2 and os.listdir(f"{table}/_pending") == []


def test_a_small_batch_writes_little_and_compaction_changes_no_result(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")

    def size():
        return sum(f.stat().st_size for f in Path(table).rglob("*.parquet"))

    def names(hour):
        return sorted(n for n in os.listdir(f"{table}/window_date=2024-01-15/window_hour={hour}"))

    agg.upsert_aggregates(aggregates(spark, *[float(i % 997) * 1.37 for i in range(20_000)], start=AT - timedelta(days=3)), table)
    agg.upsert_aggregates(aggregates(spark, 1.0, 2.0, start=AT), table)
    before = size()
    agg.upsert_aggregates(aggregates(spark, 3.0, start=AT), table)
    assert size() - before < before / 20
    expected = sorted(map(tuple, read_aggregates(spark, table).collect()))
    assert agg.compact_aggregates(spark, table) == 1 and len(names(10)) == 4
    # Both states are there, and the table reads the same; a second run has nothing to do.
    assert sorted(map(tuple, read_aggregates(spark, table).collect())) == expected
    assert agg.compact_aggregates(spark, table) == 0 and len(names(10)) == 4
    assert agg.compact_aggregates(spark, table, keep_seconds=0) == 0 and len(names(10)) == 1
    assert sorted(map(tuple, read_aggregates(spark, table).collect())) == expected
    agg.upsert_aggregates(aggregates(spark, 4.0, start=AT), table)
    monkeypatch.setattr(keyed, "remove", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        agg.compact_aggregates(spark, table)
    monkeypatch.undo()
    changed = [r.avg_value for r in read_aggregates(spark, table).filter(F.col("window_start") == AT).collect()]
    assert changed == [4.0]
    assert agg.compact_aggregates(spark, table, keep_seconds=0) == 1 and len(names(10)) == 1
    assert read_aggregates(spark, table).filter(F.col("window_start") == AT).first().avg_value == 4.0
    assert read_aggregates(spark, table).count() == len(expected)


def test_range_queries_open_the_hours_of_their_range(spark, tmp_path):
    table = str(tmp_path / "t")
    agg.upsert_aggregates(aggregates(spark, *[float(i) for i in range(600)], start=AT), table)
    found = query_series(read_aggregates(spark, table), "cpu.usage", "svc-api", AT + timedelta(hours=2), AT + timedelta(hours=3, minutes=30))
    assert [r.value for r in found.collect()] == [float(i) for i in range(120, 210)]
    files = {f.split("/window_hour=")[1][:2] for f in read_aggregates(spark, table).inputFiles()}
    scan = [line for line in plan_of(found).splitlines() if "PartitionFilters" in line]
    assert len(files) == 10 and any("window_hour" in line and "window_date" in line for line in scan)
    assert any("PushedFilters" in line and "service_id" in line for line in plan_of(found).splitlines())


def test_empty_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    agg.upsert_aggregates(aggregates(spark, 1.0), table)
    agg.upsert_aggregates(aggregates(spark, 1.0).limit(0), table)
    assert rows_of(spark, table) == [("cpu.usage", 1.0)]


def test_upsert_statement():
    sql = agg.upsert_statement("metric_aggregates", "staging")
    assert "ON CONFLICT (metric_name, service_id, window_start) DO UPDATE SET service_name = EXCLUDED.service_name" in sql
    assert "window_start = EXCLUDED" not in sql and "window_end = EXCLUDED.window_end" in sql


def test_parquet_copy_layout_and_listing(spark, tmp_path):
    path = str(tmp_path / "aggregated")
    rows = aggregates(spark, 1.0).unionByName(
        aggregates(spark, 2.0, metric="x").withColumn("environment", F.lit(None).cast("string"))
    )
    agg.write_aggregates_parquet(rows, path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["environment=production", "environment=unknown"]
    names = lambda prefix: [r.name for r in list_data_files(spark, path, prefix).collect()]
    assert len(names("")) == len(names("  ")) == 2
    (only,) = names("environment=prod")
    assert only.startswith("environment=production/window_date=2024-01-15/part-") and only.endswith(".parquet")
    assert names("nvironment") == [] and names("environment=test/x") == []
    assert names("environment=production/window_date=2024-01") == [only]
    assert [r.name for r in list_data_files(spark, f"file://{path}/", "environment=prod").collect()] == [only]


def test_parquet_copy_of_a_repeated_batch(spark, tmp_path):
    path = str(tmp_path / "c")
    for batch in (0, 1, 1):
        agg.write_aggregates_parquet(aggregates(spark, 1.0), path, batch)
    assert spark.read.parquet(path).count() == 2


def test_log_archive_and_structured_logs(spark, tmp_path):
    lines = ["2024-01-15T10:30:00Z [INFO] [a] x", " untouched\t", "2024-01-15T10:30:00Z [WARN] [a] y"]
    df = spark.createDataFrame([(l,) for l in lines], "value string").withColumn(
        "timestamp", F.timestamp_millis(F.lit(1714478400000))
    )
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    files.archive_raw_logs(df, raw)
    assert os.path.isdir(f"{raw}/year=2024/month=04/day=30/hour=12")
    back = read_log_text(spark, raw)
    assert back.columns == ["value"] and sorted(r.value for r in back.collect()) == sorted(lines)
    files.write_logs_parquet(extract_log_fields(back), out)
    files.write_logs_parquet(extract_log_fields(back), out, rebalance=True)
    assert sorted(d for d in os.listdir(out) if "=" in d) == ["level=INFO", "level=WARN"]
    assert spark.read.parquet(out).filter("level = 'WARN'").count() == 2


def test_landing_to_table_with_changing_columns(spark, tmp_path):
    raw, out, copy = (str(tmp_path / n) for n in ("raw", "out", "copy"))
    schema = "source_api string, payload string, received_at long"
    files.land_external(spark.createDataFrame([("a/b", '{"x":1}', 0)], schema), raw)
    files.write_external_parquet(external_transform(read_external_ndjson(spark, raw)), out, copy)
    second = str(tmp_path / "raw2")
    files.land_external(spark.createDataFrame([("c", '{"y":"s"}', 0)], schema), second)
    files.write_external_parquet(external_transform(read_external_ndjson(spark, second)), out)
    assert os.path.isdir(f"{raw}/source=a_b/year=1970/month=01/day=01/hour=00")
    rows = {r._source_api: (r.x, r.y) for r in read_external_table(spark, out).collect()}
    assert rows == {"a/b": (1, None), "c": (None, "s")} and read_external_table(spark, copy).count() == 1


def test_seed_rows_are_inserted_once(spark, tmp_path):
    table = str(tmp_path / "m")
    changed = seed_metadata(spark).filter("service_id = 'svc-api'").withColumn("team", F.lit("mine"))
    insert_if_absent(changed, table, "service_id")
    insert_if_absent(seed_metadata(spark), table, "service_id")
    insert_if_absent(seed_metadata(spark), table, "service_id")
    rows = {r.service_id: r.team for r in read_service_metadata(spark, table).collect()}
    assert rows == {"svc-api": "mine", "svc-worker": "data", "svc-unknown": "unknown"} and len(SEED_METADATA) == 3


def test_topics_through_files(spark, tmp_path):
    path = str(tmp_path / "topic")
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    write_topic(df, "t", format="json", path=path)
    assert [tuple(r)[:2] for r in read_topic(spark, "t", streaming=False, format="json", path=path).collect()] == [("k", "v")]
    assert topic_options("t", "host:1") == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "t", "startingOffsets": "earliest",
    }


def test_jdbc_modes():
    assert jdbc_mode("append") == "append"
    with pytest.raises(ValueError):
        jdbc_mode("errorifexists")


def test_each_query_has_a_staging_table():
    targets = [agg.JdbcTarget("jdbc:x:y", "metric_aggregates", q, {}) for q in ("aggregates", "Back-Fill 2")]
    assert [t.staging for t in targets] == ["metric_aggregates_staging_aggregates", "metric_aggregates_staging_back_fill_2"]


def test_sinks_agree_after_a_repeat(spark, tmp_path):
    schema = "metric_name string, service_id string, service_name string, environment string, sum_value double, min_value double, max_value double, count_value long, avg_value double, window_start timestamp, window_end timestamp"
    start, end = datetime(2024, 3, 1, 10, 0), datetime(2024, 3, 1, 10, 1)
    row = lambda name: spark.createDataFrame([("m", "s", name, "e", 1.0, 1.0, 1.0, 1, 1.0, start, end)], schema)
    table, copy, stage = (str(tmp_path / n) for n in ("table", "copy", "stage"))
    agg.fan_out(row("old"), 4, table, copy, stage)
    # The repeat of a micro-batch joined a newer lookup: both sinks keep the rows staged first.
    agg.fan_out(row("new"), 4, table, copy, stage)
    assert [r.service_name for r in read_aggregates(spark, table).collect()] == ["old"]
    assert [r.service_name for r in spark.read.parquet(copy).collect()] == ["old"]
    agg.fan_out(row("new"), 5, table, copy, stage)
    assert [r.service_name for r in read_aggregates(spark, table).collect()] == ["new"]


def test_a_stop_between_two_sinks_repeats_neither(spark, tmp_path, monkeypatch):
    table, copy, stage = (str(tmp_path / n) for n in ("table", "copy", "stage"))
    calls = []
    upsert, write = agg.upsert_aggregates, agg.write_aggregates_parquet
    monkeypatch.setattr(agg, "upsert_aggregates", lambda *a, **k: (calls.append("table"), upsert(*a, **k)))
    with monkeypatch.context() as m:
        m.setattr(agg, "write_aggregates_parquet", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            agg.fan_out(aggregates(spark, 1.0), 7, table, copy, stage)
    monkeypatch.setattr(agg, "write_aggregates_parquet", lambda *a: (calls.append("copy"), write(*a)))
    agg.fan_out(aggregates(spark, 2.0), 7, table, copy, stage)
    assert calls == ["table", "copy"]
    agg.fan_out(aggregates(spark, 2.0), 7, table, copy, stage)
    assert calls == ["table", "copy"]
    # Both have what was staged first.
    found = [[r.avg_value for r in df.collect()] for df in (read_aggregates(spark, table), agg.read_aggregates_parquet(spark, copy))]
    assert found == [[1.0], [1.0]]


def test_the_copy_reads_the_same_while_it_is_merged(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    assert agg.read_aggregates_parquet(spark, path).count() == 0
    for batch in range(12):
        agg.write_aggregates_parquet(aggregates(spark, float(batch)), path, batch)
    agg.write_aggregates_parquet(aggregates(spark, 100.0), path)
    values = lambda: sorted(r.avg_value for r in agg.read_aggregates_parquet(spark, path).collect())
    folders = lambda: sorted(d.name for d in Path(path).glob("*/*/batch_id=*"))
    expected = [*map(float, range(12)), 100.0]
    assert values() == expected
    # A day that is not closed stays.
    assert agg.merge_aggregates_parquet(spark, path, datetime(2024, 1, 15).date()) == 0
    with monkeypatch.context() as m:
        m.setattr(agg, "remove", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            agg.merge_aggregates_parquet(spark, path)
    assert "batch_id=10m" in folders() and values() == expected
    reader = agg.read_aggregates_parquet(spark, path)
    assert agg.merge_aggregates_parquet(spark, path, datetime(2024, 1, 16).date()) == 1
    # Replaced directories stay for readers that began before.
    assert len(folders()) == 13 and values() == expected and reader.count() == 13
    # A repeat of a merged micro-batch adds nothing, a later one does.
    agg.write_aggregates_parquet(aggregates(spark, 3.0), path, 3)
    agg.write_aggregates_parquet(aggregates(spark, 12.0), path, 12)
    expected = sorted([*expected, 12.0])
    assert values() == expected
    assert agg.merge_aggregates_parquet(spark, path, keep_seconds=0) == 1
    assert folders() == ["batch_id=11m", "batch_id=12"] and values() == expected


def test_external_columns_may_change_their_type(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    schema = "source_api string, payload string, received_at long"
    payloads = ['{"x":1,"y":1,"z":{"k":{"m":1}}}', '{"x":2.5,"y":"t","z":3}', '{"x":7,"y":[1],"w":true}', '{"y":2}']
    for k, payload in enumerate(payloads):
        files.land_external(spark.createDataFrame([("s", payload, k)], schema), f"{raw}{k}")
        files.write_external_parquet(external_transform(read_external_ndjson(spark, f"{raw}{k}")), out)
    table = read_external_table(spark, out)
    rows = {r._received_at: r for r in table.collect()}
    assert [rows[k].x for k in range(4)] == [1.0, 2.5, 7.0, None]
    assert [rows[k].y for k in range(4)] == ["1", "t", "[1]", "2"]
    assert rows[2].w is True and rows[0].w is None and rows[1].z == 3
    assert {f.name: f.dataType.simpleString() for f in table.schema.fields}["x"] == "double"


def test_landing_writes_a_file_per_directory_and_splits_a_hot_one(spark, tmp_path):
    hot = [("hot", '{"n":%d,"pad":"%s"}' % (i, "x" * 80), 1714478400000) for i in range(3000)]
    cold = [(f"s{i % 30}", "%d" % i, 1714478400000 + i % 2 * 3_600_000) for i in range(300)]
    records = spark.createDataFrame(hot + cold, "source_api string, payload string, received_at long").repartition(6)
    path = str(tmp_path / "raw")
    land_external(records, path, file_bytes=100_000)
    files = [f for f in (tmp_path / "raw").rglob("*.txt")]
    sizes = {}
    for f in files:
        sizes.setdefault(str(f.parent.relative_to(tmp_path / "raw")), []).append(f.stat().st_size)
    warm = [v for k, v in sizes.items() if k.startswith("source=hot")]
    assert len(sizes) == 31 and all(len(v) == 1 for k, v in sizes.items() if not k.startswith("source=hot"))
    # About 140 bytes a line: five pieces, each near the target.
    assert [len(v) for v in warm] == [5] and all(60_000 < n < 120_000 for n in warm[0])
    assert spark.read.option("recursiveFileLookup", "true").text(path).count() == 3300
    land_external(records.limit(0), str(tmp_path / "none"))
    assert spark.read.schema("value string").text(str(tmp_path / "none")).count() == 0


def test_large_integers_stay_exact_beside_fractions(spark, tmp_path):
    path, partitions = str(tmp_path / "t"), T.StructType([T.StructField("_source_api", T.StringType()), T.StructField("_date", T.DateType())])
    at = "'s' AS _source_api, DATE '2024-01-15' AS _date"
    for row in ("9007199254740993L AS id, 7L AS n, 3 AS small", "1.5D AS id, 0.25D AS n, 1.5F AS small", "5L AS id, 2L AS n, 16777217 AS small"):
        write_external_parquet(spark.sql(f"SELECT {row}, {at}"), path)
    table = read_kept(spark, path, partitions)
    assert {f.name: f.dataType.simpleString() for f in table.schema.fields}["id"] == "string"
    assert sorted(r.id for r in table.collect()) == ["1.5", "5", "9007199254740993"]
    assert sorted(r.n for r in table.collect()) == [0.25, 2.0, 7.0] and sorted(r.small for r in table.collect()) == [1.5, 3.0, 16777217.0]


def test_a_column_named_like_a_second_part(spark, tmp_path):
    path, partitions = str(tmp_path / "t"), T.StructType([T.StructField("_source_api", T.StringType()), T.StructField("_date", T.DateType())])
    at = "'s' AS _source_api, DATE '2024-01-15' AS _date"
    write_external_parquet(spark.sql(f"SELECT 1L AS x, {at}"), path)
    write_external_parquet(spark.sql(f"SELECT 1.5D AS x, 'other' AS x__double, {at}"), path)
    rows = read_kept(spark, path, partitions).orderBy("x").collect()
    assert [(r.x, r.x__double) for r in rows] == [(1.0, None), (1.5, "other")]
