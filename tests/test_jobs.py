import argparse
import json
from datetime import datetime

import pytest

from pyspark.sql import functions as F

from obslake.jobs import compact, config, external, logs, query, rollup, stream
from obslake.sinks.aggregates import read_aggregates_parquet, upsert_aggregates, write_aggregates_parquet
from obslake.sources.files import read_external_table
from obslake.sources.tables import read_aggregates
from obslake.streaming.cdc import latest_snapshot
from tests.test_serving import aggregates


def test_log_job(spark, tmp_path):
    (tmp_path / "year=2024").mkdir()
    (tmp_path / "year=2024" / "logs.txt").write_text("2024-01-15T10:30:00Z [INFO] [a] x\nnoise\n")
    logs.run(spark, str(tmp_path / "year=2024"), str(tmp_path / "out"))
    assert [r.service_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a"]


def test_external_job_infers_per_source(spark, tmp_path):
    raw, out, copy = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "copy")
    for source, data in (("a", {"id": 1}), ("b", [1, 2]), ("c", {"id": 2, "n": {"x": "y"}})):
        folder = raw / f"source={source}" / "year=2024"
        folder.mkdir(parents=True)
        line = {"_source_api": source, "_received_at": 1714478400000, "_data": data}
        (folder / "data.json").write_text(json.dumps(line))
    external.run(spark, str(raw), out, copy_to=copy)
    for path in (out, copy):
        rows = {r._source_api: r for r in spark.read.option("mergeSchema", "true").parquet(path).collect()}
        assert (rows["a"].id, rows["c"].id, rows["c"].n_x, rows["b"].data_payload) == (1, 2, "y", "[1,2]")
    external.run(spark, str(raw), str(tmp_path / "one"), per_source=False)
    texts = {r._source_api: r.data_payload for r in spark.read.parquet(str(tmp_path / "one")).collect()}
    assert {k: json.loads(v) for k, v in texts.items()} == {"a": {"id": 1}, "b": [1, 2], "c": {"id": 2, "n": {"x": "y"}}}


def test_external_job_writes_sources_of_unlike_types_together(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    data = {"a": ['{"v":1}', "{broken"], "b": ['{"v":1.5}', '{"v":2.0}'], "c": ['{"v":"x"}', "  "], "d": ["{broken"]}
    for source, payloads in data.items():
        folder = raw / f"source={source}" / "year=2024"
        folder.mkdir(parents=True)
        lines = [f'{{"_source_api":"{source}","_received_at":1714478400000,"_data":{d}}}' for d in payloads if d.strip()]
        (folder / "data.json").write_text("\n".join([*lines, "  "]))
    external.run(spark, str(raw), out)
    rows = read_external_table(spark, out).collect()
    assert sorted((r._source_api, r.v) for r in rows if r._source_api) == [
        ("a", "1"), ("b", "1.5"), ("b", "2.0"), ("c", "x")
    ]
    # Lines that are no JSON stay as rows of nulls.
    assert len(rows) == 6
    external.run(spark, str(tmp_path / "raw" / "source=a"), str(tmp_path / "single"))
    assert read_external_table(spark, str(tmp_path / "single")).filter("v = 1").count() == 1


def test_query_job(spark, tmp_path):
    where = config.paths(str(tmp_path))
    upsert_aggregates(aggregates(spark, 1.0, 2.0), where["table"])
    write_aggregates_parquet(aggregates(spark, 1.0), where["aggregated"])
    args = argparse.Namespace(
        what="series", lake=str(tmp_path), source=None, metric="cpu.usage", service="svc-api",
        frm=datetime(2024, 1, 15, 10), to=datetime(2024, 1, 15, 11), prefix="environment=prod",
    )
    assert [json.loads(l)["value"] for l in query.json_lines(query.answer(spark, args))] == [1.0, 2.0]
    args.what = "aggregates"
    assert query.answer(spark, args).count() == 2
    args.what = "files"
    assert [r.name.startswith("environment=production/") for r in query.answer(spark, args).collect()] == [True]


def test_stream_job_wires_topics_to_tables(spark, tmp_path):
    """The flows that need no broker sink, with files in place of topics."""
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "0.json").write_text(json.dumps({"key": "api", "value": '{"a":1}', "timestamp": "2024-04-30T12:00:00Z"}))
    options = {"format": "json", "path": str(topic)}
    queries = stream.start(spark, ["log-archive", "external"], str(tmp_path), "unused", source_options=options, trigger={"availableNow": True})
    assert len(queries) == 3
    for q in queries:
        q.awaitTermination(60)
    where = config.paths(str(tmp_path))
    assert spark.read.text(where["logs_raw"]).select("value").first().value == '{"a":1}'
    assert spark.read.json(where["external_raw"]).first()._data.a == 1
    with pytest.raises(KeyError):
        stream.start(spark, ["nothing"], str(tmp_path), "unused")


def test_compaction_job(spark, tmp_path, capsys):
    table = config.paths(str(tmp_path))["table"]
    for value in (1.0, 2.0):
        upsert_aggregates(aggregates(spark, value), table)
    compact.main([table, "--keep-seconds", "0"])
    assert "1 compacted" in capsys.readouterr().out
    assert [r.avg_value for r in read_aggregates(spark, table).collect()] == [2.0]
    copy = config.paths(str(tmp_path))["aggregated"]
    for batch in range(3):
        write_aggregates_parquet(aggregates(spark, 1.0), copy, batch)
    compact.main(["--lake", str(tmp_path), "--keep-seconds", "0"])
    assert "1 merged" in capsys.readouterr().out
    assert read_aggregates_parquet(spark, copy).count() == 3


def test_stream_job_keeps_what_it_rejects(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    metric = json.dumps({"metricName": "m", "value": 1, "serviceId": "s", "timestampMs": 1714478400000})
    values = [metric, "junk", json.dumps({"op": "u", "serviceName": "N"})]
    lines = [json.dumps({"key": "k", "value": v, "offset": n, "partition": 0}) for n, v in enumerate(values)]
    (topic / "0.json").write_text("\n".join(lines))
    options = {"format": "json", "path": str(topic), "schema": "key string, value string, offset long, partition int"}
    queries = stream.start(spark, ["snapshot", "aggregates"], str(tmp_path), "unused", source_options=options, trigger={"availableNow": True})
    assert len(queries) == 4
    for q in queries:
        q.awaitTermination(120)
    where = config.paths(str(tmp_path))
    found = lambda name: sorted((r.offset, r.raw_value, r.reject_reason) for r in spark.read.json(where[name]).collect())
    time = "timestampMs is missing or not an integer"
    assert found("normalized_rejects") == [(1, "junk", "malformed JSON"), (2, values[2], time)]
    assert found("cdc_rejects") == [(1, "junk", "malformed JSON"), (2, values[2], "serviceId must not be blank")]
    assert latest_snapshot(spark, where["snapshot"]).count() == 1


def test_rollup_takes_whole_windows(spark, tmp_path):
    where = config.paths(str(tmp_path))
    upsert_aggregates(aggregates(spark, *range(1, 121)), where["table"])
    at = lambda *hm: datetime(2024, 1, 15, *hm)
    # From 10:59 to 11:01 both hours are rolled up whole.
    rollup.run(spark, where["table"], where["rolled_up"], at(10, 59), at(11, 1))
    hours = lambda: [(r.window_start.hour, r.count_value, r.avg_value) for r in read_aggregates(spark, where["rolled_up"]).orderBy("window_start").collect()]
    assert hours() == [(10, 3600, 30.5), (11, 3600, 90.5)]
    # Minutes that came later change their hour alone, and only once it is rolled up again.
    upsert_aggregates(aggregates(spark, 301.0).withColumn("sum_value", F.lit(60 * 301.0)), where["table"])
    rollup.run(spark, where["table"], where["rolled_up"], at(11), at(12))
    assert hours() == [(10, 3600, 30.5), (11, 3600, 90.5)]
    rollup.main(["--lake", str(tmp_path), "--from", "2024-01-15T10:05", "--to", "2024-01-15T10:06"])
    assert hours() == [(10, 3600, 35.5), (11, 3600, 90.5)]
    with pytest.raises(ValueError, match="strictly before"):
        rollup.run(spark, where["table"], where["rolled_up"], at(12), at(11))
