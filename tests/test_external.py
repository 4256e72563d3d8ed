import json
from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from obslake.operators import external


@pytest.fixture
def landed(spark, tmp_path):
    def read(*lines):
        path = tmp_path / f"in-{len(list(tmp_path.iterdir()))}"
        path.mkdir()
        text = [l if isinstance(l, str) else json.dumps(l) for l in lines]
        (path / "data.json").write_text("\n".join(text), encoding="utf8")
        return spark.read.json(str(path))

    return read


def line(data, at=1714435200000, source="payments-api"):
    return {"_source_api": source, "_received_at": at, "_data": data}


def test_flatten_and_audit(landed):
    out = external.external_transform(landed(line({"id": 1, "amount": 42.50})))
    assert out.columns == ["_source_api", "_received_at", "amount", "id", "_ingested_at", "_record_hash", "_date"]
    row = out.first()
    assert (row.id, row.amount, row._date) == (1, 42.5, date(2024, 4, 30)) and len(row._record_hash) == 64


def test_utc_date(landed):
    assert external.external_transform(landed(line({"id": 1}, at=1714478400000))).first()._date == date(2024, 4, 30)


def test_hashes(landed):
    rows = external.external_transform(
        landed(line({"id": 1, "amount": 42.5}), line({"id": 2, "amount": 18.0}, at=1714435260000))
    ).collect()
    assert len(rows) == 2 and rows[0]._record_hash != rows[1]._record_hash
    # A column that is null in a row does not change its hash.
    one = external.external_transform(landed(line({"id": 1}))).first()._record_hash
    wide = external.external_transform(landed(line({"id": 1}), line({"id": 2, "more": 1}))).filter("id = 1").first()
    assert one == wide._record_hash


def test_names_are_normalized(landed):
    out = external.external_transform(landed(line({"Order-ID": 99, "my total.x": 100, "a": {"B c": {"d": 1}}})))
    assert {"order_id", "my_total_x", "a_b_c"} <= set(out.columns)
    assert isinstance(out.schema["a_b_c"].dataType, T.StructType)
    row = out.first()
    assert (row.order_id, row.my_total_x, row.a_b_c.d) == (99, 100, 1)


def test_colliding_names_get_suffixes(spark, landed):
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        out = external.external_transform(landed(line({"Id": 1, "id": 2, "a.b": 3, "a": {"b": 4}, "_source_api": 5})))
        got = {c: out.first()[c] for c in ("_source_api", "id", "id_2", "a_b", "a_b_2", "_source_api_2")}
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)
    assert got["_source_api"] == "payments-api" and got["_source_api_2"] == 5
    assert {got["id"], got["id_2"]} == {1, 2} and {got["a_b"], got["a_b_2"]} == {3, 4}


def test_payload_that_is_no_object(spark, landed):
    rows = external.external_transform(landed(line([1, 2, 3])))
    assert "_data" not in rows.columns and rows.first().data_payload == "[1,2,3]"
    assert external.external_transform(landed(line(5))).first().data_payload == "5"
    mixed = external.external_transform(landed(line([1]), line({"a": 1}))).orderBy("data_payload").collect()
    assert [json.loads(r.data_payload) for r in mixed] == [[1], {"a": 1}]
    plain = spark.createDataFrame([("s", 1714435200000)], "_source_api string, _received_at long")
    assert external.external_transform(plain).columns[:2] == ["_source_api", "_received_at"]


def test_scalarize(spark, landed):
    df = external.external_transform(landed(line({"nested": {"k": {"v": 1}}, "l": [1]}))).withColumn(
        "m", F.create_map(F.lit("a"), F.lit(1))
    )
    out = external.scalarize_for_jdbc(df)
    assert not [f for f in out.schema if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    row = out.first()
    assert (row.nested_k, row.l, row.m) == ('{"v":1}', "[1]", '{"a":1}') and out.columns == df.columns


def test_topic_records(spark):
    rows = [(b"k", b"\n {\"a\":1}\t ", 0), (None, b"1", 0), (b"k", None, 0), (b"k", b"  ", 0), (b"k", "　2".encode(), 0)]
    df = spark.createDataFrame(rows, "key binary, value binary, t long").withColumn("timestamp", F.timestamp_millis(F.lit(7)))
    got = external.read_external(df.drop("t")).collect()
    assert [(r.source_api, r.payload, r.received_at) for r in got] == [("k", '{"a":1}', 7), ("unknown", "1", 7), ("k", "2", 7)]


def test_wrap(spark):
    df = spark.createDataFrame(
        [('pay\\"x', '{"a":\n1}', 1714478400000), (" ", "[1]", 0), ("a b/c-_9", "2", 0)],
        "source_api string, payload string, received_at long",
    )
    rows = external.wrap_external(df).collect()
    assert rows[0].value == '{"_source_api":"pay\\\\\\"x","_received_at":1714478400000,"_data":{"a": 1}}'
    assert json.loads(rows[0].value)["_source_api"] == 'pay\\"x'
    assert tuple(rows[0])[1:] == ("pay__x", "2024", "04", "30", "12")
    assert [r.source for r in rows[1:]] == ["unknown", "a_b_c-_9"]


def test_bad_payloads_are_flagged(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{a",), ("nope",), ("5",)], "payload string")
    assert [r.reject_reason is None for r in external.flag_external(df).collect()] == [True, False, False, True]
