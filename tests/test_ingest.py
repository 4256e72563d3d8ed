import json

from pyspark.sql import functions as F

from obslake.operators import ingest
from obslake.schemas import METRIC_EVENT_FIELDS, NORMALIZED_FIELDS

ISO, MS = "2023-11-02T04:05:06Z", 1698897906000


def texts(spark, *values):
    rows = [(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "n int, value string")


def event(**changed):
    base = {
        "metricName": "queue.depth", "value": 12.25, "unit": "items", "serviceId": "mailer",
        "tags": {"zone": "b", "rack": "r7"}, "timestamp": ISO,
    }
    return {k: v for k, v in {**base, **changed}.items() if v != "absent"}


def test_decode_number_rules(spark):
    good, bad = ingest.decode_metric_events(
        texts(
            spark, event(), event(value="absent"), event(value=None), event(value="5.5"), event(value=""),
            event(value="x"), event(value=True), "{broken", None, event(extra={"a": 1}), event(timestamp="junk"),
            event(timestamp=1698897906.25), event(timestamp=None),
        )
    )
    values = {r.n: r.value for r in good.collect()}
    assert values == {0: 12.25, 1: 0.0, 2: 0.0, 3: 5.5, 4: 0.0, 9: 12.25, 11: 12.25, 12: 12.25}
    reasons = {r.n: r.reject_reason for r in bad.collect()}
    assert set(reasons) == {5, 6, 7, 8, 10}
    assert reasons[5] == "value is not a number" and reasons[7].startswith("malformed JSON")
    assert reasons[10] == "timestamp is not an instant"
    first = good.filter("n = 0").first()
    assert first.tags == {"zone": "b", "rack": "r7"} and first.unit == "items"
    times = {r.n: r.t for r in good.select("n", F.unix_millis("timestamp").alias("t")).collect()}
    assert (times[0], times[11], times[12]) == (MS, MS + 250, None)


def test_validation(spark):
    good, _ = ingest.decode_metric_events(
        texts(spark, event(), event(metricName="absent"), event(serviceId="absent"), event(metricName=" \t"), event(timestamp=None, serviceId=""))
    )
    valid, rejected = ingest.validate_metric_events(good)
    assert [r.n for r in valid.collect()] == [0]
    reasons = {r.n: r.reject_reason for r in rejected.collect()}
    assert reasons[1] == "metricName must not be blank" and reasons[2] == "serviceId must not be blank"
    assert reasons[3] == "metricName must not be blank"
    assert reasons[4] == "serviceId must not be blank; timestamp must not be null"


def bodies(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, body string")


def test_metric_batch(spark):
    items = [event(value=3), event(metricName="queue.age", value=0.5), event(value="bad")]
    good, bad = ingest.explode_metric_batch(bodies(spark, json.dumps(items)))
    assert [(r.batch_pos, r.metric_name, r.value) for r in good.orderBy("batch_pos").collect()] == [
        (0, "queue.depth", 3.0), (1, "queue.age", 0.5),
    ]
    row = bad.first()
    assert bad.count() == 1 and (row.batch_pos, row.reject_reason) == (2, "value is not a number")
    assert json.loads(row.raw_value) == items[2]


def test_broken_batches_lose_nothing(spark):
    one, text = json.dumps(event()), json.dumps(json.dumps(event()))
    df = bodies(spark, f"[{one},5,{text},null,[{one}]]", f"[{one},{one[:-5]}", one, None, "[]", "{}", " ", f" [{one}] ")
    good, bad = ingest.explode_metric_batch(df)
    assert sorted((r.n, r.batch_pos) for r in good.collect()) == [(0, 0), (7, 0)]
    rows = {(r.n, r.batch_pos): (r.raw_value, r.reject_reason) for r in bad.collect()}
    whole = "body is not a JSON array"
    assert set(rows) == {(0, 1), (0, 2), (0, 3), (0, 4), (1, None), (2, None), (3, None), (5, None), (6, None)}
    assert rows[0, 1] == ("5", "element is not an object") and rows[0, 3][0] == "null"
    assert rows[1, None] == (f"[{one},{one[:-5]}", whole) and rows[3, None] == (None, whole) and rows[5, None] == ("{}", whole)
    lines, bad = ingest.explode_log_batch(bodies(spark, '["a",null,{"k":1},7]', '["cut', '"a"', None))
    assert sorted(r.value for r in lines.collect()) == ["7", "a"]
    assert sorted(((r.n, r.batch_pos or 0, r.raw_value) for r in bad.collect()), key=str) == [
        (0, 1, None), (0, 2, '{"k":1}'), (1, 0, '["cut'), (2, 0, '"a"'), (3, 0, None),
    ]
    payloads, bad = ingest.explode_external_batch(bodies(spark, "[1,{}]", '{"a":1}', "[1,", None, "[]"))
    assert sorted((r.n, r.payload) for r in payloads.collect()) == [(0, "1"), (0, "{}")]
    assert sorted((r.n, r.raw_value) for r in bad.collect()) == [(1, '{"a":1}'), (2, "[1,"), (3, None)]


def test_log_batch_is_not_trimmed_and_a_single_line_is(spark):
    df = spark.createDataFrame([(json.dumps([" a ", "b\tc"]),)], "body string")
    assert [r.value for r in ingest.explode_log_batch(df)[0].orderBy("batch_pos").collect()] == [" a ", "b\tc"]
    one = spark.createDataFrame([("\t a \n",)], "value string")
    assert ingest.single_log_line(one).first().value == "a"


def test_external_batch_keeps_types_and_key_order(spark):
    items = [{"z": 1, "a": "x"}, "5", 5, None, True, [1, "2"], 'q"uote', {"s": "é"}, 1.50]
    body = json.dumps(items, ensure_ascii=False)
    out = ingest.explode_external_batch(spark.createDataFrame([(body,)], "body string"))[0]
    payloads = [r.payload for r in out.orderBy("batch_pos").collect()]
    assert [json.loads(p) for p in payloads] == items
    assert payloads[0].replace(" ", "") == '{"z":1,"a":"x"}' and payloads[1] == '"5"'


def test_source_defaults(spark):
    df = spark.createDataFrame([(None,), ("edge",)], "source string")
    assert [r.source for r in ingest.with_log_source(df).collect()] == ["http-ingestion", "edge"]
    assert [r.source for r in ingest.with_source_default(df).collect()] == ["unknown", "edge"]


def test_encode_then_decode(spark):
    good, _ = ingest.decode_metric_events(texts(spark, event(unit=None)))
    sent = ingest.encode_json(good, "service_id", METRIC_EVENT_FIELDS)
    row = sent.first()
    assert row.key == "mailer" and json.loads(row.value)["unit"] is None
    assert json.loads(row.value)["timestamp"] == 1698897906
    back, _ = ingest.decode_metric_events(sent)
    assert back.select(*METRIC_EVENT_FIELDS.values()).collect() == good.select(*METRIC_EVENT_FIELDS.values()).collect()


def test_decode_normalized(spark):
    base = {"metricName": "m", "value": 1, "serviceId": "s", "timestampMs": MS, "serviceName": "N", "zzz": 1}
    df = texts(spark, base, {**base, "value": None}, {k: v for k, v in base.items() if k != "timestampMs"}, "junk", {**base, "value": "no"})
    rows = {r.n: r for r in ingest.decode_normalized(df).collect()}
    assert set(rows) == {0, 1}
    assert rows[0].timestamp_ms == MS and rows[0].service_name == "N" and rows[1].value == 0.0
    assert set(NORMALIZED_FIELDS.values()) <= set(ingest.decode_normalized(df).columns)


def test_rejects_of_normalized_metrics(spark):
    base = {"metricName": "m", "value": 1, "serviceId": "s", "timestampMs": MS}
    late = {k: v for k, v in base.items() if k != "timestampMs"}
    good, bad = ingest.split_normalized(texts(spark, base, "junk", late, {**base, "value": "no"}, {**late, "value": "no"}, None))
    assert [r.n for r in good.collect()] == [0] and "raw_value" not in good.columns
    reasons = {r.n: r.reject_reason for r in bad.collect()}
    number, time = "value is not a number", "timestampMs is missing or not an integer"
    assert reasons == {1: "malformed JSON", 2: time, 3: number, 4: f"{number}; {time}", 5: "malformed JSON"}
    assert {r.raw_value for r in bad.collect() if r.n in (1, 5)} == {"junk", None}


def test_rejects_of_changes(spark):
    row = {"op": "u", "serviceId": "s", "serviceName": "N"}
    envelope = {"op": "d", "before": {"service_id": None, "service_name": "N"}}
    good, bad = ingest.split_cdc(texts(spark, row, "{cut", {**row, "serviceId": " "}, envelope, None))
    assert [r.service_id for r in good.collect()] == ["s"] and "raw_value" not in good.columns
    blank = "serviceId must not be blank"
    # A tombstone is neither.
    assert {r.n: r.reject_reason for r in bad.collect()} == {1: "malformed JSON", 2: blank, 3: blank}
