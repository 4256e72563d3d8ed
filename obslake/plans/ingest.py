"""Validation, decoding, batch and user-event queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.operators import events, ingest
from obslake.operators.enrich import enrich_with_metadata
from obslake.plans import views
from obslake.plans.registry import query
from obslake.plans.views import SQL, with_sql
from obslake.schemas import NORMALIZED_FIELDS

_EVENT = ["event_id", "metric_name", "value", "service_id", "timestamp_ms"]
_TRIMMED = "trim({}, ' ' || chr(9))"


def _with_ms(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp_ms", F.unix_millis("timestamp"))


@query("decode_metric_events", with_sql("metric_json", "decoded_json", body="""
SELECT event_id, metric_name, value, service_id, timestamp_ms FROM decoded_json
WHERE number IS NULL OR number <> 'bad'"""))
def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ms(ingest.decode_metric_events(views.metric_json(spark, sf_dir))[0]).select(*_EVENT)


@query("decode_metric_rejects", with_sql("metric_json", "decoded_json", body="""
SELECT event_id, j.value AS raw_value, 'value is not a number' AS reject_reason
FROM decoded_json d JOIN metric_json j USING (event_id) WHERE number = 'bad'"""))
def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.decode_metric_events(views.metric_json(spark, sf_dir))[1].select(
        "event_id", "raw_value", "reject_reason"
    )


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.decode_metric_events(views.metric_json(spark, sf_dir))[0]


@query("validate_metric_events", with_sql("metric_json", "decoded_json", body="""
SELECT event_id, metric_name, value, service_id, timestamp_ms FROM decoded_json
WHERE (number IS NULL OR number <> 'bad') AND trim(metric_name) <> ''"""))
def validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_ms(ingest.validate_metric_events(_decoded(spark, sf_dir))[0]).select(*_EVENT)


@query("validate_metric_rejects", with_sql("metric_json", "decoded_json", body="""
SELECT event_id, metric_name, 'metricName must not be blank' AS reject_reason FROM decoded_json
WHERE (number IS NULL OR number <> 'bad') AND trim(metric_name) = ''"""))
def validate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.validate_metric_events(_decoded(spark, sf_dir))[1].select(
        "event_id", "metric_name", "reject_reason"
    )


@query("explode_metric_batch", with_sql("metric_json", "decoded_json", body="""
SELECT event_id // 5 AS batch, event_id % 5 AS batch_pos, metric_name, value, service_id, timestamp_ms
FROM decoded_json WHERE number IS NULL OR number <> 'bad'"""))
def explode_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = ingest.explode_metric_batch(views.json_batches(spark, sf_dir))
    return _with_ms(rows).select(
        "batch", F.col("batch_pos").cast("bigint").alias("batch_pos"),
        "metric_name", "value", "service_id", "timestamp_ms",
    )


@query("explode_log_batch", """
SELECT conv_id, turn, unnest(string_split(' ' || text, chr(10))) AS value FROM conversations""")
def explode_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.explode_log_batch(views.log_batches(spark, sf_dir))[0].drop("batch_pos")


@query("single_log_line", with_sql("log_lines", body="""
SELECT trim(value, ' ' || chr(9) || chr(13) || chr(10)) AS value, 'http-ingestion' AS source FROM log_lines"""))
def single_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ingest.single_log_line(views.log_lines(spark, sf_dir))
    return ingest.with_log_source(lines.withColumn("source", F.lit(None).cast("string")))


@query("explode_external_batch", with_sql("mixed_batches", body="""
SELECT event_id, coalesce(CAST(item AS VARCHAR), 'null') AS payload
FROM (SELECT event_id, unnest(from_json(body, '["JSON"]')) AS item FROM mixed_batches)"""))
def explode_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.explode_external_batch(views.mixed_batches(spark, sf_dir))[0].drop("batch_pos")


def _broken_sql(good: str, bad: str, reason: str) -> str:
    """Rejects of bodies that are, in turn, good, with a bad element, cut off, not an array, and null."""
    cut = f"CASE event_id % 5 WHEN 2 THEN '[' || {good} || ',{{\"a\":' WHEN 3 THEN '{{\"a\":' || event_id || '}}' END"
    element = f"""
SELECT event_id, 1::BIGINT AS batch_pos, '{bad}' AS raw_value, '{reason}' AS reject_reason FROM events WHERE event_id % 5 = 1
UNION ALL""" if reason else ""
    return f"""{element}
SELECT event_id, CAST(NULL AS BIGINT) AS batch_pos, {cut} AS raw_value, 'body is not a JSON array' AS reject_reason
FROM events WHERE event_id % 5 >= 2"""


_EVENT_OBJECT = "'{\"metricName\":\"m' || event_id || '\",\"serviceId\":\"s\",\"timestamp\":1}'"


def _rejects(rejected: DataFrame) -> DataFrame:
    return rejected.select("event_id", F.col("batch_pos").cast("bigint").alias("batch_pos"), "raw_value", "reject_reason")


@query("metric_batch_rejects", _broken_sql(_EVENT_OBJECT, "5", "element is not an object"))
def metric_batch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects(ingest.explode_metric_batch(views.broken_batches(spark, sf_dir, _EVENT_OBJECT, "5"))[1])


@query("metric_batch_kept", """
SELECT event_id, 0::BIGINT AS batch_pos, 'm' || event_id AS metric_name, 0.0::DOUBLE AS value, 1000::BIGINT AS timestamp_ms
FROM events WHERE event_id % 5 < 2""")
def metric_batch_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = ingest.explode_metric_batch(views.broken_batches(spark, sf_dir, _EVENT_OBJECT, "5"))
    return _with_ms(rows).select("event_id", F.col("batch_pos").cast("bigint").alias("batch_pos"), "metric_name", "value", "timestamp_ms")


_LINE = "'\"line ' || event_id || '\"'"


@query("log_batch_rejects", _broken_sql(_LINE, '{"k":1}', "element is not a line"))
def log_batch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects(ingest.explode_log_batch(views.broken_batches(spark, sf_dir, _LINE, '{"k":1}'))[1])


@query("external_batch_rejects", _broken_sql(_EVENT_OBJECT, "", ""))
def external_batch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects(ingest.explode_external_batch(views.broken_batches(spark, sf_dir, _EVENT_OBJECT, "5"))[1])


@query("encode_normalized", with_sql("metrics", "service_metadata", body="""
SELECT m.service_id AS key, m.metric_name, m.value, m.timestamp_ms,
       CASE WHEN s.service_id IS NULL THEN 'unknown' ELSE s.team END AS team
FROM metrics m LEFT JOIN service_metadata s ON m.service_id = s.service_id"""))
def encode_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized metrics to topic text and back."""
    rows = enrich_with_metadata(views.metrics(spark, sf_dir), views.service_metadata(spark, sf_dir))
    topic = ingest.encode_json(rows, "service_id", NORMALIZED_FIELDS)
    return ingest.decode_normalized(topic).select("key", "metric_name", "value", "timestamp_ms", "team")


# In turn: the change itself, no JSON, a blank service, a tombstone.  Metrics: itself, no JSON, no time, no number.
def _message(service: str, more: str = "''") -> str:
    """SQL for a JSON object; ``more`` is SQL for the text of further fields."""
    return f"""'{{"metricName":"m' || event_id || '","serviceId":"{service}","op":"u"' || {more} || '}}'"""


def _spoilt_sql(*kinds: str) -> str:
    return "CASE event_id % 4 " + " ".join(f"WHEN {n} THEN {text}" for n, text in enumerate(kinds)) + " END"


_CUT = """'{"op":"u",' || event_id"""
_AT = """',"timestampMs":' || event_id"""
_NO_NUMBER = """',"value":"x","timestampMs":' || event_id"""
_NORMALIZED_TEXT = _spoilt_sql(_message("s", _AT), _CUT, _message("s"), _message("s", _NO_NUMBER))
_CDC_TEXT = _spoilt_sql(_message("s"), _CUT, _message(" "))


def _spoilt(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The events as texts of which three in four are not what their reader takes."""
    return views.table(spark, sf_dir, "events").select("event_id", F.expr(text).alias("value"))


@query("normalized_rejects", f"""
SELECT event_id, {_NORMALIZED_TEXT} AS raw_value, CASE event_id % 4 WHEN 1 THEN 'malformed JSON'
         WHEN 2 THEN 'timestampMs is missing or not an integer' ELSE 'value is not a number' END AS reject_reason
FROM events WHERE event_id % 4 > 0""")
def normalized_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.split_normalized(_spoilt(spark, sf_dir, _NORMALIZED_TEXT))[1].select("event_id", "raw_value", "reject_reason")


@query("cdc_rejects", f"""
SELECT event_id, {_CDC_TEXT} AS raw_value,
       CASE event_id % 4 WHEN 1 THEN 'malformed JSON' ELSE 'serviceId must not be blank' END AS reject_reason
FROM events WHERE event_id % 4 IN (1, 2)""")
def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.split_cdc(_spoilt(spark, sf_dir, _CDC_TEXT))[1].select("event_id", "raw_value", "reject_reason")


_USER_OK = "trim(event_type, ' ' || chr(9)) <> '' AND service_id IS NOT NULL"


@query("validate_user_events", with_sql("user_event_requests", body=f"""
SELECT user_id, event_type, timestamp_ms, service_id FROM user_event_requests WHERE {_USER_OK}"""))
def validate_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.validate_user_events(views.user_event_requests(spark, sf_dir))[0].select(
        "user_id", "event_type", "timestamp_ms", "service_id"
    )


@query("validate_user_rejects", with_sql("user_event_requests", body=f"""
SELECT user_id, concat_ws('; ',
         CASE WHEN trim(event_type, ' ' || chr(9)) = '' THEN 'eventType must not be blank' END,
         CASE WHEN service_id IS NULL THEN 'serviceId must not be blank' END) AS reject_reason
FROM user_event_requests WHERE NOT ({_USER_OK})"""))
def validate_user_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.validate_user_events(views.user_event_requests(spark, sf_dir))[1].select(
        "user_id", "reject_reason"
    )


def _user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = events.validate_user_events(views.user_event_requests(spark, sf_dir))[0]
    # A fixed arrival time keeps the result comparable; jobs use the current time.
    return events.build_user_event(valid, now=F.lit(0).cast("bigint"))


SQL["user_events"] = f"""
SELECT user_id, event_type, coalesce(timestamp_ms, 0) AS timestamp_ms, service_id,
       coalesce(session_id, '') AS session_id, coalesce(environment, '') AS environment, status
FROM user_event_requests WHERE {_USER_OK}"""


@query("user_event_defaults", with_sql("user_event_requests", "user_events", body="""
SELECT user_id, event_type, timestamp_ms, service_id, session_id, environment, status,
       CAST(status IS NOT NULL AS BIGINT) AS n_properties FROM user_events"""))
def user_event_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_events(spark, sf_dir).select(
        "user_id", "event_type", "timestamp_ms", "service_id", "session_id", "environment",
        F.try_element_at("properties", F.lit("status")).alias("status"),
        F.size("properties").cast("bigint").alias("n_properties"),
    )


@query("user_event_line", with_sql("user_event_requests", "user_events", body="""
SELECT '[UserEvent] userId=' || user_id || ' type=' || event_type || ' service=' || service_id
       || ' env=' || environment || ' ts=' || timestamp_ms AS line FROM user_events"""))
def user_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.user_event_line(_user_events(spark, sf_dir))


@query("split_user_event_frames", """
SELECT event_id, CASE WHEN value > 5 AND event_type <> 'view' THEN user_id END AS schema_id,
       CASE WHEN value > 5 AND event_type <> 'view' THEN props END AS payload,
       CASE WHEN value <= 5 THEN 'unexpected magic byte 0x07'
            WHEN event_type = 'view' THEN 'unsupported message index' END AS reject_reason
FROM events WHERE event_type <> 'error'""")
def split_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as framed records, some with a bad header and some empty."""
    rows = views.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    magic = F.when(F.col("value") <= 5, "07").otherwise("00")
    index = F.when(kind == "view", "02").otherwise("00")
    header = F.unhex(F.concat(magic, F.lpad(F.hex("user_id"), 8, "0"), index))
    frame = F.when(kind != "error", F.concat(header, F.col("props").cast("binary"))).otherwise(
        F.lit("").cast("binary")
    )
    frames = events.split_frames(rows.select("event_id", frame.alias("value")))
    ok = F.col("reject_reason").isNull()
    return frames.select(
        "event_id",
        F.when(ok, F.col("schema_id")).alias("schema_id"),
        F.when(ok, F.decode("payload", "UTF-8")).alias("payload"),
        "reject_reason",
    )
