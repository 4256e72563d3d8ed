"""Validation, decoding, batch explosion and encoding of ingested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from obslake.functions.once import evaluated_once
from obslake.functions.text import fails_not_blank, is_blank, trim_control
from obslake.functions.times import epoch_seconds, wire_timestamp
from obslake.schemas import CDC_FIELDS, METADATA_FIELDS, METRIC_EVENT_FIELDS, NORMALIZED_FIELDS

# Numbers are read as text first: only the text tells "missing" from "not a number".
_EVENT_WIRE = (
    "struct<metricName string, value string, unit string, serviceId string, "
    "tags map<string,string>, timestamp string, _malformed string>"
)
_NORMALIZED_WIRE = (
    "metricName string, value string, unit string, serviceId string, "
    "tags map<string,string>, timestampMs string, serviceName string, team string, "
    "environment string, region string, parsedLevel string, logMessage string, "
    "_malformed string"
)
_CDC_ROW = "struct<service_id string, service_name string, team string, environment string, region string>"
_CDC_WIRE = (
    "op string, serviceId string, serviceName string, team string, environment string, "
    f"region string, before {_CDC_ROW}, after {_CDC_ROW}, "
    f"payload struct<op string, before {_CDC_ROW}, after {_CDC_ROW}>, _malformed string"
)
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}

DEFAULT_LOG_SOURCE = "http-ingestion"
UNKNOWN_SOURCE = "unknown"


def reasons(*checks: tuple[Column, str]) -> Column:
    """Text listing the failed checks; null when all hold."""
    texts = [F.when(failed, F.lit(text)) for failed, text in checks]
    return F.nullif(F.concat_ws("; ", *texts), F.lit(""))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split on ``reject_reason``: the accepted rows lose the column, the rest keep it."""
    return (
        df.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
        df.filter(F.col("reject_reason").isNotNull()),
    )


def _wire_double(text: Column) -> Column:
    """Number from JSON text: missing, null and empty are 0.0; null when not a number."""
    trimmed = F.nullif(trim_control(text), F.lit(""))
    return F.when(trimmed.isNull(), F.lit(0.0)).otherwise(trimmed.try_cast("double"))


# --- validation -----------------------------------------------------------------


def flag_metric_events(df: DataFrame) -> DataFrame:
    """Add ``reject_reason``: metric name and service id not blank, timestamp present."""
    # The messages.
    return df.withColumn(
        "reject_reason",
        reasons(
            (fails_not_blank(F.col("metric_name")), "metricName must not be blank"),
            (fails_not_blank(F.col("service_id")), "serviceId must not be blank"),
            (F.col("timestamp").isNull(), "timestamp must not be null"),
        ),
    )


def validate_metric_events(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` metric events."""
    return split_rejects(flag_metric_events(df))


# --- decoding --------------------------------------------------------------------


def _event_columns(event: Column) -> dict[str, Column]:
    return {
        "metric_name": event["metricName"],
        "value": _wire_double(event["value"]),
        "unit": event["unit"],
        "service_id": event["serviceId"],
        "tags": event["tags"],
        "timestamp": wire_timestamp(event["timestamp"]),
    }


def _event_problem(event: Column) -> Column:
    return reasons(
        (event.isNull() | event["_malformed"].isNotNull(), "malformed JSON"),
        (_wire_double(event["value"]).isNull(), "value is not a number"),
        (
            event["timestamp"].isNotNull() & wire_timestamp(event["timestamp"]).isNull(),
            "timestamp is not an instant",
        ),
    )


def flag_decoded_metric_events(df: DataFrame, value: str = "value") -> DataFrame:
    """Decode JSON text to metric events, keeping the text and a ``reject_reason``.

    A missing value counts as 0.0 and numeric text is accepted; unknown fields
    are ignored.  Other columns of ``df`` are carried along.
    """
    carried = [F.col(c) for c in df.columns if c != value and c not in METRIC_EVENT_FIELDS.values()]
    parsed = df.select(
        *carried,
        F.col(value).alias("raw_value"),
        evaluated_once(F.from_json(F.col(value), _EVENT_WIRE, _PERMISSIVE)).alias("_event"),
    )
    event = F.col("_event")
    return parsed.select(
        *carried,
        "raw_value",
        *[c.alias(n) for n, c in _event_columns(event).items()],
        _event_problem(event).alias("reject_reason"),
    )


def decode_metric_events(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(events, rejected)`` from JSON text."""
    good, bad = split_rejects(flag_decoded_metric_events(df, value))
    return good.drop("raw_value"), bad


def flag_normalized(df: DataFrame, value: str = "value") -> DataFrame:
    """Decode JSON text to normalized metrics, keeping the text and a ``reject_reason``.

    A missing value counts as 0.0; ``timestampMs`` must be there.  Other columns of ``df`` are carried along.
    """
    carried = [F.col(c) for c in df.columns if c != value and c not in NORMALIZED_FIELDS.values()]
    parsed = df.select(
        *carried,
        F.col(value).alias("raw_value"),
        evaluated_once(F.from_json(F.col(value), _NORMALIZED_WIRE, _PERMISSIVE)).alias("_m"),
    )
    m = F.col("_m")
    ms = m["timestampMs"].try_cast("bigint")
    columns = {dest: m[src] for src, dest in NORMALIZED_FIELDS.items() if src != "timestamp"}
    columns["value"] = _wire_double(m["value"])
    columns["timestamp_ms"] = ms
    malformed = m.isNull() | m["_malformed"].isNotNull()
    problem = reasons(
        (malformed, "malformed JSON"),
        (~malformed & columns["value"].isNull(), "value is not a number"),
        (~malformed & ms.isNull(), "timestampMs is missing or not an integer"),
    )
    return parsed.select(
        *carried,
        "raw_value",
        *[c.alias(n) for n, c in columns.items()],
        F.timestamp_millis(ms).alias("timestamp"),
        problem.alias("reject_reason"),
    )


def split_normalized(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(metrics, rejected)`` from JSON text."""
    good, bad = split_rejects(flag_normalized(df, value))
    return good.drop("raw_value"), bad


def decode_normalized(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to normalized metrics; rejected rows are dropped."""
    return split_normalized(df, value)[0]


def flag_cdc(df: DataFrame, value: str = "value") -> DataFrame:
    """Decode JSON text to change events, keeping the text and a ``reject_reason``.

    Both the flat row and the before/after envelope are read.  A tombstone (null text) is no change and
    has no row; malformed text is rejected, and so is a change that names no service, which nothing could join.
    """
    carried = [F.col(c) for c in df.columns if c != value and c not in CDC_FIELDS.values()]
    parsed = df.filter(F.col(value).isNotNull()).select(
        *carried,
        F.col(value).alias("raw_value"),
        evaluated_once(F.from_json(F.col(value), _CDC_WIRE, _PERMISSIVE)).alias("_c"),
    )
    c = F.col("_c")
    op = F.coalesce(c["op"], c["payload"]["op"])
    before = F.coalesce(c["before"], c["payload"]["before"])
    after = F.coalesce(c["after"], c["payload"]["after"])
    row = F.when(F.lower(op) == "d", before).otherwise(after)
    fields = {"service_id": F.coalesce(c["serviceId"], row["service_id"])}
    for wire, name in METADATA_FIELDS.items():
        fields[name] = F.coalesce(c[wire], row[name])
    malformed = c.isNull() | c["_malformed"].isNotNull()
    problem = reasons(
        (malformed, "malformed JSON"),
        (~malformed & is_blank(fields["service_id"]), "serviceId must not be blank"),
    )
    return parsed.select(
        *carried, "raw_value", op.alias("op"), *[v.alias(n) for n, v in fields.items()], problem.alias("reject_reason")
    )


def split_cdc(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(changes, rejected)`` from JSON text."""
    good, bad = split_rejects(flag_cdc(df, value))
    return good.drop("raw_value"), bad


def decode_cdc(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to change events; rejected rows are dropped."""
    return split_cdc(df, value)[0]


# --- batches ----------------------------------------------------------------------


NOT_AN_ARRAY = "body is not a JSON array"


def _elements(df: DataFrame, body: str, carried: list[Column], **arrays: Column) -> DataFrame:
    """One row per element of a body that is an array, and one for a body that is not.

    Adds ``raw_value`` (the body, only where it is no array), ``batch_pos`` (null there) and
    ``_e`` with a field per entry of ``arrays``.  An empty array has no rows.
    """
    text = F.col(body)
    zipped = F.when(trim_control(text).startswith("["), F.arrays_zip(*[c.alias(n) for n, c in arrays.items()]))
    parsed = df.select(*carried, text.alias("_body"), evaluated_once(zipped).alias("_items"))
    broken = F.col("_items").isNull()
    return parsed.filter(broken | (F.size("_items") > 0)).select(
        *carried,
        F.when(broken, F.col("_body")).alias("raw_value"),
        broken.alias("_broken"),
        F.posexplode_outer("_items").alias("batch_pos", "_e"),
    )


def _variant_kind(item: Column) -> Column:
    """First word of the element's type; null for a missing element."""
    return F.regexp_extract(F.schema_of_variant(item), r"^\w+", 0)


def flag_metric_batch(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per element of a JSON array of metric events, with a ``reject_reason``.

    Elements are decoded one by one: a bad one does not touch the others.  ``raw_value`` is the
    text of a rejected element, or of a whole body that is no array.
    """
    carried = [F.col(c) for c in df.columns if c != body and c not in METRIC_EVENT_FIELDS.values()]
    rows = _elements(df, body, carried, item=F.from_json(F.col(body), "array<variant>"))
    item = F.col("_e.item")
    text = F.to_json(item)
    decoded = rows.select(
        *carried,
        "batch_pos",
        "_broken",
        F.coalesce("raw_value", F.when(~F.col("_broken"), F.coalesce(text, F.lit("null")))).alias("raw_value"),
        F.coalesce(_variant_kind(item) == "OBJECT", F.lit(False)).alias("_object"),
        evaluated_once(F.from_json(text, _EVENT_WIRE, _PERMISSIVE)).alias("_event"),
    )
    event = F.col("_event")
    reason = (
        F.when(F.col("_broken"), NOT_AN_ARRAY)
        .when(~F.col("_object"), "element is not an object")
        .otherwise(_event_problem(event))
    )
    return decoded.select(
        *carried,
        "batch_pos",
        *[c.alias(n) for n, c in _event_columns(event).items()],
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), F.col("raw_value")).alias("raw_value"),
    )


def explode_metric_batch(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """``(events, rejected)`` from JSON arrays of metric events, one row per element."""
    good, bad = split_rejects(flag_metric_batch(df, body))
    return good.drop("raw_value"), bad


def flag_log_batch(df: DataFrame, body: str = "body") -> DataFrame:
    """One untrimmed log line per element of a JSON array, with a ``reject_reason``.

    Numbers and truth values count as their text; null, objects and arrays are rejected.
    """
    carried = [F.col(c) for c in df.columns if c not in (body, "value")]
    rows = _elements(
        df, body, carried,
        text=F.from_json(F.col(body), "array<string>"), item=F.from_json(F.col(body), "array<variant>"),
    )
    text, kind = F.col("_e.text"), _variant_kind(F.col("_e.item"))
    reason = (
        F.when(F.col("_broken"), NOT_AN_ARRAY)
        .when(text.isNull(), "element is null")
        .when(kind.isin("OBJECT", "ARRAY"), "element is not a line")
    )
    return rows.select(
        *carried,
        "batch_pos",
        text.alias("value"),
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), F.coalesce("raw_value", text)).alias("raw_value"),
    )


def explode_log_batch(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """``(lines, rejected)`` from JSON arrays of strings, one untrimmed line per row."""
    good, bad = split_rejects(flag_log_batch(df, body))
    return good.drop("raw_value"), bad


def single_log_line(df: DataFrame, value: str = "value") -> DataFrame:
    """A line sent on its own is trimmed at both ends."""
    return df.withColumn(value, trim_control(F.col(value)))


def explode_external_batch(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """``(payloads, rejected)`` from JSON arrays of anything, one JSON payload per element.

    The text form keeps the key order of objects but drops the quotes of string
    elements; the variant form says which elements those are, so they are quoted again.
    Only a body that is no array is rejected.
    """
    carried = [F.col(c) for c in df.columns if c not in (body, "payload")]
    rows = _elements(
        df, body, carried,
        text=F.from_json(F.col(body), "array<string>"), item=F.from_json(F.col(body), "array<variant>"),
    )
    text, item = F.col("_e.text"), F.col("_e.item")
    payload = F.when(F.schema_of_variant(item) == "STRING", F.to_json(item)).otherwise(
        F.coalesce(text, F.lit("null"))
    )
    good, bad = split_rejects(
        rows.select(
            *carried,
            "batch_pos",
            F.when(~F.col("_broken"), payload).alias("payload"),
            F.when(F.col("_broken"), NOT_AN_ARRAY).alias("reject_reason"),
            "raw_value",
        )
    )
    return good.drop("raw_value"), bad


def with_log_source(df: DataFrame, source: str = "source") -> DataFrame:
    """Log source named by the client, or the ingest default."""
    return df.withColumn(source, F.coalesce(F.col(source), F.lit(DEFAULT_LOG_SOURCE)))


def with_source_default(df: DataFrame, source: str = "source") -> DataFrame:
    """Topic key of a record whose source is missing."""
    return df.withColumn(source, F.coalesce(F.col(source), F.lit(UNKNOWN_SOURCE)))


# --- encoding ----------------------------------------------------------------------


def encode_json(df: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """``(key, value)`` rows with the record as JSON text.

    ``fields`` maps wire names to columns; columns absent from ``df`` are left
    out, nulls are written, and a ``timestamp`` becomes decimal epoch seconds.
    """
    present = {wire: name for wire, name in fields.items() if name in df.columns}
    types = dict(df.dtypes)
    columns = [
        (epoch_seconds(F.col(n)) if types[n] == "timestamp" else F.col(n)).alias(wire)
        for wire, n in present.items()
    ]
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"),
    )
