"""Log lines to structured rows and to metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from obslake.functions.once import evaluated_once
from obslake.functions.text import trim_control
from obslake.functions.times import parse_instant
from obslake.operators.enrich import enrich_with_metadata
from obslake.schemas import METRIC_EVENT_FIELDS

# Fixed value: "<instant> [<level>] [<service>] <message>".
LOG_PATTERN = r"(\d{4}-\d{2}-\d{2}T[\d:.]+Z)\s+\[(\w+)]\s+\[([^\]]+)]\s+(.*)"
# Name, unit and placeholder of a log metric.
LOG_METRIC, LOG_UNIT, LOG_PLACEHOLDER = "log.event", "count", "unknown"


def extract_log_fields(df: DataFrame, value: str = "value") -> DataFrame:
    """Search each line for the log pattern; lines without it are dropped.

    The line is kept verbatim.  ``date`` is null when the text is no calendar date.
    """
    match = F.regexp_extract(F.col(value), LOG_PATTERN, 0)
    found = df.select(F.col(value).alias("raw_line"), evaluated_once(match).alias("_match"))
    fields = _match_fields("_match")
    return found.filter(F.col("_match") != "").select(
        *[c.alias(n) for n, c in fields.items()],
        "raw_line",
        F.substring("_match", 1, 10).try_cast("date").alias("date"),
    )


def _match_fields(match: str) -> dict[str, Column]:
    """The four fields of a text that matches the log pattern.

    Each field ends at the first ``Z`` or ``]`` after it, so cutting there gives
    the groups of the pattern without matching it once per group.
    """
    text = F.col(match)
    tail = F.substring(text, F.length(F.substring_index(text, "]", 2)) + 2, F.length(text))
    service = F.substring_index(F.substring_index(text, "]", 2), "]", -1)
    return {
        "timestamp": F.concat(F.substring_index(text, "Z", 1), F.lit("Z")),
        "level": F.substring_index(F.substring_index(text, "]", 1), "[", -1),
        "service_id": F.substring(service, F.instr(service, "[") + 1, F.length(service)),
        "message": F.ltrim(tail, F.lit(" \t\n\x0b\f\r")),
    }


def parse_log_metrics(df: DataFrame, value: str = "value", now: Column | None = None) -> DataFrame:
    """Trimmed lines that match the log pattern as a whole, as ``log.event`` metrics.

    The level is upper-cased; a timestamp that is no instant becomes ``now``, by
    default the current time.
    """
    carried = [F.col(c) for c in df.columns if c != value]
    whole = rf"^(?:{LOG_PATTERN})\z"
    match = F.regexp_extract(trim_control(F.col(value)), whole, 0)
    parsed = df.select(*carried, evaluated_once(match).alias("_match")).filter(F.col("_match") != "")
    fields = _match_fields("_match")
    stamped = parsed.withColumn(
        "timestamp", F.coalesce(parse_instant(fields["timestamp"]), F.current_timestamp() if now is None else now)
    )
    unknown = F.lit(LOG_PLACEHOLDER)
    return stamped.select(
        *carried,
        F.lit(LOG_METRIC).alias("metric_name"),
        F.lit(1.0).alias("value"),
        F.lit(LOG_UNIT).alias("unit"),
        fields["service_id"].alias("service_id"),
        F.lit(None).cast("map<string,string>").alias("tags"),
        "timestamp",
        F.unix_millis("timestamp").alias("timestamp_ms"),
        fields["service_id"].alias("service_name"),
        unknown.alias("team"),
        unknown.alias("environment"),
        unknown.alias("region"),
        F.upper(fields["level"]).alias("parsed_level"),
        fields["message"].alias("log_message"),
    )


def log_to_metric(parsed: DataFrame, metadata: DataFrame) -> DataFrame:
    """Look up service metadata for parsed lines, keeping level and message.

    The placeholders of the parser give way to the looked-up values or the
    lookup defaults.
    """
    placeholders = ("service_name", "team", "environment", "region", "timestamp_ms")
    events = parsed.drop(*placeholders)
    assert set(METRIC_EVENT_FIELDS.values()) <= set(events.columns)
    return enrich_with_metadata(events, metadata)
