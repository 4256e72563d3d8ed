"""User events: framing, validation, defaults and the printed line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from obslake.functions.text import fails_not_blank
from obslake.operators.ingest import reasons, split_rejects

# Fixed value: 1 magic byte, 4 schema-id bytes, 1 byte for "first message of the schema".
HEADER_BYTES = 6


def split_frames(df: DataFrame, value: str = "value") -> DataFrame:
    """Split framed binary records into ``schema_id`` and ``payload``.

    Null and empty records are skipped.  ``reject_reason`` names frames with a
    wrong magic byte, a cut header or a message index other than the first one.
    """
    carried = [F.col(c) for c in df.columns if c != value]
    frame = F.col(value)

    def hex_at(start: int, length: int) -> Column:
        return F.hex(F.substring(frame, start, length))

    return df.filter(F.octet_length(frame) > 0).select(
        *carried,
        F.conv(hex_at(2, 4), 16, 10).cast("bigint").alias("schema_id"),
        F.substring(frame, HEADER_BYTES + 1, 2**31 - 1).alias("payload"),
        F.when(hex_at(1, 1) != "00", F.concat(F.lit("unexpected magic byte 0x"), hex_at(1, 1)))
        .when(F.octet_length(frame) < HEADER_BYTES, F.lit("frame too short"))
        .when(hex_at(6, 1) != "00", F.lit("unsupported message index"))
        .alias("reject_reason"),
    )


def frame_payload(df: DataFrame, schema_id: int, payload: str = "payload") -> DataFrame:
    """Put the header in front of a binary payload: the inverse of ``split_frames``."""
    header = F.unhex(F.lit(f"00{schema_id:08x}00"))
    carried = [F.col(c) for c in df.columns if c not in (payload, "value")]
    return df.select(*carried, F.concat(header, F.col(payload)).alias("value"))


def require_frames(frames: DataFrame) -> DataFrame:
    """Fail the job on a wrong magic byte; frames with another defect are dropped."""
    bad_magic = F.coalesce(F.col("reject_reason").startswith("unexpected magic"), F.lit(False))
    checked = F.when(bad_magic, F.raise_error(F.col("reject_reason"))).otherwise(F.col("payload"))
    return frames.withColumn("payload", checked).filter(
        F.col("reject_reason").isNull() | bad_magic
    ).drop("reject_reason")


def flag_user_events(df: DataFrame) -> DataFrame:
    """Add ``reject_reason``: user id, event type and service id not blank."""
    return df.withColumn(
        "reject_reason",
        reasons(
            (fails_not_blank(F.col("user_id")), "userId must not be blank"),
            (fails_not_blank(F.col("event_type")), "eventType must not be blank"),
            (fails_not_blank(F.col("service_id")), "serviceId must not be blank"),
        ),
    )


def validate_user_events(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` user-event requests."""
    return split_rejects(flag_user_events(df))


def build_user_event(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Fill the optional fields: time of arrival, empty text, empty map."""
    arrival = F.unix_millis(F.current_timestamp()) if now is None else now
    empty = F.create_map().cast("map<string,string>")
    return df.select(
        "user_id",
        "event_type",
        F.coalesce("timestamp_ms", arrival).alias("timestamp_ms"),
        "service_id",
        F.coalesce("session_id", F.lit("")).alias("session_id"),
        F.coalesce("environment", F.lit("")).alias("environment"),
        F.coalesce("properties", empty).alias("properties"),
    )


def user_event_line(df: DataFrame) -> DataFrame:
    """One printable line per user event."""
    return df.select(
        F.format_string(
            "[UserEvent] userId=%s type=%s service=%s env=%s ts=%d",
            "user_id", "event_type", "service_id", "environment", "timestamp_ms",
        ).alias("line")
    )
