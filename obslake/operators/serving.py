"""Time-range queries over the stored window aggregates."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

RESULT_COLUMNS = [
    "metric_name", "service_id", "avg_value", "min_value", "max_value",
    "count_value", "window_start", "window_end",
]


def utc(t: datetime) -> datetime:
    """The instant in UTC; a time without a zone is UTC."""
    return t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t.astimezone(timezone.utc)


def check_time_range(frm: datetime | None, to: datetime | None) -> None:
    """Both ends are given and the first lies strictly before the second."""
    if frm is None or to is None:
        raise ValueError("'from' and 'to' must not be null")
    if not utc(frm) < utc(to):
        raise ValueError(f"'from' ({frm}) must be strictly before 'to' ({to})")


def _instant(t: datetime):
    micros = (utc(t) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def _in_range(df: DataFrame, metric: str, service: str, frm: datetime, to: datetime) -> DataFrame:
    check_time_range(frm, to)
    out = df.filter(
        (F.col("metric_name") == metric)
        & (F.col("service_id") == service)
        & (F.col("window_start") >= _instant(frm))
        & (F.col("window_end") <= _instant(to))
    )
    if "window_date" in df.columns:
        # Implied by the filter above; stated so that the scan skips other days.
        out = out.filter(F.col("window_date").between(utc(frm).date(), utc(to).date()))
    if "window_hour" in df.columns:
        # Hours outside the range on its first and last day; a table by date has none.
        day, hour = F.col("window_date"), F.coalesce("window_hour", F.lit(-1))
        out = out.filter((hour < 0) | (day > utc(frm).date()) | (hour >= utc(frm).hour))
        out = out.filter((hour < 0) | (day < utc(to).date()) | (hour <= utc(to).hour))
    return out


def query_aggregates(
    df: DataFrame, metric: str, service: str, frm: datetime, to: datetime
) -> DataFrame:
    """Windows of one metric and service lying wholly inside ``[frm, to]``, in time order.

    Times without a zone are UTC.
    """
    return _in_range(df, metric, service, frm, to).select(*RESULT_COLUMNS).orderBy("window_start")


def query_series(df: DataFrame, metric: str, service: str, frm: datetime, to: datetime) -> DataFrame:
    """The averages of the same windows as ``(timestamp, value)``."""
    points = _in_range(df, metric, service, frm, to)
    return points.select(
        F.col("window_start").alias("timestamp"), F.col("avg_value").alias("value")
    ).orderBy("timestamp")
