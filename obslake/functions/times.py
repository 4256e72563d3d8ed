"""Instants, epoch milliseconds and UTC calendar parts.

The calendar helpers work on epoch milliseconds with integer arithmetic, so
their results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MS_PER_DAY = 86_400_000
MS_PER_HOUR = 3_600_000

# Fixed value: date-time with seconds, up to nine decimals and an offset.
INSTANT_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}(:\d{2}){0,2})$"
)


def parse_instant(c: Column) -> Column:
    """ISO-8601 instant text to timestamp; null for anything else, bad calendar dates included."""
    return F.when(c.rlike(INSTANT_PATTERN), c.try_cast("timestamp"))


def wire_timestamp(c: Column) -> Column:
    """Timestamp from JSON text: decimal epoch seconds or an ISO-8601 instant."""
    micros = F.floor(c.try_cast("decimal(29,9)") * F.lit(1_000_000)).try_cast("bigint")
    return F.when(c.contains("T"), parse_instant(c)).otherwise(F.timestamp_micros(micros))


def epoch_seconds(c: Column) -> Column:
    """Timestamp to the decimal epoch-seconds form used on the wire."""
    return c.cast("decimal(28,9)")


def instant_from_ntz(c: Column) -> Column:
    """Read a zone-less timestamp as UTC, by whole days and the time of day.

    The parts of a zone-less timestamp are the same in every session zone.
    """
    days = F.unix_date(c.cast("date")).cast("bigint")
    of_day = (F.hour(c) * 60 + F.minute(c)).cast("bigint") * 60_000_000 + (
        F.date_part(F.lit("SECOND"), c) * 1_000_000
    ).cast("bigint")
    return F.timestamp_micros(days * (MS_PER_DAY * 1000) + of_day)


def utc_date(ms: Column) -> Column:
    """UTC date of epoch milliseconds."""
    return F.date_from_unix_date(F.floor(ms / F.lit(MS_PER_DAY)).cast("int"))


def utc_hour(ms: Column) -> Column:
    """UTC hour of day (0-23) of epoch milliseconds."""
    return F.floor(F.pmod(ms, F.lit(MS_PER_DAY)) / F.lit(MS_PER_HOUR)).cast("int")


def hour_partitions(ms: Column) -> dict[str, Column]:
    """year / month / day / hour directory values (UTC; year unpadded, the rest two digits)."""
    day = utc_date(ms)

    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    return {
        "year": F.year(day).cast("string"),
        "month": two(F.month(day)),
        "day": two(F.dayofmonth(day)),
        "hour": two(utc_hour(ms)),
    }
