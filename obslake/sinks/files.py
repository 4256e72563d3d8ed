"""File sinks for logs, landed JSON and structured external rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from obslake.functions.times import hour_partitions
from obslake.operators.external import wrap_external
from obslake.sinks.layout import FILE_BYTES, append_partitioned, clustered
from obslake.sinks.shapes import in_kept_types

HOUR = ["year", "month", "day", "hour"]
ROLL_INTERVAL = "5 minutes"
MAX_RECORDS_PER_FILE = 1_000_000


def archived_lines(logs: DataFrame, value: str = "value") -> DataFrame:
    """Verbatim lines with the directory columns of their arrival hour (UTC)."""
    arrival = F.col("timestamp") if "timestamp" in logs.columns else F.lit(None).cast("timestamp")
    ms = F.unix_millis(F.coalesce(arrival, F.current_timestamp()))
    return logs.filter(F.col(value).isNotNull()).select(
        F.col(value).alias("value"), *[c.alias(n) for n, c in hour_partitions(ms).items()]
    )


def _write_lines(
    lines: DataFrame, path: str, columns: list[str], checkpoint: str | None, trigger: dict | None, file_bytes: int = FILE_BYTES
):
    if not lines.isStreaming:
        # A line and its break; text files are not compressed.
        dealt = clustered(lines, columns, F.octet_length("value") + 1, file_bytes)
        dealt.write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*columns).text(path)
        return None
    return (
        lines.writeStream.format("text")
        .partitionBy(*columns)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**(trigger or {"processingTime": ROLL_INTERVAL}))
        .start()
    )


def archive_raw_logs(
    logs: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None, file_bytes: int = FILE_BYTES
):
    """Log lines as text under ``year=/month=/day=/hour=``; returns the query on a stream.

    A batch writes one file per hour, or one for each ``file_bytes`` of a fuller hour.
    """
    return _write_lines(archived_lines(logs), path, HOUR, checkpoint, trigger, file_bytes)


def land_external(
    records: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None, file_bytes: int = FILE_BYTES
):
    """Landing lines as text under ``source=/year=/month=/day=/hour=``, files as for logs."""
    return _write_lines(wrap_external(records), path, ["source", *HOUR], checkpoint, trigger, file_bytes)


def write_logs_parquet(rows: DataFrame, path: str, rebalance: bool = False) -> None:
    """Append structured log rows under ``level=/date=``."""
    append_partitioned(rows, path, ["level", "date"], rebalance)


def write_external_parquet(
    rows: DataFrame | list[DataFrame], path: str, copy_to: str | None = None, rebalance: bool = False
) -> None:
    """Append structured external rows under ``_source_api=/_date=``, to a second place too if given.

    A column may change its type between runs and sources (see ``sinks.shapes``).  A list holds
    rows of several shapes, which are written by one job.
    """
    partitions = ["_source_api", "_date"]
    parts = rows if isinstance(rows, list) else [rows]
    for target in filter(None, (path, copy_to)):
        append_partitioned(in_kept_types(parts, target, partitions), target, partitions, rebalance)
