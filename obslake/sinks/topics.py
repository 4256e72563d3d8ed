"""Keyed publishing, printed lines and seed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from obslake.operators.events import user_event_line
from obslake.sinks.paths import exists


def write_topic(
    records: DataFrame,
    topic: str,
    servers: str | None = None,
    format: str = "kafka",
    path: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
):
    """Publish ``(key, value)`` rows; file formats write to ``path`` instead of a broker."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic} if format == "kafka" else {"path": path}
    if not records.isStreaming:
        records.write.format(format).mode("append").options(**options).save()
        return None
    return (
        records.writeStream.format(format)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def print_user_events(
    events: DataFrame,
    format: str = "console",
    name: str = "user_events",
    checkpoint: str | None = None,
    trigger: dict | None = None,
):
    """Print one line per user event of a stream."""
    writer = user_event_line(events).writeStream.format(format).queryName(name).outputMode("append")
    if format == "console":
        writer = writer.option("truncate", "false")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def insert_if_absent(df: DataFrame, table: str, key: str) -> None:
    """Append the rows whose key the Parquet table does not hold yet, one row per key."""
    spark = df.sparkSession
    rest = [c for c in df.columns if c != key]
    fresh = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(
        *[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns]
    )
    if exists(spark, table):
        stored = spark.read.schema(df.schema).parquet(table).select(key)
        fresh = fresh.join(stored, key, "left_anti")
    fresh.select(*df.columns).write.mode("append").parquet(table)
