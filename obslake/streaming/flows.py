"""The long-running queries: each has its own source, checkpoint and sink."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from obslake.operators.cdc import cdc_enrich
from obslake.operators.enrich import enrich_with_metadata
from obslake.operators.external import flag_external, read_external
from obslake.operators.ingest import (
    decode_normalized, encode_json, flag_decoded_metric_events, flag_metric_batch, split_rejects, validate_metric_events,
)
from obslake.operators.logs import log_to_metric, parse_log_metrics
from obslake.operators.windows import WATERMARK, WINDOW, window_aggregate
from obslake.schemas import METRIC_EVENT_FIELDS, NORMALIZED_FIELDS
from obslake.sinks.aggregates import BY_HOUR, JdbcTarget, fan_out
from obslake.sinks.files import archive_raw_logs, land_external
from obslake.sinks.topics import write_topic

CHECKPOINT_INTERVAL = "60 seconds"
LOOKUP_SECONDS = 600.0
Lookup = Callable[[], DataFrame]


def refreshed(read: Lookup, seconds: float = LOOKUP_SECONDS) -> Lookup:
    """Keep a lookup table between micro-batches and read it again after ``seconds``."""
    held: dict = {}

    def lookup() -> DataFrame:
        now = time.monotonic()
        if not held or now - held["since"] >= seconds:
            if held:
                held["table"].unpersist()
            held.update(table=read().persist(), since=now)
        return held["table"]

    return lookup


def start_aggregates(
    metrics: DataFrame,
    table: str,
    parquet: str,
    checkpoint: str,
    snapshot: Lookup | None = None,
    window: str = WINDOW,
    watermark: str = WATERMARK,
    trigger: dict | None = None,
    order_by: tuple[str, ...] = (),
    partitions: tuple[str, ...] = BY_HOUR,
    jdbc: JdbcTarget | None = None,
):
    """Normalized metrics to window aggregates, in the keyed table, in Parquet and, if named, in a database.

    The change-feed ``snapshot`` is read again for every micro-batch and joined
    to the closed windows, which carry the same service as their events.
    """
    windows = window_aggregate(metrics, window, watermark, order_by)

    def write(batch: DataFrame, batch_id: int) -> None:
        # The closed windows are used more than once; they are read from the state once.
        cached = batch.persist()
        try:
            rows = cdc_enrich(cached, snapshot()) if snapshot else cached
            fan_out(rows, batch_id, table, parquet, f"{checkpoint}/stage", partitions, jdbc)
        finally:
            cached.unpersist()

    return (
        windows.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL}))
        .start()
    )


def _publish(batch: DataFrame, sink: dict) -> None:
    write_topic(encode_json(batch, "service_id", NORMALIZED_FIELDS), **sink)


def start_structured(topic: DataFrame, metadata: Lookup, sink: dict, checkpoint: str, rejects: str | None = None, trigger: dict | None = None):
    """Metric-event JSON to enriched JSON on the normalized topic; rejected text goes to ``rejects``."""
    flagged = flag_decoded_metric_events(topic.select("value"))

    def write(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist()
        try:
            good, bad = split_rejects(cached)
            _publish(enrich_with_metadata(good.drop("raw_value"), metadata()), sink)
            if rejects and not bad.isEmpty():
                bad.select("raw_value", "reject_reason").write.mode("overwrite").json(f"{rejects}/batch={batch_id}")
        finally:
            cached.unpersist()

    return _foreach(flagged, write, checkpoint, trigger)


def start_metric_ingest(bodies: DataFrame, sink: dict, checkpoint: str, rejects: str, trigger: dict | None = None):
    """Request bodies (JSON arrays of metric events) to valid events on a topic.

    What does not decode or validate goes to ``rejects`` with its text and the reason.
    """
    flagged = flag_metric_batch(bodies.select("body"))

    def write(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist()
        try:
            good, undecoded = split_rejects(cached)
            valid, invalid = validate_metric_events(good.drop("raw_value"))
            write_topic(encode_json(valid, "service_id", METRIC_EVENT_FIELDS), **sink)
            text = F.to_json(F.struct(*METRIC_EVENT_FIELDS.values())).alias("raw_value")
            bad = undecoded.select("batch_pos", "raw_value", "reject_reason").unionByName(
                invalid.select("batch_pos", text, "reject_reason")
            )
            if not bad.isEmpty():
                bad.write.mode("overwrite").json(f"{rejects}/batch={batch_id}")
        finally:
            cached.unpersist()

    return _foreach(flagged, write, checkpoint, trigger)


def start_log_metrics(topic: DataFrame, metadata: Lookup, sink: dict, checkpoint: str, trigger: dict | None = None):
    """Log lines that parse to ``log.event`` metrics on the normalized topic."""
    parsed = parse_log_metrics(topic.select("value"))

    def write(batch: DataFrame, batch_id: int) -> None:
        # The lookup may measure and count the batch before it is joined.
        cached = batch.persist()
        try:
            _publish(log_to_metric(cached, metadata()), sink)
        finally:
            cached.unpersist()

    return _foreach(parsed, write, checkpoint, trigger)


def _foreach(stream: DataFrame, write, checkpoint: str, trigger: dict | None):
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def normalized_stream(topic: DataFrame) -> DataFrame:
    """Normalized metrics of a topic; the broker offset, if any, breaks ties in time."""
    columns = [c for c in ("value", "offset") if c in topic.columns]
    return decode_normalized(topic.select(*columns))


def start_log_archive(topic: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Raw lines to hourly text files."""
    return archive_raw_logs(topic, path, checkpoint, trigger)


def start_external_landing(topic: DataFrame, path: str, checkpoint: str, rejects: str | None = None, trigger: dict | None = None):
    """External JSON to hourly files per source.

    With ``rejects`` payloads that are not JSON go there as text instead of
    into the landing tree; without it everything is landed as sent.
    """
    records = read_external(topic)
    if rejects is None:
        return [land_external(records, path, checkpoint, trigger)]
    good, bad = split_rejects(flag_external(records))
    return [land_external(good, path, checkpoint, trigger), start_rejects(bad, rejects, f"{checkpoint}-rejects", trigger)]


def start_rejects(rejected: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Rejected rows as JSON lines, in a query of its own: it may lag or stop without holding up the good rows."""
    return (
        rejected.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 minutes"}))
        .start()
    )


def rejected_texts(topic: DataFrame, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Text of a topic that ``split`` rejects, with the reason and, where the broker gives it, its place."""
    place = [c for c in ("partition", "offset") if c in topic.columns]
    return split(topic.select("value", *place))[1].select(*place, "raw_value", "reject_reason")
