"""Tumbling event-time windows over metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = "1 minute"
WATERMARK = "5 seconds"
_KEYS = ["service_id", "metric_name"]
_META = ["service_name", "environment"]


def _nan_aware_min(minimum: Column, maximum: Column) -> Column:
    """Spark orders NaN last; a window that saw one reports NaN for the minimum as well."""
    return F.when(F.isnan(maximum), maximum).otherwise(minimum)


def _columns(df: DataFrame) -> DataFrame:
    metadata = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in _META]
    return df.select(
        "metric_name",
        "service_id",
        *metadata,
        "sum_value",
        F.coalesce(_nan_aware_min(F.col("min_value"), F.col("max_value")), F.lit(0.0)).alias("min_value"),
        F.coalesce("max_value", F.lit(0.0)).alias("max_value"),
        "count_value",
        F.when(F.col("count_value") == 0, 0.0)
        .otherwise(F.col("sum_value") / F.col("count_value"))
        .alias("avg_value"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    )


def window_aggregate(
    metrics: DataFrame,
    window: str = WINDOW,
    watermark: str = WATERMARK,
    order_by: tuple[str, ...] = (),
) -> DataFrame:
    """Sum, minimum, maximum, count and average of ``value`` per service, metric and window.

    ``service_name`` and ``environment`` come from the last event of the window,
    by event time and then ``order_by`` (a bigint column such as the offset);
    when ``metrics`` lacks them they are null and can be joined afterwards.  On a
    stream the watermark closes windows and drops late events; a batch keeps all.
    A stream runs the same two aggregations one after the other, both in append
    mode, so the state per event-level window holds numbers only.
    """
    event_time = F.timestamp_millis("timestamp_ms")
    measures = [
        F.sum("value").alias("sum_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count("value").alias("count_value"),
    ]
    meta = [c for c in _META if c in metrics.columns]
    if metrics.isStreaming:
        metrics = metrics.withColumn("_event_time", event_time).withWatermark("_event_time", watermark)
        event_time = F.col("_event_time")

    # Only numbers in the first aggregation buffer: Spark hashes it, where text
    # in the buffer would sort the whole input.  The few rows left per window
    # then pick the metadata of the last event, equal ones by their text.
    slot = F.window(event_time, window).alias("window")
    if not meta:
        return _columns(metrics.groupBy(slot, *_KEYS).agg(*measures))
    recency = F.max(_recency("timestamp_ms", *order_by)).alias("_recency")
    partial = metrics.groupBy(slot, *_KEYS, *meta).agg(*measures, recency)
    merged = partial.groupBy("window", *_KEYS).agg(
        F.sum("sum_value").alias("sum_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("count_value").alias("count_value"),
        # A list is hashed as well, where a maximum of text would sort; it is as long as a window has metadata.
        F.array_max(F.collect_list(F.struct("_recency", *meta))).alias("_last"),
    )
    return _columns(merged.select("*", *[F.col(f"_last.{c}").alias(c) for c in meta]))


def _recency(*columns: str) -> Column:
    """One value that orders like the columns, nulls first; a number for event time and one tie-breaker."""
    if len(columns) == 1:
        return F.col(columns[0])
    if len(columns) > 2:
        return F.struct(*columns)
    # A step of event time is wider than the bigint range with one value below it for null.
    step = F.expr("cast(20000000000000000000 as decimal(20,0))")
    tie = F.coalesce(F.col(columns[1]).cast("bigint").cast("decimal(20,0)"), F.expr("cast(-9223372036854775809 as decimal(20,0))"))
    return F.col(columns[0]).cast("decimal(17,0)") * step + tie


def merge_aggregates(aggregates: DataFrame, window: str = "1 hour") -> DataFrame:
    """Roll window rows up to a coarser window.

    Sums and counts add up, minima and maxima combine, and each metadata column
    takes its first non-null value in window order.  Rows that count no event add
    nothing, and a result without events reports 0.0.
    """

    def filled(c: str) -> Column:
        return F.when(F.col("count_value") > 0, F.col(c))

    slot = F.window("window_start", window).alias("window")
    partial = aggregates.groupBy(slot, *_KEYS, *_META).agg(
        F.sum("sum_value").alias("sum_value"),
        F.min(filled("min_value")).alias("min_value"),
        F.max(filled("max_value")).alias("max_value"),
        F.sum("count_value").alias("count_value"),
        F.min("window_start").alias("_first"),
    )
    merged = partial.groupBy("window", *_KEYS).agg(
        F.sum("sum_value").alias("sum_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("count_value").alias("count_value"),
        *[
            F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("_first", c))).alias(c)
            for c in _META
        ],
    )
    return _columns(merged)
