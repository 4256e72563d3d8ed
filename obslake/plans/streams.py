"""Queries that run a stream over a whole table and read its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from obslake.operators.windows import window_aggregate
from obslake.plans import metrics as _metrics  # noqa: F401  (defines the window views)
from obslake.plans import views
from obslake.plans.registry import HOUR, aggregate_output, aggregate_output_sql, aggregate_sql, query
from obslake.plans.views import SQL, with_sql
from obslake.schemas import METRIC_AGGREGATE
from obslake.session import new_shared_path, rocksdb_state
from obslake.sinks.aggregates import merge_aggregates_parquet, read_aggregates_parquet
from obslake.sources.tables import read_aggregates
from obslake.streaming.cdc import latest_snapshot, start_cdc_snapshot
from obslake.streaming.flows import start_aggregates
from obslake.streaming.ordered import cdc_enrich_stream

_ONCE = {"availableNow": True}
_CLOSED = "window_end_ms <= (SELECT max(timestamp_ms) FROM labelled_metrics) - 5000"


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table read as a stream of files."""
    schema = views.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query(
    "streaming_window_aggregate",
    with_sql("labelled_metrics", "labelled_1m", body=aggregate_output_sql(
        f"(SELECT * FROM labelled_1m WHERE {_CLOSED})", "last.s AS service_name", "last.e AS environment")),
)
def streaming_window_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows closed by the watermark, appended to files."""
    out = new_shared_path(spark, "stream-out")
    metrics = views.labelled_metrics(spark, sf_dir, stream(spark, sf_dir, "events"))
    running = (
        window_aggregate(metrics, order_by=("arrival",))
        .writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", new_shared_path(spark, "stream-state"))
        .trigger(**_ONCE).start()
    )
    running.awaitTermination()
    rows = spark.read.schema(METRIC_AGGREGATE).parquet(out)
    return aggregate_output(rows, "service_name", "environment")


def _fold_stream(spark: SparkSession, sf_dir: str) -> str:
    path = new_shared_path(spark, "snapshot")
    changes = views.cdc_changes(spark, sf_dir, stream(spark, sf_dir, "orders"))
    start_cdc_snapshot(
        changes, path, new_shared_path(spark, "stream-state"), ["timestamp_ms", "seq"], _ONCE
    ).awaitTermination()
    return path


@query(
    "streaming_aggregates_table",
    with_sql("labelled_metrics", "labelled_1m", "cdc_changes", "cdc_snapshot", body=f"""
SELECT * FROM ({aggregate_output_sql('''(
  SELECT w.*, coalesce(c.service_name, w.last.s) AS service_name, coalesce(c.environment, w.last.e) AS environment
  FROM labelled_1m w LEFT JOIN cdc_snapshot c ON w.service_id = c.service_id)''', "service_name", "environment")})
WHERE {_CLOSED}"""),
)
def streaming_aggregates_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed and metrics as streams, into the keyed table."""
    snapshot = _fold_stream(spark, sf_dir)
    table = new_shared_path(spark, "table")
    start_aggregates(
        views.labelled_metrics(spark, sf_dir, stream(spark, sf_dir, "events")),
        table,
        new_shared_path(spark, "copy"),
        new_shared_path(spark, "stream-state"),
        snapshot=lambda: latest_snapshot(spark, snapshot),
        trigger=_ONCE,
        order_by=("arrival",),
    ).awaitTermination()
    return aggregate_output(read_aggregates(spark, table), "service_name", "environment")


# --- Several micro-batches ---------------------------------------------------------

SLICES = 3


def replayed(
    spark: SparkSession, inputs: list[DataFrame], slices: int, start: Callable[[list[DataFrame]], StreamingQuery]
) -> None:
    """Deliver each input slice by slice (column ``slice``), with a run of the stream for each.

    Every run starts anew from the checkpoint of the last one, takes what is new as one
    micro-batch, and closes what its watermark allows.
    """
    folders = [new_shared_path(spark, "replay") for _ in inputs]
    for n in range(slices):
        for rows, folder in zip(inputs, folders):
            rows.where(F.col("slice") == n).drop("slice").write.mode("append").parquet(folder)
        start([spark.readStream.schema(rows.drop("slice").schema).parquet(f) for rows, f in zip(inputs, folders)]).awaitTermination()


@query("streaming_cdc_snapshot", with_sql("cdc_changes", "cdc_snapshot", body="SELECT * FROM cdc_snapshot"))
def streaming_cdc_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot after several micro-batches, each of which writes the buckets it touches."""
    path, state = new_shared_path(spark, "snapshot"), new_shared_path(spark, "stream-state")
    changes = views.cdc_changes(spark, sf_dir)
    start = lambda streams: start_cdc_snapshot(streams[0], path, state, ["timestamp_ms", "seq"], _ONCE)
    replayed(spark, [_sliced(changes, changes)], SLICES, start)
    return latest_snapshot(spark, path)


@query(
    "streaming_aggregates_copy",
    with_sql("labelled_metrics", "labelled_1m", body=f"""
SELECT *, TRUE AS in_table FROM ({aggregate_output_sql("labelled_1m", "last.s AS service_name", "coalesce(last.e, 'unknown') AS environment")})
WHERE {_CLOSED}"""),
)
def streaming_aggregates_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Parquet copy after several runs and a merge, each row with whether the keyed table has it too."""
    table, copy, state = (new_shared_path(spark, name) for name in ("table", "copy", "stream-state"))
    metrics = views.labelled_metrics(spark, sf_dir)

    def start(streams: list[DataFrame]) -> StreamingQuery:
        return start_aggregates(streams[0], table, copy, state, trigger=_ONCE, order_by=("arrival",))

    replayed(spark, [_sliced(metrics, metrics)], SLICES, start)
    merge_aggregates_parquet(spark, copy, keep_seconds=0)
    columns = ("service_name", "environment")
    copied = aggregate_output(read_aggregates_parquet(spark, copy), *columns)
    stored = aggregate_output(read_aggregates(spark, table).fillna("unknown", "environment"), *columns)
    # Rows of both are counted by all their columns, so one that either has alone, or twice, shows.
    both = copied.withColumn("c", F.lit(1)).withColumn("t", F.lit(0)).unionByName(stored.withColumn("c", F.lit(0)).withColumn("t", F.lit(1)))
    counted = both.groupBy(*copied.columns).agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    return counted.select(*copied.columns, ((F.col("c") == 1) & (F.col("t") == 1)).alias("in_table"))


def _span(rows: DataFrame) -> Row:
    return rows.agg(F.min("timestamp_ms").alias("lo"), F.max("timestamp_ms").alias("hi")).first()


def _sliced(rows: DataFrame, of: DataFrame | Row, slices: int = SLICES) -> DataFrame:
    """Slices of equal length in event time, over the span of ``of``, which may be known."""
    span = of if isinstance(of, Row) else _span(of)
    width = (span["hi"] - span["lo"]) // slices + 1
    return rows.withColumn("slice", F.greatest(F.lit(0), F.least(F.lit(slices - 1), F.expr(f"(timestamp_ms - {span['lo']}) div {width}"))))


@query(
    "streaming_cdc_in_order",
    with_sql("sales_metrics", "cdc_changes", body="""
, last_changes AS (
  SELECT service_id, timestamp_ms, arg_max(struct_pack(
           op := op, service_name := service_name, team := team, environment := environment), seq) AS c
  FROM cdc_changes GROUP BY service_id, timestamp_ms)
SELECT m.metric_name, m.value, m.service_id, m.timestamp_ms,
       CASE WHEN coalesce(l.c.op, '') <> 'd' THEN l.c.service_name END AS service_name,
       coalesce(CASE WHEN coalesce(l.c.op, '') <> 'd' THEN l.c.team END, 'none') AS team,
       CASE WHEN coalesce(l.c.op, '') <> 'd' THEN l.c.environment END AS environment
FROM sales_metrics m ASOF LEFT JOIN last_changes l
  ON m.service_id = l.service_id AND m.timestamp_ms >= l.timestamp_ms
WHERE m.timestamp_ms <= least((SELECT max(timestamp_ms) FROM sales_metrics), (SELECT max(timestamp_ms) FROM cdc_changes)) - 5000"""),
)
def streaming_cdc_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and changes as streams in several runs; each metric meets the state of its arrival.

    Rows without a time have not arrived: such a metric is left out, such a change applies to none.
    """
    text, timed = F.lit(None).cast("string"), F.col("timestamp_ms").isNotNull()
    metrics = views.sales_metrics(spark, sf_dir).where(timed).select(
        "*", text.alias("service_name"), F.lit("none").alias("team"), text.alias("environment")
    )
    changes = views.cdc_changes(spark, sf_dir).where(timed)
    out, state = new_shared_path(spark, "stream-out"), new_shared_path(spark, "stream-state")

    def start(streams: list[DataFrame]) -> StreamingQuery:
        enriched = cdc_enrich_stream(*streams, "timestamp_ms", "seq")
        writer = enriched.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        # A task's worker takes long to begin, and the buckets of the state bound what it holds.
        with rocksdb_state(spark, 2 * spark.sparkContext.defaultParallelism):
            return writer.trigger(**_ONCE).start()

    span = _span(metrics)
    replayed(spark, [_sliced(metrics, span), _sliced(changes, span)], SLICES, start)
    return spark.read.schema(metrics.schema).parquet(out)


# Events at whole hours, so that windows end exactly at the watermark; some arrive one or two slices late.
_LATE = 2 * HOUR
SQL["late_metrics"] = f"""
SELECT *, least({SLICES - 1}, (timestamp_ms - lo) // ((hi - lo) // {SLICES} + 1))
       + CASE WHEN arrival % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN arrival % 11 = 0 THEN 1 ELSE 0 END AS slice
FROM (SELECT metric_name, value, service_id, timestamp_ms // {HOUR} * {HOUR} AS timestamp_ms, arrival,
             min(timestamp_ms // {HOUR} * {HOUR}) OVER () AS lo, max(timestamp_ms // {HOUR} * {HOUR}) OVER () AS hi FROM metrics)"""
SQL["late_watermarks"] = f"""
SELECT slice, max(max(timestamp_ms)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {_LATE} AS passed
FROM late_metrics GROUP BY slice"""
SQL["late_kept"] = f"""
SELECT m.* FROM late_metrics m JOIN late_watermarks w USING (slice)
WHERE w.passed IS NULL OR m.timestamp_ms // {HOUR} * {HOUR} + {HOUR} > w.passed"""
SQL["late_1h"] = aggregate_sql("late_kept", HOUR)


@query(
    "streaming_late_events",
    with_sql("metrics", "late_metrics", "late_watermarks", "late_kept", "late_1h", body=aggregate_output_sql(
        f"(SELECT * FROM late_1h WHERE window_end_ms <= (SELECT max(timestamp_ms) FROM late_metrics) - {_LATE})")),
)
def streaming_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come after their window was closed are dropped, also those at the very watermark."""
    hours = F.expr(f"timestamp_ms div {HOUR} * {HOUR}")
    metrics = views.metrics(spark, sf_dir).withColumn("timestamp_ms", hours)
    late = F.when(F.col("arrival") % 7 == 0, 1).otherwise(0) + F.when(F.col("arrival") % 11 == 0, 1).otherwise(0)
    rows = _sliced(metrics, metrics).withColumn("slice", F.col("slice") + late)
    out, state = new_shared_path(spark, "stream-out"), new_shared_path(spark, "stream-state")

    def start(streams: list[DataFrame]) -> StreamingQuery:
        windows = window_aggregate(streams[0], "1 hour", f"{_LATE} milliseconds")
        writer = windows.writeStream.outputMode("append").format("parquet").option("path", out)
        return writer.option("checkpointLocation", state).trigger(**_ONCE).start()

    replayed(spark, [rows], SLICES + 2, start)
    return aggregate_output(spark.read.schema(METRIC_AGGREGATE).parquet(out))
