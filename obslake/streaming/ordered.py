"""The change feed applied to a stream of metrics in exact arrival order, with state per service."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from obslake.functions.text import is_blank
from obslake.operators.windows import WATERMARK
from obslake.schemas import METADATA

_OUT = "body string, state string"
_CHANGE, _METRIC = 0, 1
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "true"}
# Buckets of services; the state of a stream keeps the number it began with.
BUCKETS = 512


def _in_order() -> StatefulProcessor:
    # A class of a function is sent as code: the worker that Spark starts beside the driver for a
    # stream does not see the files given to the executors, and need not find this package.
    class InOrder(StatefulProcessor):
        """Holds rows until the watermark has passed them, then runs through them in order of arrival.

        A key is a bucket of services.  Rows wait as compressed tables, one for each frame that
        came, and the states of a bucket's services are one table, so a call to the state store
        moves many rows.
        """

        PIECE = 8192

        def init(self, handle: StatefulProcessorHandle) -> None:
            self._handle = handle
            self._waiting = handle.getListState("waiting", "rows binary")
            self._states = handle.getValueState("states", "rows binary")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            first = None
            for frame in rows:
                table = self._table(frame["row"])
                self._waiting.appendValue((self._packed(table),))
                earliest = pc.min(table["at"]).as_py()
                first = earliest if first is None else min(first, earliest)
            # One timer a bucket, for the row that is due first.
            timers = list(self._handle.listTimers())
            if first is not None and (not timers or first < min(timers)):
                for timer in timers:
                    self._handle.deleteTimer(timer)
                self._handle.registerTimer(first)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            waiting = pa.concat_tables(self._unpacked(rows) for (rows,) in self._waiting.get())
            due = pc.less_equal(waiting["at"], timerValues.getCurrentWatermarkInMs())
            ready, rest = waiting.filter(due), waiting.filter(pc.invert(due))
            del waiting
            if len(rest):
                self._waiting.put([(self._packed(rest.slice(n, self.PIECE)),) for n in range(0, len(rest), self.PIECE)])
                self._handle.registerTimer(pc.min(rest["at"]).as_py())
            else:
                self._waiting.clear()
            return self._run(ready)

        def _run(self, ready: pa.Table) -> Iterator[pd.DataFrame]:
            held = self._unpacked(self._states.get()[0]) if self._states.exists() else None
            before = len(held) if held is not None else 0
            # A state from earlier is a change before all others.
            both = lambda name: ready[name] if held is None else pa.chunked_array([*held[name].chunks, *ready[name].chunks])
            names = both("service").combine_chunks().dictionary_encode()
            service, bodies = names.indices.to_numpy(), both("body")
            early = lambda values, value: np.concatenate([np.full(before, value, "int64"), values.to_numpy()])
            at, kind = early(ready["at"], np.iinfo("int64").min), early(ready["kind"], _CHANGE)
            # A missing number comes first, as in a sort of columns.
            seq, numbered = early(pc.fill_null(ready["seq"], 0), 0), early(pc.cast(pc.is_valid(ready["seq"]), "int64"), 0)
            order = np.lexsort((seq, numbered, kind, at, service))
            service, metric = service[order], kind[order] == _METRIC
            starts = np.flatnonzero(np.r_[True, service[1:] != service[:-1]])
            # The place of the last change of the same service; -1 before its first.
            last = np.maximum.accumulate(np.where(metric, -1, np.arange(len(order))))
            last[last < np.repeat(starts, np.diff(np.r_[starts, len(order)]))] = -1
            change = np.where(last >= 0, order[last], -1)
            if before < len(order) - np.count_nonzero(metric):
                ends = np.r_[starts[1:], len(order)] - 1
                ends = ends[change[ends] >= 0]
                states = pa.table({"service": names.dictionary.take(pa.array(service[ends])), "body": bodies.take(pa.array(change[ends]))})
                states = states.filter(pc.is_valid(states["body"]))
                if len(states):
                    self._states.update((self._packed(states),))
                else:
                    self._states.clear()
            rows, change = order[metric], change[metric]
            for n in range(0, len(rows), self.PIECE):
                of = change[n : n + self.PIECE]
                yield pd.DataFrame({
                    "body": bodies.take(pa.array(rows[n : n + self.PIECE])).to_pandas(),
                    "state": bodies.take(pa.array(of, mask=of < 0)).to_pandas(),
                })

        def _table(self, rows: pd.Series) -> pa.Table:
            """The columns of rows that came as text."""
            parts = pc.split_pattern(pa.array(rows.tolist(), pa.large_string()), "\t", max_splits=4).flatten()
            at, kind, seq, body, service = (parts.take(pa.array(np.arange(n, len(parts), 5))) for n in range(5))
            some = lambda column: pc.if_else(pc.equal(column, ""), None, column)
            return pa.table({
                "at": at.cast("int64"), "kind": kind.cast("int64"), "seq": some(seq).cast("int64"), "body": some(body), "service": service,
            })

        def _packed(self, table: pa.Table) -> bytes:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(table)
            return sink.getvalue().to_pybytes()

        def _unpacked(self, rows: bytes) -> pa.Table:
            with pa.ipc.open_stream(rows) as stream:
                return stream.read_all()

        def close(self) -> None:
            pass

    return InOrder()


def _timed(rows: DataFrame, arrival: str, watermark: str) -> DataFrame:
    return rows.withColumn("_at", F.timestamp_millis(arrival)).withWatermark("_at", watermark)


def _columns(rows: DataFrame, kind: int, arrival: str, seq: str | None, body: Column, buckets: int) -> list[Column]:
    """Bucket, time and all else as one text: Spark hands rows to the processor value by value.

    A time would become an object for each row; its number, which is what Spark compares with the
    watermark, takes over the mark by which late rows are known.
    """
    time = F.unix_micros("_at").alias("_at", metadata=rows.schema["_at"].metadata)
    text = lambda column: F.coalesce(column.cast("long").cast("string"), F.lit(""))
    # Rows without an arrival come before all others.  JSON has no tabs, and the service may have some.
    at, number = F.coalesce(F.col(arrival).cast("long"), F.lit(-1)), F.col(seq) if seq else F.lit(None)
    row = F.concat_ws("\t", text(at), F.lit(str(kind)), text(number), F.coalesce(body, F.lit("")), F.coalesce("service_id", F.lit("")))
    # Rows without a service have no state, so any bucket does.
    spread = F.when(F.col("service_id").isNull(), F.xxhash64(at)).otherwise(F.xxhash64("service_id"))
    return [F.pmod(spread, F.lit(buckets)).cast("int").alias("bucket"), time, row.alias("row")]


def cdc_enrich_stream(
    metrics: DataFrame,
    changes: DataFrame,
    arrival: str,
    change_seq: str,
    metric_seq: str | None = None,
    watermark: str = WATERMARK,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Each metric of a stream with the state its service had when the metric arrived; append mode.

    ``arrival`` (epoch milliseconds) orders both streams; a change and a metric arriving together
    count as change first, changes that arrive together follow ``change_seq`` (a bigint), metrics
    ``metric_seq``.  Rows wait in the state of their service until the watermark, the lower one of
    both streams, has reached them, so the result does not depend on how the input falls into
    micro-batches.  Rows of either stream that come later than that are dropped.

    A service whose last change is a delete keeps no state, nor does one without rows that wait.
    Metrics without a service id have no state of their own and pass once their time has come.
    Services fall into ``buckets``, whose number may not change while a checkpoint lives.  All rows of
    a bucket meet in one task, which holds those that come due at once and the states of its services;
    the state store keeps both as tables.
    Only RocksDB keeps such state: start the stream within ``rocksdb_state``.
    """
    targets = [c for c in METADATA if c in metrics.columns]
    gone = F.coalesce(F.lower("op") == "d", F.lit(False))
    state = F.when(~gone, F.to_json(F.struct(*targets), _JSON))
    feed = _timed(changes.filter(~is_blank(F.col("service_id"))), arrival, watermark)
    rows = _timed(metrics, arrival, watermark)
    body = F.to_json(F.struct(*metrics.columns), _JSON)
    merged = rows.select(*_columns(rows, _METRIC, arrival, metric_seq, body, buckets)).unionByName(
        feed.select(*_columns(feed, _CHANGE, arrival, change_seq, state, buckets))
    )
    enriched = merged.groupBy("bucket").transformWithStateInPandas(_in_order(), _OUT, "Append", "EventTime")
    known = F.from_json("state", "struct<" + ", ".join(f"{c}: string" for c in targets) + ">")
    row = F.from_json("body", metrics.schema, _JSON)
    return enriched.select(known.alias("known"), row.alias("row")).select(
        *[F.coalesce(f"known.{c}", f"row.{c}").alias(c) if c in targets else F.col(f"row.{c}").alias(c) for c in metrics.columns]
    )
