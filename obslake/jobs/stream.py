"""Streaming job: any of the long-running queries, each with its own checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from obslake.jobs.config import TOPICS, env, jdbc_properties, parser, paths
from obslake.operators.ingest import decode_cdc, split_cdc, split_normalized
from obslake.session import build_session
from obslake.sinks.aggregates import JdbcTarget
from obslake.sinks.topics import print_user_events
from obslake.sources.tables import read_service_metadata
from obslake.sources.topics import read_topic, read_topic_bytes, read_user_events
from obslake.streaming import flows
from obslake.streaming.cdc import latest_snapshot, start_cdc_snapshot

FLOWS = ("metric-ingest", "structured", "log-metrics", "snapshot", "aggregates", "log-archive", "user-events", "external")


def start(
    spark: SparkSession,
    names: list[str],
    lake: str,
    servers: str,
    metadata: str | None = None,
    descriptor: str | None = None,
    source_options: dict[str, str] | None = None,
    trigger: dict | None = None,
    bodies: str | None = None,
    jdbc: tuple[str, str] | None = None,
) -> list[StreamingQuery]:
    """Start the named flows; returns their running queries.

    ``bodies`` is the folder of request bodies that ``metric-ingest`` reads, one JSON array per
    line; without it that flow does not run.  ``jdbc`` (URL and table) adds a database to the
    sinks of ``aggregates``.

    Each flow has its own default ``trigger``; ``{"availableNow": True}`` processes what is
    there and stops.
    """
    where = paths(lake)
    options = {"servers": servers, **(source_options or {})}

    def topic(key: str):
        return read_topic(spark, TOPICS[key], **options)

    def checkpoint(name: str) -> str:
        return f"{where['checkpoints']}/{name}"

    lookup = flows.refreshed(
        lambda: read_service_metadata(spark, metadata or where["metadata"], jdbc_properties())
    )
    normalized = {"topic": TOPICS["normalized"], "servers": servers}
    structured = {"topic": TOPICS["structured"], "servers": servers}
    database = JdbcTarget(*jdbc, "aggregates", jdbc_properties()) if jdbc else None
    starters: dict[str, Callable] = {
        "metric-ingest": lambda c: flows.start_metric_ingest(
            spark.readStream.text(bodies).withColumnRenamed("value", "body"), structured, c, where["ingest_rejects"], trigger
        ),
        "structured": lambda c: flows.start_structured(topic("structured"), lookup, normalized, c, where["rejects"], trigger),
        "log-metrics": lambda c: flows.start_log_metrics(topic("logs"), lookup, normalized, c, trigger),
        "snapshot": lambda c: [
            start_cdc_snapshot(
                decode_cdc(topic("cdc").select("value", "partition", "offset")),
                where["snapshot"], c, ["offset"], trigger,
            ),
            flows.start_rejects(
                flows.rejected_texts(topic("cdc"), split_cdc), where["cdc_rejects"], f"{c}-rejects", trigger
            ),
        ],
        "aggregates": lambda c: [
            flows.start_aggregates(
                flows.normalized_stream(topic("normalized")), where["table"], where["aggregated"], c,
                snapshot=lambda: latest_snapshot(spark, where["snapshot"]), order_by=("offset",), trigger=trigger,
                jdbc=database,
            ),
            flows.start_rejects(
                flows.rejected_texts(topic("normalized"), split_normalized), where["normalized_rejects"], f"{c}-rejects", trigger
            ),
        ],
        "log-archive": lambda c: flows.start_log_archive(topic("logs"), where["logs_raw"], c, trigger),
        "user-events": lambda c: print_user_events(
            read_user_events(
                read_topic_bytes(spark, TOPICS["users"], **options).select("value"), descriptor_path=descriptor
            ),
            checkpoint=c, trigger=trigger,
        ),
        "external": lambda c: flows.start_external_landing(
            topic("external"), where["external_raw"], c, where["external_rejects"], trigger
        ),
    }
    queries: list[StreamingQuery] = []
    for name in names:
        if name == "metric-ingest" and not bodies:
            continue
        started = starters[name](checkpoint(name))
        queries += started if isinstance(started, list) else [started]
    return queries


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("flows", nargs="*", choices=[*FLOWS, []], default=list(FLOWS))
    p.add_argument("--servers", default=env("OBSLAKE_BROKERS"))
    p.add_argument("--metadata", default=env("OBSLAKE_METADATA") or None, help="Parquet folder or JDBC URL")
    p.add_argument("--descriptor", help="protobuf descriptor set of the user events")
    p.add_argument("--bodies", help="folder of request bodies, one JSON array per line")
    p.add_argument("--jdbc-url", help="database that window aggregates are merged into as well")
    p.add_argument("--jdbc-table", default="metric_aggregates")
    p.add_argument("--max-offsets", help="records per micro-batch and topic")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    args = p.parse_args(argv)
    spark = build_session("obslake-stream")
    options = {"maxOffsetsPerTrigger": args.max_offsets} if args.max_offsets else {}
    trigger = {"availableNow": True} if args.available_now else None
    queries = start(
        spark, args.flows or list(FLOWS), args.lake, args.servers, args.metadata, args.descriptor, options, trigger,
        args.bodies, (args.jdbc_url, args.jdbc_table) if args.jdbc_url else None,
    )
    if args.available_now:
        for running in queries:
            running.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
