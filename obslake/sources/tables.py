"""Lookup and aggregate tables from Parquet or JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from obslake.operators.serving import check_time_range, utc
from obslake.schemas import AGGREGATE_KEY, METRIC_AGGREGATE, SERVICE_METADATA, WINDOW_PARTITIONS
from obslake.sinks.keyed import folders_between, read_keyed

# The first rows of a new metadata table.
SEED_METADATA = [
    ("svc-api", "API Service", "platform", "production", "us-east-1"),
    ("svc-worker", "Worker Service", "data", "production", "us-east-1"),
    ("svc-unknown", "Unknown Service", "unknown", "unknown", "unknown"),
]


def seed_metadata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED_METADATA, SERVICE_METADATA)


def _read_jdbc(spark: SparkSession, url: str, table: str, predicates: Sequence[str] | None, properties: dict | None) -> DataFrame:
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties or {})
    return spark.read.jdbc(url, table, properties=properties or {})


def read_service_metadata(spark: SparkSession, src: str, properties: dict | None = None) -> DataFrame:
    """The service-metadata table, one row per service."""
    if src.startswith("jdbc:"):
        return _read_jdbc(spark, src, "service_metadata", None, properties).select(*SERVICE_METADATA.names)
    return spark.read.schema(SERVICE_METADATA).parquet(src)


def read_aggregates(
    spark: SparkSession,
    src: str,
    predicates: Sequence[str] | None = None,
    properties: dict | None = None,
    between: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """The aggregate table; ``predicates`` split a JDBC read into parallel range scans.

    A Parquet table has the last version of each row, and the columns of its directories.  With
    ``between`` only the directories of windows that begin in that range are listed and read; the rows of
    the hours at its ends are all there, so a time-range query has to follow.
    """
    if src.startswith("jdbc:"):
        return _read_jdbc(spark, src, "metric_aggregates", predicates, properties)
    folders = None
    if between:
        check_time_range(*between)
        ends = [(t.date(), t.hour) for t in map(utc, between)]
        folders = folders_between(spark, src, WINDOW_PARTITIONS.names, *ends)
    return read_keyed(spark, src, METRIC_AGGREGATE, WINDOW_PARTITIONS, AGGREGATE_KEY, folders)
