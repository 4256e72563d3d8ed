"""Service-metadata lookup and the normalized record."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from obslake.operators.dimension import left_join_dimension, per_row
from obslake.schemas import METADATA

# Fixed values used for services without a metadata row.
METADATA_DEFAULTS = {
    "service_name": "Unknown Service",
    "team": "unknown",
    "environment": "unknown",
    "region": "unknown",
}


def lookup_metadata(df: DataFrame, metadata: DataFrame, spread_by: list[str], **join) -> DataFrame:
    """Set the metadata columns from the lookup table, or the defaults when there is no row.

    A row that exists keeps its nulls.
    """
    dimension = metadata.select(
        "service_id", *[F.col(c).alias(f"_m_{c}") for c in METADATA], F.lit(True).alias("_hit")
    )
    joined = left_join_dimension(df.drop(*METADATA), dimension, "service_id", spread_by, **join)
    return joined.select(
        *[F.col(c) for c in df.columns if c not in METADATA],
        *[
            F.when(F.col("_hit").isNull(), F.lit(METADATA_DEFAULTS[c]))
            .otherwise(F.col(f"_m_{c}"))
            .alias(c)
            for c in METADATA
        ],
    )


def to_normalized(events: DataFrame) -> DataFrame:
    """Metric events with a timestamp (now when missing) and its epoch milliseconds."""
    stamped = events.withColumn("timestamp", F.coalesce("timestamp", F.current_timestamp()))
    return stamped.withColumn("timestamp_ms", F.unix_millis("timestamp"))


def enrich_with_metadata(events: DataFrame, metadata: DataFrame, **join) -> DataFrame:
    """Normalized metrics: the event, its epoch milliseconds and its service metadata."""
    normalized = to_normalized(events)
    # Events of one service may agree in time, value and name; their other columns tell them apart.
    spread_by = per_row(normalized.drop("service_id", *METADATA))
    return lookup_metadata(normalized, metadata, spread_by, **join)


def union_normalized(structured: DataFrame, logs: DataFrame) -> DataFrame:
    """Structured and log-derived metrics as one bag of rows."""
    return structured.unionByName(logs, allowMissingColumns=True)
