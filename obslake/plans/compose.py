"""Compositions of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from obslake.operators.cdc import cdc_enrich
from obslake.operators.enrich import lookup_metadata
from obslake.operators.windows import WINDOW, window_aggregate
from obslake.schemas import METRIC_AGGREGATE


def enriched_windows(
    events: DataFrame,
    metadata: DataFrame,
    snapshot: DataFrame | None = None,
    window: str = WINDOW,
    **join,
) -> DataFrame:
    """Window aggregates of metric events with service name and environment.

    Metadata depends on the service alone and the service is part of the window
    key, so the lookups run on the aggregated rows: the result is that of
    enriching every event first, with far fewer rows to join.
    """
    rows = window_aggregate(events.drop("service_name", "environment"), window)
    spread = ["window_start", "metric_name"]
    rows = lookup_metadata(rows.drop("service_name", "environment"), metadata, spread, **join)
    if snapshot is not None:
        rows = cdc_enrich(rows, snapshot, spread, **join)
    return rows.select(*METRIC_AGGREGATE.names)
