"""Record schemas: snake_case inside, camelCase on the wire."""

from __future__ import annotations

from pyspark.sql import types as T

_TAGS = T.MapType(T.StringType(), T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()

# camelCase wire name -> snake_case column, in record order.
METRIC_EVENT_FIELDS = {
    "metricName": "metric_name",
    "value": "value",
    "unit": "unit",
    "serviceId": "service_id",
    "tags": "tags",
    "timestamp": "timestamp",
}
METADATA_FIELDS = {
    "serviceName": "service_name",
    "team": "team",
    "environment": "environment",
    "region": "region",
}
NORMALIZED_FIELDS = {
    **METRIC_EVENT_FIELDS,
    "timestampMs": "timestamp_ms",
    **METADATA_FIELDS,
    "parsedLevel": "parsed_level",
    "logMessage": "log_message",
}
CDC_FIELDS = {"op": "op", "serviceId": "service_id", **METADATA_FIELDS}

METRIC_EVENT = _struct(
    metric_name=S, value=D, unit=S, service_id=S, tags=_TAGS, timestamp=TS
)
NORMALIZED_METRIC = _struct(
    metric_name=S, value=D, unit=S, service_id=S, tags=_TAGS, timestamp=TS,
    timestamp_ms=L, service_name=S, team=S, environment=S, region=S,
    parsed_level=S, log_message=S,
)
CDC_EVENT = _struct(op=S, service_id=S, service_name=S, team=S, environment=S, region=S)
SERVICE_METADATA = _struct(service_id=S, service_name=S, team=S, environment=S, region=S)
METRIC_AGGREGATE = _struct(
    metric_name=S, service_id=S, service_name=S, environment=S,
    sum_value=D, min_value=D, max_value=D, count_value=L, avg_value=D,
    window_start=TS, window_end=TS,
)
# Directories of the aggregate table; one kept by date alone has no hour.
WINDOW_PARTITIONS = _struct(window_date=T.DateType(), window_hour=T.IntegerType())
USER_EVENT = _struct(
    user_id=S, event_type=S, timestamp_ms=L, service_id=S, session_id=S,
    environment=S, properties=_TAGS,
)
EXTERNAL_RECORD = _struct(source_api=S, payload=S, received_at=L)
TOPIC_RECORD = _struct(key=S, value=S, timestamp=TS)

METADATA = list(METADATA_FIELDS.values())
AGGREGATE_KEY = ["metric_name", "service_id", "window_start"]
