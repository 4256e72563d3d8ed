"""Topics, read from a broker or from files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.operators.events import frame_payload, require_frames, split_frames
from obslake.schemas import TOPIC_RECORD

USER_EVENT_MESSAGE = "UserEvent"
# The fields of the message in the order of their numbers, which start at 1.
USER_EVENT_FIELDS = [
    "user_id", "event_type", "timestamp_ms", "service_id", "session_id", "environment", "properties",
]


def topic_options(topic: str, servers: str, **options: str) -> dict[str, str]:
    """Broker options: one topic, from its earliest offset unless told otherwise."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **options,
    }


def read_topic_bytes(
    spark: SparkSession,
    topic: str,
    streaming: bool = True,
    format: str = "kafka",
    schema=None,
    **options: str,
) -> DataFrame:
    """Topic records as stored.

    With ``format="kafka"`` the options are those of the broker (``servers`` is
    required); any file format reads ``path`` instead.
    """
    reader = spark.readStream if streaming else spark.read
    if format == "kafka":
        return reader.format("kafka").options(**topic_options(topic, **options)).load()
    path = options.pop("path")
    return reader.format(format).schema(schema or TOPIC_RECORD).options(**options).load(path)


def read_topic(spark: SparkSession, topic: str, streaming: bool = True, **options) -> DataFrame:
    """Topic records with key and value as text."""
    df = read_topic_bytes(spark, topic, streaming, **options)
    as_text = {c: F.col(c).cast("string") for c in ("key", "value") if c in df.columns}
    return df.withColumns(as_text)


def user_event_descriptor() -> bytes:
    """Descriptor set of the ``UserEvent`` message: text fields, one int64 and a text map."""
    from google.protobuf import descriptor_pb2 as pb

    kinds = pb.FieldDescriptorProto
    file = pb.FileDescriptorProto(name="user_event.proto", syntax="proto3")
    message = file.message_type.add(name=USER_EVENT_MESSAGE)
    entry = message.nested_type.add(name="PropertiesEntry")
    entry.options.map_entry = True
    for number, name in enumerate(("key", "value"), 1):
        entry.field.add(name=name, number=number, type=kinds.TYPE_STRING, label=kinds.LABEL_OPTIONAL)
    for number, name in enumerate(USER_EVENT_FIELDS, 1):
        field = message.field.add(name=name, number=number, type=kinds.TYPE_STRING, label=kinds.LABEL_OPTIONAL)
        if name == "timestamp_ms":
            field.type = kinds.TYPE_INT64
        elif name == "properties":
            field.type, field.label = kinds.TYPE_MESSAGE, kinds.LABEL_REPEATED
            field.type_name = f".{USER_EVENT_MESSAGE}.PropertiesEntry"
    return pb.FileDescriptorSet(file=[file]).SerializeToString()


def _descriptor(descriptor: bytes | None, path: str | None) -> dict:
    if path is not None:
        return {"descFilePath": path}
    return {"binaryDescriptorSet": descriptor or user_event_descriptor()}


def write_user_events(events: DataFrame, schema_id: int, descriptor: bytes | None = None, descriptor_path: str | None = None) -> DataFrame:
    """User events to framed binary records keyed by user, for ``write_topic``."""
    from pyspark.sql.protobuf.functions import to_protobuf

    message = to_protobuf(
        F.struct(*USER_EVENT_FIELDS), USER_EVENT_MESSAGE, **_descriptor(descriptor, descriptor_path)
    )
    return frame_payload(events.select(F.col("user_id").alias("key"), message.alias("payload")), schema_id)


def read_user_events(df: DataFrame, descriptor: bytes | None = None, descriptor_path: str | None = None) -> DataFrame:
    """Framed binary records to user events.

    A wrong magic byte fails the query.  Decoding uses Spark's protobuf module,
    which must be on the class path of the cluster.
    """
    from pyspark.sql.protobuf.functions import from_protobuf

    frames = require_frames(split_frames(df))
    event = from_protobuf(
        F.col("payload"), USER_EVENT_MESSAGE, **_descriptor(descriptor, descriptor_path)
    )
    return frames.select(event.alias("event")).select("event.*")
