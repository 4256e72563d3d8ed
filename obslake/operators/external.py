"""Arbitrary JSON from external sources: landing lines, and flattening them into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from obslake.functions.names import normalize_col_name, quoted, unique_names
from obslake.functions.text import is_blank, strip_whitespace
from obslake.functions.times import hour_partitions, utc_date

SOURCE, RECEIVED, DATA = "_source_api", "_received_at", "_data"


def read_external(topic: DataFrame) -> DataFrame:
    """Topic records to ``(source_api, payload, received_at)``.

    A missing key becomes ``unknown``; payloads without text are dropped; the
    arrival time is the record timestamp, or now.
    """
    arrival = F.col("timestamp") if "timestamp" in topic.columns else F.lit(None).cast("timestamp")
    return topic.select(
        F.coalesce(F.col("key").cast("string"), F.lit("unknown")).alias("source_api"),
        strip_whitespace(F.col("value").cast("string")).alias("payload"),
        F.unix_millis(F.coalesce(arrival, F.current_timestamp())).alias("received_at"),
    ).filter(F.col("payload") != "")


def safe_source(source: Column) -> Column:
    """Directory name of a source; blank becomes ``unknown``."""
    return F.when(is_blank(source), F.lit("unknown")).otherwise(
        F.regexp_replace(source, "[^a-zA-Z0-9_-]", "_")
    )


def flag_external(records: DataFrame) -> DataFrame:
    """Add ``reject_reason`` for payloads that are not JSON."""
    return records.withColumn(
        "reject_reason",
        F.when(F.try_parse_json("payload").isNull(), F.lit("payload is not JSON")),
    )


def wrap_external(records: DataFrame) -> DataFrame:
    """One landing line per record, with its directory columns.

    The payload goes into the line as sent; line breaks become spaces so that a
    record stays on one line.
    """
    escaped = F.replace(
        F.replace("source_api", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')
    )
    line = F.concat(
        F.lit('{"_source_api":"'),
        F.regexp_replace(escaped, r"[\r\n]+", " "),
        F.lit('","_received_at":'),
        F.col("received_at").cast("string"),
        F.lit(',"_data":'),
        F.regexp_replace("payload", r"[\r\n]+", " "),
        F.lit("}"),
    )
    parts = {"source": safe_source(F.col("source_api")), **hour_partitions(F.col("received_at"))}
    return records.select(line.alias("value"), *[c.alias(n) for n, c in parts.items()])


def flatten_payload(df: DataFrame) -> DataFrame:
    """Fields of an object payload as columns.

    Objects inside it go one level further as ``<field>_<nested>``; deeper
    objects and arrays stay nested, and other top-level columns are dropped.
    Anything that is not an object payload is returned unchanged.
    """
    if DATA not in df.columns or not isinstance(df.schema[DATA].dataType, T.StructType):
        return df
    columns: list[tuple[str, str]] = [(SOURCE, quoted(SOURCE)), (RECEIVED, quoted(RECEIVED))]
    for field in df.schema[DATA].dataType.fields:
        if isinstance(field.dataType, T.StructType):
            columns += [
                (normalize_col_name(f"{field.name}_{n.name}"), quoted(DATA, field.name, n.name))
                for n in field.dataType.fields
            ]
        else:
            columns.append((normalize_col_name(field.name), quoted(DATA, field.name)))
    names = unique_names(n for n, _ in columns)
    return df.select(*[F.col(path).alias(n) for n, (_, path) in zip(names, columns)])


def payload_as_json(df: DataFrame) -> DataFrame:
    """A payload that is no object becomes the JSON text column ``data_payload``."""
    if DATA not in df.columns or isinstance(df.schema[DATA].dataType, T.StructType):
        return df
    data = F.col(DATA)
    nested = isinstance(df.schema[DATA].dataType, (T.ArrayType, T.MapType, T.VariantType))
    text = F.to_json(data) if nested else data.cast("string")
    return df.withColumn("data_payload", text).drop(DATA)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Normalize every column name; names that collide get ``_2``, ``_3``..."""
    return df.toDF(*unique_names(normalize_col_name(c) for c in df.columns))


def record_hash(df: DataFrame) -> Column:
    """SHA-256 of the row as JSON; null fields are not part of it."""
    return F.sha2(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])), 256)


def add_audit_columns(df: DataFrame) -> DataFrame:
    """Add the load time, the row hash and the UTC date of arrival."""
    return df.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        record_hash(df).alias("_record_hash"),
        utc_date(F.col(RECEIVED)).alias("_date"),
    )


def external_transform(raw: DataFrame) -> DataFrame:
    """Landed lines to structured rows: flatten, normalize names, add audit columns."""
    return add_audit_columns(normalize_columns(payload_as_json(flatten_payload(raw))))


def scalarize_for_jdbc(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, other columns untouched."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select(
        *[
            F.to_json(F.col(quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, nested)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )
