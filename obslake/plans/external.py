"""Schema-on-read queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.functions.times import instant_from_ntz
from obslake.operators import external
from obslake.plans import views
from obslake.plans.registry import query
from obslake.plans.views import SQL, SQL_ARRIVAL_MS, with_sql
from obslake.session import new_shared_path
from obslake.sinks.files import land_external, write_external_parquet
from obslake.sources.files import read_external_ndjson, read_external_table

_UTC = "make_timestamp(received_at * 1000)"
SQL["wrapped"] = f"""
SELECT '{{"_source_api":"' || replace(replace(source_api, '\\', '\\\\'), '"', '\\"') || '","_received_at":'
       || received_at || ',"_data":' || payload || '}}' AS value,
       regexp_replace(source_api, '[^a-zA-Z0-9_-]', '_', 'g') AS source,
       strftime({_UTC}, '%Y') AS year, strftime({_UTC}, '%m') AS month,
       strftime({_UTC}, '%d') AS day, strftime({_UTC}, '%H') AS hour
FROM external_records"""


@query("read_external", """
SELECT CASE WHEN event_type = 'view' THEN 'unknown' ELSE event_type END AS source_api, props AS payload,
       epoch_us(ts) // 1000 AS received_at
FROM events WHERE event_type NOT IN ('error', 'click')""")
def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed topic rows, some without a key, with an empty value or without a value."""
    kind = F.col("event_type")
    topic = views.table(spark, sf_dir, "events").select(
        F.when(kind != "view", kind).cast("binary").alias("key"),
        F.when(kind == "error", F.lit(" \n ")).when(kind != "click", F.concat(F.lit("\n\t"), "props", F.lit("  ")))
        .cast("binary").alias("value"),
        instant_from_ntz(F.col("ts")).alias("timestamp"),
    )
    return external.read_external(topic)


@query("wrap_external", with_sql("external_records", "wrapped", body="SELECT * FROM wrapped"))
def wrapped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return external.wrap_external(views.external_records(spark, sf_dir))


def _landed(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Landing lines written to the hourly tree and read back."""
    raw = new_shared_path(spark, "external-raw")
    land_external(records, raw)
    return read_external_ndjson(spark, raw)


@query("external_record_hash", """
SELECT event_type || '-api' AS _source_api, received_at AS _received_at, CAST(props->>'$.k' AS BIGINT) AS k,
       sha256('{"_source_api":"' || event_type || '-api","_received_at":' || received_at || ',"k":'
              || (props->>'$.k') || '}') AS _record_hash,
       CAST(make_timestamp(received_at * 1000) AS DATE) AS _date
FROM (SELECT *, """ + SQL_ARRIVAL_MS + """ AS received_at FROM events)""")
def external_record_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, read with an inferred schema, transform."""
    records = views.external_records(spark, sf_dir).withColumn(
        "source_api", F.concat(F.substring_index("source_api", '"', 1), F.lit("-api"))
    )
    return external.external_transform(_landed(spark, records)).drop("_ingested_at")


_NESTED_SQL = f"""
SELECT event_type || '-api' AS _source_api, {SQL_ARRIVAL_MS} AS _received_at,
       user_id AS n_x_k, 1::BIGINT AS n_x_d_z, event_id AS order_id, user_id AS l_0, event_type AS my_field
FROM events"""


def _plain(df: DataFrame) -> DataFrame:
    return df.select(
        "_source_api", "_received_at", "n_x_k", F.col("n_x_d.z").alias("n_x_d_z"), "order_id",
        F.col("l")[0].alias("l_0"), "my_field",
    )


@query("external_flatten", _NESTED_SQL)
def external_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed(spark, views.nested_records(spark, sf_dir))
    return _plain(external.normalize_columns(external.flatten_payload(landed)))


@query("external_table", _NESTED_SQL)
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: land, infer, transform, append to the partitioned table, read back."""
    target = new_shared_path(spark, "external")
    rows = external.external_transform(_landed(spark, views.nested_records(spark, sf_dir)))
    write_external_parquet(rows, target)
    return _plain(read_external_table(spark, target))


@query("external_table_drift", """
SELECT event_id AS id,
       CASE event_id % 3 WHEN 0 THEN user_id::VARCHAR WHEN 1 THEN (user_id + 0.5)::DOUBLE::VARCHAR ELSE 'n' || user_id END AS amount,
       CASE event_id % 3 WHEN 1 THEN user_id + 0.25 ELSE user_id END::DOUBLE AS level,
       CASE event_id % 3 WHEN 1 THEN (user_id + 0.5)::DOUBLE::VARCHAR ELSE (9007199254740993 + user_id)::VARCHAR END AS ident,
       CASE WHEN event_id % 3 = 0 THEN 'x' END AS removed, CASE WHEN event_id % 3 = 2 THEN user_id END AS added
FROM events""")
def external_table_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs into one table: a number becomes fractional and then text, large integers stay exact, fields come and go."""
    target = new_shared_path(spark, "external")
    events = views.table(spark, sf_dir, "events")
    user = F.col("user_id")
    large = F.lit((1 << 53) + 1) + user
    shapes = [
        {"amount": user, "level": user, "ident": large, "removed": F.lit("x")},
        {"amount": user + F.lit(0.5), "level": user + F.lit(0.25), "ident": user + F.lit(0.5)},
        {"amount": F.concat(F.lit("n"), user.cast("string")), "level": user, "ident": large, "added": user},
    ]
    for k, fields in enumerate(shapes):
        payload = F.to_json(F.struct(F.col("event_id").alias("id"), *[c.alias(n) for n, c in fields.items()]))
        records = events.filter(F.col("event_id") % 3 == k).select(
            F.lit("shop").alias("source_api"), payload.alias("payload"), views.arrival_ms(F.col("ts")).alias("received_at")
        )
        write_external_parquet(external.external_transform(_landed(spark, records)), target)
    return read_external_table(spark, target).select("id", "amount", "level", "ident", "removed", "added")


@query("external_array_payload", f"""
SELECT event_type || '-api' AS _source_api, {SQL_ARRIVAL_MS} AS _received_at,
       '[' || event_id || ',' || user_id || ']' AS data_payload FROM events""")
def external_array_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed(spark, views.array_records(spark, sf_dir))
    return external.normalize_columns(external.payload_as_json(landed))


@query("scalarize_for_jdbc", f"""
SELECT event_type || '-api' AS _source_api, {SQL_ARRIVAL_MS} AS _received_at, user_id AS n_x_k,
       '{{"z":1}}' AS n_x_d, event_id AS order_id, '[' || user_id || ']' AS l, event_type AS my_field
FROM events""")
def scalarized(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed(spark, views.nested_records(spark, sf_dir))
    flat = external.normalize_columns(external.flatten_payload(landed))
    return external.scalarize_for_jdbc(flat)


@query("external_rejects", """
SELECT page_id, 'payload is not JSON' AS reject_reason FROM pages""")
def external_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages sent as payloads are not JSON; events in the same feed are."""
    pages = views.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("payload"))
    events = views.table(spark, sf_dir, "events").select(F.col("props").alias("payload"))
    feed = pages.unionByName(events, allowMissingColumns=True)
    return external.flag_external(feed).filter(F.col("reject_reason").isNotNull()).drop("payload")
