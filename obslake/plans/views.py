"""The driver's tables in the shapes the operators take.

Each derivation is given twice: as a DataFrame, and as the body of a SQL common
table expression for the checker (``SQL``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.functions.times import instant_from_ntz
from obslake.operators.ingest import encode_json
from obslake.schemas import METADATA

SQL: dict[str, str] = {}


def with_sql(*names: str, body: str) -> str:
    """A statement with the named view definitions in front."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _service(column: str):
    return F.concat(F.lit("svc-"), F.col(column).cast("string"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metrics; ``arrival`` is their order on the topic."""
    ts = instant_from_ntz(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric_name"),
        "value",
        F.lit("count").alias("unit"),
        _service("user_id").alias("service_id"),
        F.lit(None).cast("map<string,string>").alias("tags"),
        ts.alias("timestamp"),
        F.unix_millis(ts).alias("timestamp_ms"),
        F.col("event_id").alias("arrival"),
    )


SQL["metrics"] = """
SELECT event_type AS metric_name, value, 'svc-' || user_id AS service_id,
       epoch_us(ts) // 1000 AS timestamp_ms, event_id AS arrival
FROM events"""


def labelled_metrics(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Events as metrics that carry their own, changing, metadata."""
    ts = instant_from_ntz(F.col("ts"))
    environment = F.when(F.col("value") > 100, "production").when(F.col("value") > 30, "staging")
    rows = table(spark, sf_dir, "events") if rows is None else rows
    return rows.select(
        F.col("event_type").alias("metric_name"),
        "value",
        _service("user_id").alias("service_id"),
        F.unix_millis(ts).alias("timestamp_ms"),
        F.col("event_id").alias("arrival"),
        F.col("props").alias("service_name"),
        environment.alias("environment"),
    )


SQL["labelled_metrics"] = """
SELECT event_type AS metric_name, value, 'svc-' || user_id AS service_id,
       epoch_us(ts) // 1000 AS timestamp_ms, event_id AS arrival, props AS service_name,
       CASE WHEN value > 100 THEN 'production' WHEN value > 30 THEN 'staging' END AS environment
FROM events"""


def sales_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as metrics of their supplier."""
    ts = instant_from_ntz(F.col("l_shipdate"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("sales."), "l_returnflag").alias("metric_name"),
        F.col("l_extendedprice").alias("value"),
        _service("l_suppkey").alias("service_id"),
        F.unix_millis(ts).alias("timestamp_ms"),
    )


SQL["sales_metrics"] = """
SELECT 'sales.' || l_returnflag AS metric_name, l_extendedprice AS value,
       'svc-' || l_suppkey AS service_id, epoch_us(l_shipdate) // 1000 AS timestamp_ms
FROM lineitem"""


def service_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as services; the team is null for those in debt."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left").join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    )
    return joined.select(
        _service("s_suppkey").alias("service_id"),
        F.col("s_name").alias("service_name"),
        F.when(F.col("s_acctbal") >= 0, F.col("n_name")).alias("team"),
        F.when(F.col("s_acctbal") > 5000, "production").otherwise("staging").alias("environment"),
        F.col("r_name").alias("region"),
    )


SQL["service_metadata"] = """
SELECT 'svc-' || s_suppkey AS service_id, s_name AS service_name,
       CASE WHEN s_acctbal >= 0 THEN n_name END AS team,
       CASE WHEN s_acctbal > 5000 THEN 'production' ELSE 'staging' END AS environment,
       r_name AS region
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
     LEFT JOIN region ON n_regionkey = r_regionkey"""


def cdc_changes(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Orders as changes of their customer's service, by order date and key."""
    ts = instant_from_ntz(F.col("o_orderdate"))
    status = F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders") if rows is None else rows
    return rows.select(
        F.when(status == "F", "d").when(status == "P", "u").alias("op"),
        _service("o_custkey").alias("service_id"),
        F.concat(F.lit("Release "), F.col("o_orderkey").cast("string")).alias("service_name"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_orderpriority")).alias("team"),
        F.when(F.col("o_totalprice") > 250000, F.lit("canary")).alias("environment"),
        F.lit(None).cast("string").alias("region"),
        F.unix_millis(ts).alias("timestamp_ms"),
        F.col("o_orderkey").alias("seq"),
    )


SQL["cdc_changes"] = """
SELECT CASE o_orderstatus WHEN 'F' THEN 'd' WHEN 'P' THEN 'u' END AS op,
       'svc-' || o_custkey AS service_id, 'Release ' || o_orderkey AS service_name,
       CASE WHEN o_totalprice > 100000 THEN o_orderpriority END AS team,
       CASE WHEN o_totalprice > 250000 THEN 'canary' END AS environment,
       CAST(NULL AS VARCHAR) AS region,
       epoch_us(o_orderdate) // 1000 AS timestamp_ms, o_orderkey AS seq
FROM orders"""

SQL["cdc_snapshot"] = """
SELECT service_id, service_name, team, environment, region FROM (
  SELECT *, row_number() OVER (PARTITION BY service_id ORDER BY timestamp_ms DESC, seq DESC) AS rn
  FROM cdc_changes)
WHERE rn = 1 AND coalesce(lower(op), '') <> 'd'"""


def _iso(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


_SQL_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(extract('millisecond' FROM ts) % 1000 AS VARCHAR), 3, '0') || 'Z'"


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixed log stream: event lines of several shapes, and chat turns line by line.

    Only the first line of a turn has a log header; the others are plain text.
    """
    kind = F.col("event_type")
    user, service = F.col("user_id").cast("string"), _service("user_id")
    iso = _iso(F.col("ts"))
    events = table(spark, sf_dir, "events").select(
        F.when(kind == "view", F.concat(F.lit("noise "), F.col("event_id").cast("string")))
        .when(kind == "click", F.concat(F.lit("junk "), iso, F.lit(" [INFO] ["), service, F.lit("] user "), user))
        .when(kind == "signup", F.concat(F.lit("2024-13-45T00:00:00Z [WARN] ["), service, F.lit("] bad date "), user))
        .otherwise(F.concat(F.lit("\t "), iso, F.lit(" ["), kind, F.lit("] ["), service, F.lit("] user "), user, F.lit(" ")))
        .alias("value")
    )
    age = F.make_dt_interval(secs=(F.col("conv_id") * 60 + F.col("turn")).cast("decimal(18,6)"))
    started = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + age
    header = F.concat(_iso(started), F.lit(" ["), F.col("role"), F.lit("] [chat-"), F.col("conv_id").cast("string"), F.lit("] "))
    turns = table(spark, sf_dir, "conversations").select(
        F.explode(F.split(F.concat(header, F.col("text")), "\n")).alias("value")
    )
    return events.unionByName(turns)


SQL["log_lines"] = f"""
SELECT CASE event_type
         WHEN 'view' THEN 'noise ' || event_id
         WHEN 'click' THEN 'junk ' || {_SQL_ISO} || ' [INFO] [svc-' || user_id || '] user ' || user_id
         WHEN 'signup' THEN '2024-13-45T00:00:00Z [WARN] [svc-' || user_id || '] bad date ' || user_id
         ELSE chr(9) || ' ' || {_SQL_ISO} || ' [' || event_type || '] [svc-' || user_id || '] user ' || user_id || ' '
       END AS value
FROM events
UNION ALL
SELECT unnest(string_split({_SQL_ISO} || ' [' || role || '] [chat-' || conv_id || '] ' || text, chr(10))) AS value
FROM (SELECT *, make_timestamp((1704067200 + conv_id * 60 + turn) * 1000000) AS ts FROM conversations)"""


def arrival_ms(ts):
    return F.unix_millis(instant_from_ntz(ts))


SQL_ARRIVAL_MS = "(epoch_us(ts) // 1000)"


def external_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as payloads of a source per event type."""
    return table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit('"api\\1')).alias("source_api"),
        F.col("props").alias("payload"),
        arrival_ms(F.col("ts")).alias("received_at"),
    )


SQL["external_records"] = f"""
SELECT event_type || '"api\\1' AS source_api, props AS payload, {SQL_ARRIVAL_MS} AS received_at
FROM events"""


def array_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as payloads that are arrays."""
    return table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("-api")).alias("source_api"),
        F.to_json(F.array("event_id", "user_id")).alias("payload"),
        arrival_ms(F.col("ts")).alias("received_at"),
    )


def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as payloads with awkward field names and three levels of nesting."""
    payload = F.to_json(
        F.struct(
            F.col("event_id").alias("Order-Id"),
            F.struct(F.col("user_id").alias("K"), F.struct(F.lit(1).alias("z")).alias("d")).alias("N.x"),
            F.array(F.col("user_id")).alias("l"),
            F.col("event_type").alias("my field"),
        )
    )
    return table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("-api")).alias("source_api"),
        payload.alias("payload"),
        arrival_ms(F.col("ts")).alias("received_at"),
    )


def metric_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric JSON text, some with a missing, bad or quoted number or a blank name."""
    n = F.col("event_id")
    value = (
        F.when(n % 13 == 0, F.lit(""))
        .when(n % 11 == 0, F.lit('"value":"bad",'))
        .when(n % 10 == 0, F.concat(F.lit('"value":"'), n.cast("string"), F.lit('",')))
        .otherwise(F.concat(F.lit('"value":'), n.cast("string"), F.lit(",")))
    )
    name = F.when(n % 17 == 0, F.lit(" ")).otherwise(F.col("event_type"))
    text = F.concat(
        F.lit('{"metricName":"'), name, F.lit('",'), value,
        F.lit('"serviceId":"svc-'), F.col("user_id").cast("string"),
        F.lit('","extra":true,"timestamp":"'), _iso(F.col("ts")), F.lit('"}'),
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("value"))


SQL["metric_json"] = f"""
SELECT event_id, '{{"metricName":"' || CASE WHEN event_id % 17 = 0 THEN ' ' ELSE event_type END || '",'
  || CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 11 = 0 THEN '"value":"bad",'
          WHEN event_id % 10 = 0 THEN '"value":"' || event_id || '",' ELSE '"value":' || event_id || ',' END
  || '"serviceId":"svc-' || user_id || '","extra":true,"timestamp":"' || {_SQL_ISO} || '"}}' AS value
FROM events"""

SQL["decoded_json"] = """
SELECT event_id, json_extract_string(value, '$.metricName') AS metric_name,
       json_extract_string(value, '$.value') AS number,
       coalesce(TRY_CAST(json_extract_string(value, '$.value') AS DOUBLE), 0.0) AS value,
       json_extract_string(value, '$.serviceId') AS service_id,
       epoch_us(CAST(replace(json_extract_string(value, '$.timestamp'), 'Z', '') AS TIMESTAMP)) // 1000 AS timestamp_ms
FROM metric_json"""


def json_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric JSON text in request bodies of five elements."""
    return (
        metric_json(spark, sf_dir)
        .groupBy(F.floor(F.col("event_id") / 5).alias("batch"))
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "value"))).alias("items"))
        .select("batch", F.concat(F.lit("["), F.array_join("items.value", ","), F.lit("]")).alias("body"))
    )


SQL["json_batches"] = """
SELECT event_id // 5 AS batch, '[' || string_agg(value, ',' ORDER BY event_id) || ']' AS body
FROM metric_json GROUP BY 1"""


def log_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chat turn as a JSON array of its lines."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.to_json(F.split(F.concat(F.lit(" "), "text"), "\n")).alias("body")
    )


def mixed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays that mix objects, numbers, quoted numbers, null and nested arrays."""
    n = F.col("event_id").cast("string")
    body = F.concat(
        F.lit('[{"id":'), n, F.lit(',"b":1,"a":"'), F.col("event_type"), F.lit('"},"'), n,
        F.lit('",'), n, F.lit(",null,true,[1,"), n, F.lit("]]"),
    )
    return table(spark, sf_dir, "events").select("event_id", body.alias("body"))


SQL["mixed_batches"] = """
SELECT event_id, '[{"id":' || event_id || ',"b":1,"a":"' || event_type || '"},"' || event_id || '",'
  || event_id || ',null,true,[1,' || event_id || ']]' AS body FROM events"""


def broken_batches(spark: SparkSession, sf_dir: str, good: str, bad: str) -> DataFrame:
    """Request bodies that are, in turn, good, with a bad element, cut off, not an array, and null.

    ``good`` is a SQL expression for an element, ``bad`` the text of one.
    """
    n = F.col("event_id") % 5
    element = F.expr(good)
    body = (
        F.when(n == 0, F.concat(F.lit("["), element, F.lit("]")))
        .when(n == 1, F.concat(F.lit("["), element, F.lit(f",{bad}]")))
        .when(n == 2, F.concat(F.lit("["), element, F.lit(',{"a":')))
        .when(n == 3, F.concat(F.lit('{"a":'), F.col("event_id").cast("string"), F.lit("}")))
    )
    return table(spark, sf_dir, "events").select("event_id", body.alias("body"))


def user_event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as user-event requests; several fields are missing or blank on some of them."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("u-"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(F.col("o_totalprice") > 1000, F.col("o_orderpriority")).otherwise(" \t").alias("event_type"),
        F.when(status != "P", F.unix_millis(instant_from_ntz(F.col("o_orderdate")))).alias("timestamp_ms"),
        F.when(F.col("o_totalprice") < 490000, F.concat(F.lit("svc-"), status)).alias("service_id"),
        F.when(status == "O", F.col("o_orderkey").cast("string")).alias("session_id"),
        F.when(status == "F", "production").alias("environment"),
        F.when(status == "F", F.create_map(F.lit("status"), status)).alias("properties"),
    )


SQL["user_event_requests"] = """
SELECT 'u-' || o_custkey AS user_id,
       CASE WHEN o_totalprice > 1000 THEN o_orderpriority ELSE ' ' || chr(9) END AS event_type,
       CASE WHEN o_orderstatus <> 'P' THEN epoch_us(o_orderdate) // 1000 END AS timestamp_ms,
       CASE WHEN o_totalprice < 490000 THEN 'svc-' || o_orderstatus END AS service_id,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey AS VARCHAR) END AS session_id,
       CASE WHEN o_orderstatus = 'F' THEN 'production' END AS environment,
       CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS status
FROM orders"""


def cdc_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed as JSON text: updates flat, other changes in a before/after envelope."""
    changes = cdc_changes(spark, sf_dir)
    flat = encode_json(
        changes, "service_id",
        {"op": "op", "serviceId": "service_id", "serviceName": "service_name", "team": "team", "environment": "environment", "region": "region"},
    )
    row = F.struct("service_id", *METADATA)
    nested = changes.select(
        F.col("service_id").alias("key"),
        F.to_json(
            F.struct(
                F.coalesce("op", F.lit("c")).alias("op"),
                F.when(F.col("op") == "d", row).alias("before"),
                F.when(F.col("op").isNull(), row).alias("after"),
            )
        ).alias("value"),
        "op",
    )
    return flat.filter(F.get_json_object("value", "$.op") == "u").unionByName(
        nested.filter(~F.col("op").eqNullSafe(F.lit("u"))).drop("op")
    )
