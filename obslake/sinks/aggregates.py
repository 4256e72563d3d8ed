"""The aggregate table: keyed upsert, and the Parquet copy by environment and date."""

from __future__ import annotations

import re
import time
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obslake.functions.times import utc_date, utc_hour
from obslake.schemas import AGGREGATE_KEY, METRIC_AGGREGATE, WINDOW_PARTITIONS
from obslake.sinks.keyed import KEEP_SECONDS, compact, next_version, publish
from obslake.sinks.layout import rebalanced
from obslake.sinks.paths import child_names, exists, is_complete, matching, remove, write_text

# Directories of the keyed table.  Minute windows are kept by hour, so that a
# range query opens few files; coarse windows need dates only.
BY_HOUR = ("window_date", "window_hour")
BY_DATE = ("window_date",)
_ROW = METRIC_AGGREGATE.names
# Directories of the Parquet copy, and what marks a batch directory that stands for all before it.
_COPY = ("environment", "window_date")
_MERGED, _PENDING = "m", "_pending"


@dataclass(frozen=True)
class JdbcTarget:
    """An aggregate table in a database; each writing query has a staging table of its own."""

    url: str
    table: str
    query: str
    properties: dict[str, str]
    writers: int = 8

    @property
    def staging(self) -> str:
        return f"{self.table}_staging_{re.sub(r'[^a-z0-9]+', '_', self.query.lower())}"


def with_window_partitions(df: DataFrame, partitions: tuple[str, ...] = BY_HOUR) -> DataFrame:
    ms = F.unix_millis("window_start")
    parts = {"window_date": utc_date(ms), "window_hour": utc_hour(ms)}
    return df.select(*_ROW, *[parts[p].alias(p) for p in partitions])


def last_per_key(batch: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One row per aggregate key: the last by ``order_by``, else the one that counted most events."""
    rest = [c for c in _ROW if c not in AGGREGATE_KEY]
    order = order_by or ["count_value", *[c for c in rest if c != "count_value"]]
    return (
        batch.groupBy(*AGGREGATE_KEY)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select(*[F.col(f"_last.{c}").alias(c) if c in rest else F.col(c) for c in _ROW])
    )


def upsert_aggregates(
    batch: DataFrame,
    table: str,
    stage: str | None = None,
    order_by: list[str] | None = None,
    partitions: tuple[str, ...] = BY_HOUR,
) -> None:
    """Insert rows, or replace all non-key columns of those already in the Parquet table.

    The rows become a new version beside those that are stored (see ``sinks.keyed``), so a
    micro-batch writes what it brings and nothing else, and reads nothing of the table.  Pass a
    ``stage`` path that is the same for every attempt of one micro-batch: a repeat then replaces
    the version of the attempt before.
    """
    spark = batch.sparkSession
    rows = with_window_partitions(last_per_key(batch, order_by), partitions)
    publish(rows, table, partitions, AGGREGATE_KEY, next_version(spark, f"{stage}/version" if stage else None))


def compact_aggregates(
    spark: SparkSession, table: str, partitions: tuple[str, ...] = BY_HOUR, keep_seconds: float = KEEP_SECONDS
) -> int:
    """One version for every hour (or date) that has several; returns how many there were."""
    return compact(spark, table, METRIC_AGGREGATE, WINDOW_PARTITIONS, AGGREGATE_KEY, partitions, keep_seconds)


def write_aggregates_parquet(batch: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Parquet copy under ``environment=/window_date=``; a null environment goes to ``unknown``.

    With ``batch_id`` the rows go to a directory of that micro-batch, and a
    repeated micro-batch replaces its own files instead of adding to them.
    """
    out = batch.select(*_ROW, utc_date(F.unix_millis("window_start")).alias("window_date")).withColumn(
        "environment", F.coalesce("environment", F.lit("unknown"))
    )
    columns = list(_COPY)
    if batch_id is None:
        rebalanced(out, *columns).write.mode("append").partitionBy(*columns).parquet(path)
        return
    (
        rebalanced(out.withColumn("batch_id", F.lit(batch_id)), *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns, "batch_id")
        .parquet(path)
    )


def _copy_batches(spark: SparkSession, path: str) -> dict[str, dict[str, tuple[str, float]]]:
    """For each directory of the copy its micro-batches in order, each with its folder and the time it was written.

    A merged one comes after all it stands for and before any that came later.  One that is still
    being written is left out.
    """
    pending = set(child_names(spark, f"{path}/{_PENDING}"))
    found: dict[str, dict[str, tuple[str, float]]] = defaultdict(dict)
    for folder, modified in matching(spark, "/".join([path, *[f"{c}=*" for c in _COPY], "batch_id=*"])):
        directory, batch = folder.rsplit("/batch_id=", 1)
        if batch not in pending:
            found[directory][batch] = (folder, modified)
    return {d: dict(sorted(b.items(), key=lambda i: _place(i[0]))) for d, b in found.items()}


def _place(batch: str) -> tuple[int, bool]:
    return int(batch.removesuffix(_MERGED)), batch.endswith(_MERGED)


def _counting(batches: dict[str, tuple[str, float]]) -> list[str]:
    """The micro-batches of a directory that a reader takes: the last merged one and what came after it."""
    names = list(batches)
    last = max((i for i, n in enumerate(names) if n.endswith(_MERGED)), default=0)
    return names[last:]


def read_aggregates_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet copy, with its date; each row once, before, during and after it is merged.

    Rows that were written without a micro-batch are read as well.
    """
    stated = T.StructType([*METRIC_AGGREGATE.fields, T.StructField("window_date", T.DateType())])
    folders = [b[n][0] for b in _copy_batches(spark, path).values() for n in _counting(b)]
    plain = [f for f, _ in matching(spark, "/".join([path, *[f"{c}=*" for c in _COPY], "*.parquet"]))]
    read = spark.read.schema(stated).option("basePath", path)
    parts = [read.parquet(*group).select(*_ROW, "window_date") for group in (folders, plain) if group]
    if not parts:
        return spark.createDataFrame([], stated)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merge_aggregates_parquet(
    spark: SparkSession, path: str, before: date | None = None, keep_seconds: float = KEEP_SECONDS
) -> int:
    """Merge the micro-batches of each directory of the copy; returns how many directories had several.

    Takes days earlier than ``before`` (all, if not given) and leaves the newest micro-batch of the
    copy alone, which may be running or be repeated.  The merged rows become one directory more, which
    ``read_aggregates_parquet`` takes in place of the others as soon as all of it is there; the others
    are removed once it is ``keep_seconds`` old.  A run that stopped is undone by the next one.
    """
    for name in child_names(spark, f"{path}/{_PENDING}"):
        for folder, _ in matching(spark, "/".join([path, *[f"{c}=*" for c in _COPY], f"batch_id={name}"])):
            remove(spark, folder)
        remove(spark, f"{path}/{_PENDING}/{name}")
    found = _copy_batches(spark, path)
    newest = max((_place(n)[0] for b in found.values() for n in b), default=0)
    closed = lambda d: before is None or d.rsplit("window_date=", 1)[1] < before.isoformat()
    taken = {d: [n for n in _counting(b) if _place(n)[0] < newest] for d, b in found.items() if closed(d)}
    taken = {d: names for d, names in taken.items() if len(names) > 1}
    if taken:
        upto = f"{max(_place(n)[0] for names in taken.values() for n in names)}{_MERGED}"
        pending = f"{path}/{_PENDING}/{upto}"
        write_text(spark, pending, "")
        stated = T.StructType([*METRIC_AGGREGATE.fields, T.StructField("window_date", T.DateType())])
        rows = spark.read.schema(stated).option("basePath", path).parquet(*[found[d][n][0] for d, names in taken.items() for n in names])
        (
            rebalanced(rows.select(*_ROW, "window_date").withColumn("batch_id", F.lit(upto)), *_COPY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*_COPY, "batch_id")
            .parquet(path)
        )
        remove(spark, pending)
    for batches in _copy_batches(spark, path).values():
        first = _counting(batches)[0]
        if first.endswith(_MERGED) and time.time() - batches[first][1] >= keep_seconds:
            for name in list(batches)[: list(batches).index(first)]:
                remove(spark, batches[name][0])
    return len(taken)


def fan_out(
    batch: DataFrame,
    batch_id: int,
    table: str,
    parquet: str,
    stage_root: str,
    partitions: tuple[str, ...] = BY_HOUR,
    jdbc: JdbcTarget | None = None,
) -> None:
    """One micro-batch of aggregates to the keyed table, to the Parquet copy and, if named, to a database.

    All sinks are written from one staged table, so they agree also when a repeated
    micro-batch would join a newer lookup.  Each sink leaves a mark once it is written; a
    micro-batch that is repeated because it stopped between two sinks goes on with those unmarked.
    """
    spark = batch.sparkSession
    rows = f"{stage_root}/rows={batch_id}"
    if not is_complete(spark, rows):
        batch.select(*_ROW).write.mode("overwrite").parquet(rows)
    staged = spark.read.schema(batch.select(*_ROW).schema).parquet(rows)
    batch_stage = f"{stage_root}/batch={batch_id}"
    sinks: dict[str, Callable[[], None]] = {
        "table": lambda: upsert_aggregates(staged, table, stage=batch_stage, partitions=partitions),
        "copy": lambda: write_aggregates_parquet(staged, parquet, batch_id),
    }
    if jdbc:
        sinks["database"] = lambda: upsert_aggregates_jdbc(staged, jdbc)
    for name, write in sinks.items():
        if not exists(spark, f"{batch_stage}/{name}-written"):
            write()
            write_text(spark, f"{batch_stage}/{name}-written", "")
    # A running micro-batch means that the one before it is committed.
    for name in ("batch", "rows"):
        remove(spark, f"{stage_root}/{name}={batch_id - 1}")


# --- JDBC --------------------------------------------------------------------------


def upsert_statement(table: str, staging: str) -> str:
    """SQL that merges a staging table into the aggregate table by key."""
    columns = ", ".join(_ROW)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in _ROW if c not in AGGREGATE_KEY)
    return (
        f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} "
        f"ON CONFLICT ({', '.join(AGGREGATE_KEY)}) DO UPDATE SET {updates}"
    )


def upsert_aggregates_jdbc(batch: DataFrame, target: JdbcTarget) -> None:
    """Write the batch to the target's staging table in parallel, merge it with one statement, empty it."""
    rows = last_per_key(batch).repartition(target.writers, *AGGREGATE_KEY)
    rows.write.option("truncate", "true").mode("overwrite").jdbc(target.url, target.staging, properties=target.properties)
    jvm = batch.sparkSession._jvm
    login = jvm.java.util.Properties()
    for key, value in target.properties.items():
        login.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(target.url, login)
    try:
        statement = connection.createStatement()
        statement.executeUpdate(upsert_statement(target.table, target.staging))
        statement.executeUpdate(f"DELETE FROM {target.staging}")
    finally:
        connection.close()
