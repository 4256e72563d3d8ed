"""A table with one row per key, kept as versions: writes follow the batch, reads take the newest row.

Every batch adds directories of its own, ``<partitions>/version=<number>``, so what it writes is in
proportion to its rows.  While a version is being written its name stands in ``_pending``, and readers
leave it out.  Compaction writes the newest rows of a directory as one more version and removes those it
stands for later, so the table reads the same before, in between and afterwards.  There is one writer at a time.
"""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obslake.session import cut_lineage
from obslake.sinks.layout import clustered
from obslake.sinks.paths import child_names, exists, matching, read_text, remove, write_text

VERSION = "version"
_PENDING = "_pending"
_COMPACTED = "c"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# A version goes this long after compaction replaced it: longer than any reader may take.
KEEP_SECONDS = 6 * 3600.0


def next_version(spark: SparkSession, attempt: str | None = None) -> str:
    """A version above all earlier ones; the same one for every attempt that names the same file."""
    if attempt and exists(spark, attempt):
        return read_text(spark, attempt)
    version = f"{time.time_ns() // 1000:020d}"
    if attempt:
        write_text(spark, attempt, version)
    return version


def publish(rows: DataFrame, table: str, partitions: tuple[str, ...], key: list[str], version: str) -> None:
    """Write ``rows`` as ``version``; a repeat replaces what an earlier attempt wrote."""
    spark = rows.sparkSession
    pending = f"{table}/{_PENDING}/{version}"
    if not exists(spark, pending):
        write_text(spark, pending, "")
    # Measured and then dealt by directory: a batch may touch many hours, each with few rows.
    rows = cut_lineage(rows)
    size = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8) for f in rows.schema.fields), F.lit(0))
    # A key is looked up by name: Bloom filters tell which row groups lack it where a dictionary does not
    # pay.  Each takes the smallest of several sizes that holds its names, from about 1 KB to 1 MB.
    named = [c for c in key if isinstance(rows.schema[c].dataType, T.StringType)]
    lookup = {f"parquet.bloom.filter.{o}#{c}": v for c in named for o, v in (("enabled", "true"), ("candidates.number", "12"))}
    writer = (
        clustered(rows, list(partitions), size)
        .sortWithinPartitions(*partitions, *key)
        .withColumn(VERSION, F.lit(version))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**lookup, **{"parquet.bloom.filter.adaptive.enabled": "true"})
    )
    writer.partitionBy(*partitions, VERSION).parquet(table)
    remove(spark, pending)


def _newest(rows: DataFrame, schema: T.StructType, partitions: list[str], key: list[str]) -> DataFrame:
    """The last version of every key.

    The partitions are part of the grouping, so filters on them reach the scan; each column has an
    aggregate of its own, so those that nobody asks for are not read.
    """
    number = F.coalesce(F.regexp_replace(VERSION, f"{_COMPACTED}$", "").cast("long") * 2 + F.endswith(VERSION, F.lit(_COMPACTED)).cast("int"), F.lit(0))
    rows = rows.withColumn("_number", number.cast("long"))
    last = [F.max_by(c, "_number").alias(c) for c in schema.names if c not in key]
    return rows.groupBy(*partitions, *key).agg(*last).select(*schema.names, *partitions)


def folders_between(spark: SparkSession, table: str, levels: Sequence[str], first: Sequence | None, last: Sequence | None) -> list[str]:
    """The folders that hold all directories of a table from ``first`` to ``last``, both included.

    The bounds have a value (a date or an integer) for each of ``levels``, outermost first; None is no
    bound.  Only folders at either end are opened, so a range of many days lists the days and the
    hours of two of them.  One that is not divided further is taken whole.
    """
    column, inner = levels[0], levels[1:]
    found = []
    for name in child_names(spark, table):
        text = name.removeprefix(f"{column}=")
        if text in (name, _NO_VALUE):
            continue
        value = int(text) if text.lstrip("-").isdigit() else date.fromisoformat(text)
        if (first and value < first[0]) or (last and value > last[0]):
            continue
        folder = f"{table}/{name}"
        low = first[1:] if first and value == first[0] else None
        high = last[1:] if last and value == last[0] else None
        if inner and (low or high) and any(n.startswith(f"{inner[0]}=") for n in child_names(spark, folder)):
            found += folders_between(spark, folder, inner, low, high)
        else:
            found.append(folder)
    return found


def read_keyed(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partitions: T.StructType,
    key: list[str],
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, with the partition columns; only what is in ``folders`` of the table, if given."""
    stated = T.StructType([*schema.fields, *partitions.fields, T.StructField(VERSION, T.StringType())])
    if folders is not None and not folders:
        return _newest(spark.createDataFrame([], stated), schema, partitions.names, key)
    rows = spark.read.schema(stated).option("basePath", table).parquet(*(folders or [table]))
    pending = child_names(spark, f"{table}/{_PENDING}")
    if pending:
        rows = rows.where(~F.coalesce(F.col(VERSION).isin(pending), F.lit(False)))
    return _newest(rows, schema, partitions.names, key)


def _versions(spark: SparkSession, table: str, partitions: list[str]) -> dict[str, list[tuple[str, float]]]:
    """For each directory its versions in order, each with the time it was written."""
    found: dict[str, list[tuple[str, float]]] = defaultdict(list)
    for path, modified in matching(spark, "/".join([table, *[f"{p}=*" for p in partitions], f"{VERSION}=*"])):
        folder, name = path.rsplit(f"/{VERSION}=", 1)
        found[folder].append((name, modified))
    return {folder: sorted(names) for folder, names in found.items()}


def _live(names: list[tuple[str, float]]) -> list[str]:
    """The versions that still count: the last compacted one and what came after it."""
    compacted = max((n for n, _ in names if n.endswith(_COMPACTED)), default="")
    return [n for n, _ in names if n >= compacted]


def compact(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partitions: T.StructType,
    key: list[str],
    levels: tuple[str, ...],
    keep_seconds: float = KEEP_SECONDS,
) -> int:
    """Bring every directory with several versions down to one; returns how many there were.

    ``levels`` are the partition columns the table is laid out by.  The new version takes the number
    of the last one in it, so rows that come later stay above it.  Versions are removed once the one
    that replaced them is ``keep_seconds`` old.
    """
    for name in child_names(spark, f"{table}/{_PENDING}"):
        if name.endswith(_COMPACTED):
            # Left by a compaction that stopped; nothing refers to it.
            for path, _ in matching(spark, "/".join([table, *[f"{p}=*" for p in levels], f"{VERSION}={name}"])):
                remove(spark, path)
            remove(spark, f"{table}/{_PENDING}/{name}")
    pending = set(child_names(spark, f"{table}/{_PENDING}"))
    live = {f: [n for n in _live(names) if n not in pending] for f, names in _versions(spark, table, list(levels)).items()}
    crowded = {f: names for f, names in live.items() if len(names) > 1}
    if crowded:
        upto = max(n.removesuffix(_COMPACTED) for names in crowded.values() for n in names)
        rows = read_keyed(spark, table, schema, partitions, key, sorted(crowded))
        publish(rows.select(*schema.names, *levels), table, levels, key, upto + _COMPACTED)
    for folder, names in _versions(spark, table, list(levels)).items():
        first = min(_live(names))
        age = time.time() - dict(names)[first]
        if first.endswith(_COMPACTED) and first not in pending and age >= keep_seconds:
            for name in (n for n, _ in names if n < first):
                remove(spark, f"{folder}/{VERSION}={name}")
    return len(crowded)
