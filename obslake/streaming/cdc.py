"""Change feed on a stream: a folded snapshot kept in files, by buckets of services.

A version writes only the buckets its changes touch, as ``version=<n>/bucket=<k>``.  The file
``pointers/<n>`` names for each bucket the version that holds it; it appears in one step, so readers
see a version whole or not at all.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.functions.text import is_blank
from obslake.operators.cdc import fold_cdc
from obslake.schemas import METADATA, SERVICE_METADATA
from obslake.sinks.paths import child_names, exists, modified_seconds, read_text, remove, write_whole

# A version goes this long after the next one replaced it: longer than any micro-batch that reads it may take.
KEEP_SECONDS = 6 * 3600.0
# Buckets of a new snapshot; one that exists keeps the number it began with.
BUCKETS = 64
_POINTERS = "pointers"


def _name(version: int) -> str:
    return f"{version:020d}"


def _pointers(spark: SparkSession, path: str) -> list[str]:
    return [n for n in child_names(spark, f"{path}/{_POINTERS}") if n.isdigit()]


def _pointer(spark: SparkSession, path: str, name: str) -> dict:
    return json.loads(read_text(spark, f"{path}/{_POINTERS}/{name}"))


def _read(spark: SparkSession, path: str, held: dict[str, str]) -> DataFrame:
    if not held:
        return spark.createDataFrame([], SERVICE_METADATA)
    folders = [f"{path}/version={version}/bucket={bucket}" for bucket, version in sorted(held.items())]
    return spark.read.schema(SERVICE_METADATA).parquet(*folders)


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot; empty before the first change."""
    names = _pointers(spark, path)
    return _read(spark, path, _pointer(spark, path, names[-1])["held"] if names else {})


def apply_changes(
    batch: DataFrame,
    path: str,
    batch_id: int,
    order_by: list[str],
    keep_seconds: float = KEEP_SECONDS,
    buckets: int = BUCKETS,
) -> None:
    """Fold one micro-batch of changes into the next snapshot version.

    Reads and writes the buckets of the services that changed, and no others.  A repeat of a
    micro-batch whose version is complete does nothing; one that stopped before writes its version
    again.  Snapshot rows enter the fold with null order columns, so any change beats them.  Changes
    without a service id are skipped.  What a version alone holds is deleted ``keep_seconds`` after
    the next one was complete.
    """
    spark = batch.sparkSession
    if exists(spark, f"{path}/{_POINTERS}/{_name(batch_id)}"):
        return
    before = [n for n in _pointers(spark, path) if n < _name(batch_id)]
    known = _pointer(spark, path, before[-1]) if before else {"buckets": buckets, "held": {}}
    bucket = F.pmod(F.xxhash64("service_id"), F.lit(known["buckets"])).cast("int").alias("bucket")
    cached = batch.filter(~is_blank(F.col("service_id"))).persist()
    try:
        touched = {str(r.bucket) for r in cached.select(bucket).distinct().collect()}
        if touched:
            _write_version(cached, path, _name(batch_id), known, touched, bucket, order_by)
            _forget(spark, path, keep_seconds)
    finally:
        cached.unpersist()


def _write_version(batch: DataFrame, path: str, name: str, known: dict, touched: set[str], bucket, order_by: list[str]) -> None:
    spark = batch.sparkSession
    old = _read(spark, path, {b: v for b, v in known["held"].items() if b in touched})
    changes = batch.select("op", "service_id", *METADATA, *order_by).unionByName(
        old.withColumn("op", F.lit("r")), allowMissingColumns=True
    )
    rows = fold_cdc(changes, order_by).select("*", bucket)
    out = f"{path}/version={name}"
    rows.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
    # A bucket whose services are all deleted has no folder.
    written = {n.removeprefix("bucket="): name for n in child_names(spark, out) if n.startswith("bucket=")}
    held = {b: v for b, v in known["held"].items() if b not in touched} | written
    write_whole(spark, f"{path}/{_POINTERS}/{name}", json.dumps({"buckets": known["buckets"], "held": held}))


def _forget(spark: SparkSession, path: str, keep_seconds: float) -> None:
    """Delete pointers that were replaced long ago, and the buckets that only they name."""
    names = _pointers(spark, path)
    # The one before the newest stays in any case: it may just be read.
    old = [
        name
        for name, newer in zip(names[:-2], names[1:])
        if time.time() - modified_seconds(spark, f"{path}/{_POINTERS}/{newer}") > keep_seconds
    ]
    if not old:
        return
    needed = {item for n in names if n not in old for item in _pointer(spark, path, n)["held"].items()}
    versions = {v for _, v in needed}
    for name in old:
        for bucket, version in _pointer(spark, path, name)["held"].items():
            if version not in versions:
                remove(spark, f"{path}/version={version}")
            elif (bucket, version) not in needed:
                remove(spark, f"{path}/version={version}/bucket={bucket}")
        remove(spark, f"{path}/{_POINTERS}/{name}")


def start_cdc_snapshot(changes: DataFrame, path: str, checkpoint: str, order_by: list[str], trigger: dict | None = None):
    """Keep the snapshot below ``path`` up to date with a stream of changes."""
    return (
        changes.writeStream.foreachBatch(lambda batch, n: apply_changes(batch, path, n, order_by))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
