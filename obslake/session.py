"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
# Settings the operators are written for; a cluster may override any of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_local_dirs: dict[str, str] = {}


def build_session(app_name: str, extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the project settings, overridden or extended by ``extra``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a plain local master may fall back to a temporary folder: there the driver
    and the executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="obslake-")
    return _local_dirs[app]


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, whatever the session is set to.

    A new stream has no more than ``partitions`` parts of its state; one that goes on keeps its number.
    A stream takes the settings over when it starts; those of the session are as before afterwards.
    """
    settings = {STATE_STORE: SETTINGS[STATE_STORE]}
    if partitions:
        settings[PARTITIONS] = str(min(partitions, int(spark.conf.get(PARTITIONS))))
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result feeds several consumers: the written table survives the
    loss of executors and is computed once.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
