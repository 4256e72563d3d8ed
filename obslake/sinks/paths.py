"""Existence checks on the file system behind a path."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a Parquet write to ``path`` has committed."""
    return exists(spark, f"{path}/_SUCCESS")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder; empty when it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def modified_seconds(spark: SparkSession, path: str) -> float:
    """When a file was last written, in seconds since the epoch."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).getModificationTime() / 1000


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A small new file that appears in one step: written beside its place, then renamed.

    Names with a leading dot are hidden files; readers of the folder look for names of their own form.
    """
    folder, name = path.rsplit("/", 1)
    beside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    write_text(spark, beside, text)
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside, path))
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, target):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Paths that match a pattern, and when each was last written, in seconds since the epoch."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [(s.getPath().toString(), s.getModificationTime() / 1000) for s in found or []]
