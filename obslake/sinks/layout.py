"""Write layout shared by the file sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from obslake.functions.names import quoted
from obslake.operators.dimension import left_join_dimension
from obslake.session import cut_lineage

# Size that files of a directory grow to before the next one is begun.
FILE_BYTES = 128 * 1024 * 1024


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even, full-size output files per directory.

    One shuffle on the directory columns; adaptive execution merges small
    partitions and splits those of a hot directory.
    """
    return df.hint("rebalance", *columns)


def clustered(df: DataFrame, columns: list[str], size: Column, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rows dealt so that a directory is written by one task, or by one for each ``file_bytes`` it holds.

    ``size`` is what a row takes in the file.  One aggregation measures the directories; only those
    above ``file_bytes`` are cut, by a hash of the row, so a retried task deals its rows the same
    way.  Then one shuffle brings each piece to a single task, and each piece becomes one file.
    """
    spark = df.sparkSession
    names = [f"_dir_{c}" for c in columns]
    keyed = df.withColumn("_dir", F.to_json(F.struct(*[F.col(quoted(c)).alias(n) for c, n in zip(columns, names)])))
    measured = cut_lineage(keyed.groupBy("_dir").agg(F.sum(size).alias("_bytes")))
    total = measured.agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"), F.count("*").alias("dirs")).first()
    hot = measured.where(F.col("_bytes") > file_bytes).select("_dir", F.ceil(F.col("_bytes") / file_bytes).alias("_files"))
    piece = F.lit(0)
    if not hot.isEmpty():
        keyed = left_join_dimension(keyed, hot, "_dir", spread_by=df.columns)
        piece = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in df.columns]), F.coalesce("_files", F.lit(1)))
    full = -(-total["bytes"] // file_bytes)
    # Twice as many tasks as full files, so that few get two of them; small directories share tasks.
    tasks = max(1, min(total["dirs"] + full, max(2 * full, spark.sparkContext.defaultParallelism)))
    return keyed.withColumn("_piece", piece).repartition(tasks, "_dir", "_piece").select(*[F.col(quoted(c)) for c in df.columns])


def append_partitioned(df: DataFrame, path: str, columns: list[str], rebalance: bool = False) -> None:
    """Append Parquet under ``column=value`` directories.

    ``rebalance`` is off by default: the landing trees are laid out by time and
    source, so a task sees few directories and a shuffle of the input would cost more than it saves.
    """
    out = rebalanced(df, *columns) if rebalance else df
    out.write.mode("append").partitionBy(*columns).parquet(path)
