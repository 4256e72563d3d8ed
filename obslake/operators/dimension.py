"""Left join of a large stream of rows with a lookup table keyed by one column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from obslake.session import cut_lineage

# A lookup table is broadcast only when its measured size stays below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# In shuffled joins a key with more rows than this is spread over several tasks.
ROWS_PER_TASK = 5_000_000
# At most this many keys can be hot, whatever the data: the bound for broadcasting them.
MAX_HOT_KEYS = 100_000
# Rows without a key match nothing and are spread over this many tasks.
NULL_SALTS = 65_536


def per_row(df: DataFrame) -> list[str]:
    """The columns that tell rows apart in a salt: all that can be hashed."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]


def measured_bytes(df: DataFrame) -> int:
    """In-memory size estimate from one aggregation over the rows.

    Text and binary columns count their bytes, other columns eight bytes, and
    every column sixteen bytes of overhead.
    """
    sizes = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)))
        elif isinstance(field.dataType, (T.StructType, T.MapType, T.ArrayType)):
            sizes.append(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))))
        else:
            sizes.append(F.lit(8))
    row: Column = F.lit(16 * (len(sizes) + 1)).cast("bigint")
    for size in sizes:
        row = row + size
    return int(df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()["b"])


def hot_keys(facts: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """``(key, _salts)`` of the keys that need several tasks; None when there are none.

    Counting is combined per task before its shuffle.  A hot key has more than
    ``total / MAX_HOT_KEYS`` rows, so there are fewer of them than ``MAX_HOT_KEYS``.
    """
    counts = cut_lineage(facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    size = max(rows_per_task, -(-total // MAX_HOT_KEYS))
    hot = counts.filter(F.col("_n") > size).select(key, F.ceil(F.col("_n") / size).cast("int").alias("_salts"))
    return None if hot.isEmpty() else hot


def with_salt(facts: DataFrame, key: str, hot: DataFrame | None, spread_by: list[str]) -> DataFrame:
    """Add ``_salt``, the part of its key a row belongs to.

    It comes from a hash of ``spread_by`` and not from a random number, so a
    retried task places its rows the same way.
    """
    part = F.xxhash64(*spread_by)
    alone = F.pmod(part, F.lit(NULL_SALTS))
    if hot is None:
        return facts.withColumn("_salt", F.when(F.col(key).isNull(), alone).otherwise(0).cast("int"))
    salt = F.when(F.col(key).isNull(), alone).otherwise(F.pmod(part, F.coalesce("_salts", F.lit(1))))
    return facts.join(F.broadcast(hot), key, "left").withColumn("_salt", salt.cast("int")).drop("_salts")


def repeated_for_salts(dimension: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Repeat the rows of hot keys once per salt; other rows have the one salt 0."""
    if hot is None:
        return dimension.withColumn("_salt", F.lit(0))
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return dimension.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(salts)).drop("_salts")


def left_join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: list[str],
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join on ``key``; the dimension has at most one row per key.

    Up to ``limit_bytes`` the dimension is broadcast, so the facts do not move.
    Above it both sides are shuffled on ``(key, salt)``: a hot key is spread over
    as many tasks as its row count asks for, its dimension row going to each of
    them, and rows without a key are spread as well.
    """
    if measured_bytes(dimension) <= limit_bytes:
        return facts.join(F.broadcast(dimension), key, "left")
    hot = hot_keys(facts, key, rows_per_task)
    salted = with_salt(facts, key, hot, spread_by)
    return salted.join(repeated_for_salts(dimension, key, hot), [key, "_salt"], "left").drop("_salt")
