"""Shards that each match the mixture of sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from obslake.llm.columns import group_key, unused, without
from obslake.session import cut_lineage

SHARDS = 24
SEED = 20_240_601
ROWS_PER_BUCKET = 4096
MAX_BUCKETS = 1 << 16


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def interleave(docs: DataFrame, keep: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` of every row, with its ``shard`` (int) and gapless ``slot`` (long).

    Rows are shuffled within their source by a seeded hash of id and text, and ranked.  Row r of
    a source with n rows has the fractional rank (r - 1/2) / n; sorted by it, every stretch of
    the order holds the sources in proportion.  The order is cut into ``shards`` runs whose row
    counts differ by one at most.

    No rank is taken over a whole source: rows fall into buckets, buckets are counted, and rows
    are numbered within their bucket from the count of the buckets before.  A source that holds
    most rows is spread like any other.

    A null source is a source of its own; a null id or text is hashed as such.  Repeated rows
    take neighbouring ranks.  An empty table gives no rows.  Columns of ``docs`` named ``shard``
    or ``slot`` are replaced.
    """
    keep = [c for c in keep if c.lower() not in {"shard", "slot"}]
    stratum, order, bucket, rank, share, place = unused(
        [*docs.columns, "shard", "slot"], "stratum", "order", "bucket", "rank", "share", "place"
    )
    hashed = F.xxhash64(F.lit(seed), "doc_id", "text")
    rows = cut_lineage(docs.select(*keep, group_key(F.col("source")).alias(stratum), hashed.alias(order)))
    total = rows.count()
    buckets = min(MAX_BUCKETS, max(1, -(-total // ROWS_PER_BUCKET)))

    rows = rows.withColumn(bucket, F.pmod(F.col(order), F.lit(buckets)))
    counts = rows.groupBy(stratum, bucket).agg(F.count("*").alias(share))
    whole = Window.partitionBy(stratum)
    before = counts.select(
        stratum,
        bucket,
        F.sum(share).over(whole).alias(share),
        (F.sum(share).over(whole.orderBy(bucket)) - F.col(share)).alias(place),
    )
    rows = (
        rows.withColumn(rank, F.row_number().over(Window.partitionBy(stratum, bucket).orderBy(order)))
        .join(before, [stratum, bucket])
        .withColumn(share, (F.col(place) + F.col(rank) - 0.5) / F.col(share))
        .select(*keep, stratum, order, share)
    )
    rows = cut_lineage(rows).withColumn(bucket, F.floor(F.col(share) * buckets))

    counts = rows.groupBy(bucket).agg(F.count("*").alias(rank))
    # As many rows as there are buckets, MAX_BUCKETS at most.
    before = counts.select(bucket, (F.sum(rank).over(Window.orderBy(bucket)) - F.col(rank)).alias(place))
    number = F.row_number().over(Window.partitionBy(bucket).orderBy(share, stratum, order))
    return (
        rows.withColumn(rank, number)
        .join(F.broadcast(before), bucket)
        .withColumn(place, F.col(place) + F.col(rank) - 1)
        .withColumn(rank, F.expr(f"{place} * {shards} div {max(1, total)}"))
        .select(
            *keep,
            F.col(rank).cast("int").alias("shard"),
            F.expr(f"{place} - ({rank} * {total} + {shards - 1}) div {shards}").cast("long").alias("slot"),
        )
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All rows with all their columns, and the shard and slot of each: the form to write shards from."""
    return interleave(docs, without(docs, "shard", "slot"), shards, seed)


def shard_table(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Where each row goes, without the texts.

    One row per row of ``docs``: ``doc_id``, ``size`` (bytes of the text plus 8), ``text_crc32``
    (0 for a null text), ``law`` (``rows``), ``shard``, ``slot``, ``grown_shard`` (null).
    """
    size, crc = unused(docs.columns, "size", "text_crc32")
    slim = docs.select(
        "doc_id",
        "source",
        "text",
        text_size(F.col("text")).alias(size),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias(crc),
    )
    return interleave(slim, ["doc_id", size, crc], shards, seed).select(
        "doc_id",
        F.col(size).alias("size"),
        F.col(crc).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
