"""Connected components of a large graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from obslake.session import cut_lineage


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to the least node it sees."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node, with its smaller neighbours, goes to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a")
    return (
        moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .union(least.select("a", F.col("least").alias("b")))
        .where("a != b")
        .distinct()
    )


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component``, its least reachable node, for every node of an edge (columns ``a`` and ``b``).

    Each round is a shuffle of the edges left; their number never grows, and the rounds needed
    follow the logarithm of the number of nodes.  Nothing but counts reaches the driver.  Loops,
    repeated edges and either direction are fine; edges with a null end are not used.
    """
    edges = cut_lineage(edges.select("a", "b").dropna().where("a != b").distinct())
    before = None
    for _ in range(most_rounds):
        now = _signature(edges)
        if now == before or now[0] == 0:
            break
        before = now
        edges = cut_lineage(_small_star(_large_star(edges)))
    else:
        raise RuntimeError("components did not settle")
    least = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return least.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
