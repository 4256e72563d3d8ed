"""Mixing sources to target weights: cube-method balanced sampling."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from obslake.llm.columns import group_key
from obslake.session import cut_lineage

# The weights are given to the sources in order, again and again.
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST = 2.0
SEED = 77
BLOCK_ROWS = 4096
ALMOST = 1e-9


@F.pandas_udf(LongType())
def word_count(texts: pd.Series) -> pd.Series:
    """Words of a text, split by the white space 20 and 09-0D (null: none)."""
    return pd.Series([0 if t is None else len(t.encode().split()) for t in texts], dtype="int64")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL_SHARE, most: float = MOST
) -> DataFrame:
    """A row per source: ``stratum`` (its key), ``source_size``, ``target``, ``chance`` (copies expected of each row).

    ``sizes`` has a row per document with ``stratum``, ``source`` and ``size``.  Sources are
    ordered by code point, null last, and weigh ``weights`` in turn.  They share ``total`` times
    all sizes by weight.  A target stops at ``most`` times its source's size, and what it leaves
    is shared by the others.  That is min(most * size, level * weight) for the one level that
    uses up the total: with the sources sorted by size over weight, the first of them are full.
    One row per source takes part, whatever the number of documents.
    """
    by_source = sizes.groupBy("stratum").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("n_rows")
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    full_first = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    upwards = full_first.rowsBetween(Window.unboundedPreceding, -1)
    onwards = full_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    taken = F.coalesce(F.sum("source_size").over(upwards), F.lit(0)) * most
    level = (F.sum("source_size").over(everything) * total - taken) / F.sum("weight").over(onwards)
    return (
        by_source.withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("level", level)
        # The level rises with every full source and then falls: it is right at the first source it does not fill.
        .withColumn(
            "level",
            F.max(F.when(F.col("level") * F.col("weight") <= most * F.col("source_size"), F.col("level"))).over(
                everything
            ),
        )
        .select(
            "stratum",
            "source_size",
            "n_rows",
            F.least(
                most * F.col("source_size"),
                F.coalesce(F.col("level") * F.col("weight"), most * F.col("source_size")),
            ).alias("target"),
        )
        .withColumn(
            "chance",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0)),
        )
    )


def flight(chances: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Move chances to 0 or 1 without changing their sum and the expected total of ``sizes``.

    Three undecided rows have a direction in which both totals stay (the null space of two
    constraints).  A step goes as far that way, or the other, as a chance leaves [0, 1]; which
    one is drawn so that each chance keeps its mean.  That decides a row, and the next takes its
    place.  At most two rows stay between 0 and 1.
    """
    chances = chances.copy()
    open_rows: list[int] = []
    for row in range(len(chances)):
        if not ALMOST < chances[row] < 1 - ALMOST:
            continue
        open_rows.append(row)
        if len(open_rows) < 3:
            continue
        a, b, c = open_rows
        direction = [sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a]]
        if not any(direction):
            direction = [1.0, -1.0, 0.0]
        now = [chances[i] for i in open_rows]
        up = min(((1 - p) if d > 0 else p) / abs(d) for p, d in zip(now, direction) if d)
        down = min((p if d > 0 else (1 - p)) / abs(d) for p, d in zip(now, direction) if d)
        step = up if draws[row] * (up + down) < down else -down
        for i, p, d in zip(open_rows, now, direction):
            p += step * d
            chances[i] = 0.0 if p < ALMOST else 1.0 if p > 1 - ALMOST else p
        open_rows = [i for i in open_rows if 0 < chances[i] < 1]
    return chances


def landing(chances: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Decide the few rows that a flight has left: the choice nearest to both expected totals."""
    rows = np.flatnonzero((chances > 0) & (chances < 1))
    if not len(rows):
        return chances
    choices = np.array(np.meshgrid(*[[0.0, 1.0]] * len(rows), indexing="ij")).reshape(len(rows), -1).T
    expected, x = chances[rows], sizes[rows].astype(float)
    misses = np.abs((choices - expected) @ x) / max(1.0, x.max()) + 1e-3 * np.abs((choices - expected).sum(axis=1))
    chances = chances.copy()
    chances[rows] = choices[np.argmin(misses)]
    return chances


def _draws(orders: np.ndarray, level: int) -> np.ndarray:
    """A number in [0, 1) for each row, the same in every run."""
    return np.array(
        [int.from_bytes(hashlib.blake2b(b"%d:%d" % (level, o), digest_size=6).digest()) / 2**48 for o in orders.tolist()]
    )


def _decide(level: int, last: bool):
    def decide(block: pd.DataFrame) -> pd.DataFrame:
        # Long rows first: the rows left undecided are the short ones.
        block = block.sort_values(["size", "order", "chance"], ascending=[False, True, True], ignore_index=True)
        sizes = block["size"].to_numpy(dtype=float)
        chances = flight(block["chance"].to_numpy(), sizes, _draws(block["order"].to_numpy(), level))
        return block.assign(chance=landing(chances, sizes) if last else chances)

    return decide


def copies_taken(docs: DataFrame, keep: list[str], **targets) -> DataFrame:
    """Every row: ``row`` (a struct of the columns ``keep``), ``size``, ``source_size``, ``target``, ``copies`` (int).

    A source is taken ``chance`` = target over size times.  Every row gets the whole part of
    that in copies; the fraction left is the chance of one more, decided by the cube method so
    that the numbers of words and of rows that are taken stay at their expected totals.

    The flight runs over blocks of about 4096 rows of one source, all at once.  A block leaves
    two rows undecided; those are gathered by source into new blocks, until a source fits into
    one block, whose last two rows are landed.  Blocks and draws follow from hashes of id and
    text, so a repeated run agrees.

    Null sources are one source.  A null or empty text has size 0 and changes no total of words;
    a source of such texts only is taken once.  Repeated rows are rows.  An empty table gives no
    rows.  Names of other columns do not matter.
    """
    rows = docs.select(
        F.struct(*keep).alias("row"),
        "source",
        word_count("text").alias("size"),
        group_key(F.col("source")).alias("stratum"),
        F.xxhash64(F.lit(SEED), "doc_id", "text").alias("order"),
    )
    rows = cut_lineage(rows)
    sources = cut_lineage(source_targets(rows.select("stratum", "source", "size"), **targets))
    rows = rows.join(sources, "stratum")

    undecided = rows.select(
        "stratum", "order", "size", "n_rows", (F.col("chance") - F.floor("chance")).alias("chance")
    ).where(F.col("chance").between(ALMOST, 1 - ALMOST))
    decided = None
    level, largest = 0, sources.agg(F.max("n_rows")).first()[0] or 0
    while True:
        last = largest <= BLOCK_ROWS
        block = F.pmod(F.xxhash64(F.lit(level), "order"), F.ceil(F.col("n_rows") / BLOCK_ROWS))
        found = cut_lineage(
            undecided.groupBy("stratum", block.alias("block")).applyInPandas(
                _decide(level, last), undecided.schema
            )
        )
        done = found.where((F.col("chance") <= 0) | (F.col("chance") >= 1))
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        undecided = found.where((F.col("chance") > 0) & (F.col("chance") < 1))
        counts = undecided.groupBy("stratum").agg(F.count("*").alias("n_rows"))
        undecided = undecided.drop("n_rows").join(counts, "stratum").select(*found.columns)
        level, largest = level + 1, counts.agg(F.max("n_rows")).first()[0] or 0

    # Rows with the same id and text are alike: how many of them get one more copy is all that counts.
    extra = (
        decided.where(F.col("chance") >= 1).groupBy("stratum", "order", "size").agg(F.count("*").alias("extra"))
    )
    alike = Window.partitionBy("stratum", "order", "size").orderBy(F.lit(0))
    return (
        rows.join(extra, ["stratum", "order", "size"], "left")
        .withColumn("nth", F.row_number().over(alike))
        .select(
            "row",
            "size",
            "source_size",
            "target",
            (
                F.floor(F.col("chance") + ALMOST) + F.when(F.col("nth") <= F.col("extra"), 1).otherwise(0)
            ).cast("int").alias("copies"),
        )
    )


def mix_table(docs: DataFrame, **targets) -> DataFrame:
    """What the mix takes of each row: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` (words, repeats counted)."""
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return copies_taken(docs, ["doc_id"], **targets).select("row.doc_id", "size", "source_size", "target", taken)


def mix_documents(docs: DataFrame, **targets) -> DataFrame:
    """The mix: every row with all its columns, as often as it is taken."""
    taken = copies_taken(docs, docs.columns, **targets)
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
