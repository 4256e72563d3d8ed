"""Interaction of text filters: what each removes in every order, with duplicates found in radix tries."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from obslake.session import cut_lineage

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"
_CAPITALS = bytes(range(0x41, 0x5B))
_DUPLICATE = 1 << FILTERS.index("E")

# Texts that one local trie takes before it is emptied, and those of one range.
LOCAL_BYTES = 64 << 20
RANGE_BYTES = 32 << 20
# A prefix with more text than this share of a range is made longer, unless it has less than this many bytes.
SHARES = 4
LIGHT_BYTES = 1 << 20
FIRST_PREFIX = 8

LOCAL = "doc_id long, part string, mask int, n long, text binary"
MASKS = "doc_id long, part string, mask int, n long"


class TextTrie:
    """Compressed trie of whole texts; every terminal has a number, in the order of insertion."""

    def __init__(self) -> None:
        # A node is [label of the edge to it, its children by first byte, number of its text or -1].
        self._root: list = [b"", {}, -1]
        self.size = 0

    def _number(self, node: list) -> int:
        if node[2] < 0:
            node[2] = self.size
            self.size += 1
        return node[2]

    def add(self, text: bytes) -> int:
        """The number of ``text``, a new one if the trie did not hold it."""
        node, at = self._root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = node[1][text[at]] = [text[at:], {}, -1]
                return self._number(child)
            label = child[0]
            if not text.startswith(label, at):
                shared = _shared(label, text, at)
                fork = [label[:shared], {label[shared]: child}, -1]
                child[0] = label[shared:]
                node[1][text[at]] = fork
                child = fork
            node, at = child, at + len(child[0])
        return self._number(node)

    def terminals(self) -> Iterator[int]:
        """Numbers of all texts in the order of their bytes."""
        waiting = [self._root]
        while waiting:
            node = waiting.pop()
            if node[2] >= 0:
                yield node[2]
            waiting.extend(node[1][k] for k in sorted(node[1], reverse=True))


def _shared(label: bytes, text: bytes, at: int) -> int:
    """How many bytes ``label`` and ``text`` from ``at`` on have in common."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text[at + low : at + middle] == label[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that the text fails; E needs the other texts."""
    words = text.split()
    points = len(text) if text.isascii() else len(text.decode())
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > CAPITAL_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def _beaten(ids: pd.Series, numbers: np.ndarray, size: int) -> np.ndarray:
    """Which rows have an id above the least one of their text; a null id is above all others."""
    known = ids.notna().to_numpy()
    values = ids.fillna(0).to_numpy(dtype=np.int64)
    least = np.full(size, np.iinfo(np.int64).max, dtype=np.int64)
    np.minimum.at(least, numbers[known], values[known])
    named = np.zeros(size, dtype=bool)
    named[numbers[known]] = True
    return np.where(known, values > least[numbers], named[numbers])


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of all rows; those beaten by a smaller id beside them are settled, the others keep their text."""
    held: list[tuple] = []
    trie, texts, size = TextTrie(), [], 0

    def settle() -> Iterator[pa.RecordBatch]:
        rows = pd.DataFrame(held, columns=["doc_id", "part", "mask", "number"]).astype({"doc_id": "Int64"})
        later = _beaten(rows["doc_id"], rows["number"].to_numpy(), trie.size)
        rows["mask"] |= np.where(later, _DUPLICATE, 0)
        rows["number"] = np.where(later, -1, rows["number"])
        # Rows that repeat id and text go on as one with a count.
        same = rows.groupby(list(rows.columns), dropna=False, sort=False).size().reset_index(name="n")
        for first in range(0, len(same), 2048):
            piece = same.iloc[first : first + 2048]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(piece["doc_id"], pa.int64()),
                    "part": pa.array(piece["part"], pa.string()),
                    "mask": pa.array(piece["mask"], pa.int32()),
                    "n": pa.array(piece["n"], pa.int64()),
                    "text": pa.array([texts[k] if k >= 0 else None for k in piece["number"]], pa.binary()),
                }
            )

    for batch in batches:
        for doc_id, part, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "part", "text")]):
            number = trie.add(text)
            if number == len(texts):
                texts.append(text)
                size += len(text)
            held.append((doc_id, part, text_mask(text), number))
            if size > LOCAL_BYTES or len(held) > LOCAL_BYTES >> 8:
                yield from settle()
                held, trie, texts, size = [], TextTrie(), [], 0
    if held:
        yield from settle()


def _ranged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a range of texts: one trie of them all, and the bit of E for whoever is not the least."""
    trie, rows = TextTrie(), []
    for frame in frames:
        frame = frame.astype({"doc_id": "Int64"})
        frame["number"] = [trie.add(t) for t in frame.pop("text")]
        rows.append(frame)
    if rows:
        found = pd.concat(rows, ignore_index=True)
        later = _beaten(found["doc_id"], found.pop("number").to_numpy(), trie.size)
        found["mask"] |= np.where(later, _DUPLICATE, 0).astype(np.int32)
        for first in range(0, len(found), 8192):
            yield found.iloc[first : first + 8192]


def range_key(texts: DataFrame, range_bytes: int = RANGE_BYTES, light_bytes: int = LIGHT_BYTES) -> tuple[Column, int]:
    """A prefix of the column ``text`` (bytes) to range-partition by, and the number of ranges.

    The prefix is short where few texts share it.  One that holds more than a fraction of a
    range's text is made four times as long, again and again, so that only copies of one text
    stay together whatever their number.  Every row counts; the driver gets one number for each
    heavy prefix, of which there are a few for each range at most.
    """
    spark = texts.sparkSession
    length = F.octet_length("text").cast("long") + 1
    whole = texts.agg(F.coalesce(F.sum(length), F.lit(0)).alias("n"), F.coalesce(F.max(length), F.lit(0)).alias("longest")).first()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-whole["n"] // range_bytes))
    limit = max(light_bytes, whole["n"] // (SHARES * ranges))
    key, left, size = F.substring("text", 1, FIRST_PREFIX), texts, FIRST_PREFIX
    cases: list[tuple[Column, Column]] = []
    while size < whole["longest"]:
        prefix = F.substring("text", 1, size)
        heavy = [
            r["h"]
            for r in left.groupBy(F.xxhash64(prefix).alias("h")).agg(F.sum(length).alias("n")).where(F.col("n") > limit).collect()
        ]
        if not heavy:
            break
        longer = F.xxhash64(prefix).isin(heavy)
        cases.append((~longer, prefix))
        left, size = left.where(longer), size * 4
        key = F.substring("text", 1, size)
    for light, prefix in reversed(cases):
        key = F.when(light, prefix).otherwise(key)
    return key, ranges


def filter_masks(docs: DataFrame, range_bytes: int = RANGE_BYTES, light_bytes: int = LIGHT_BYTES) -> DataFrame:
    """``doc_id``, ``part`` (its language), ``mask`` and ``n`` for all rows of ``docs``.

    Bit i of ``mask`` says that the text fails filter i of A to E; ``n`` is the number of rows
    that a row stands for, since rows that repeat id and text may be counted together.

    Duplicates are found in compressed tries of whole texts.  A task first puts the rows it reads
    into tries of bounded size and settles the copies among them, so a text that a third of all
    rows hold leaves each task once.  The others are range-partitioned by prefixes of their text,
    which are longer where many texts begin alike; each range has one trie, whose terminals hold
    the least id of their text.  Rows above it are duplicates.

    A null text counts as empty.  A row with a null id is a duplicate of any row that has an id
    and the same text; rows with one id and one text are not duplicates of each other.  A null
    language is the part with the empty name.  Very long texts are read whole.  Further columns
    are ignored, whatever their names; an empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    local = cut_lineage(rows.mapInArrow(_local, LOCAL))
    open_rows = local.where("text is not null")
    key, ranges = range_key(open_rows, range_bytes, light_bytes)
    dealt = open_rows.repartitionByRange(ranges, key)
    return local.where("text is null").select("doc_id", "part", "mask", "n").union(dealt.mapInPandas(_ranged, MASKS))


def _counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows, good rows and toxic rows per part and mask."""
    rows = masks.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    return (
        rows.join(marks, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.col("n") * F.col("good")), F.lit(0)).alias("good"),
            F.coalesce(F.sum(F.col("n") * F.col("toxic")), F.lit(0)).alias("toxic"),
        )
    )


def audit(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """What every filter removes at every step of every order, per part: one row each, zeros included.

    ``masks`` comes from ``filter_masks``; ``labels`` has ``doc_id``, ``quality`` and ``toxic``.
    A document is good (toxic) if any label row of its id says 1.  The rows are reduced to counts
    per part and mask first; orders are applied to those.
    """
    orders = ["".join(o) for o in permutations(FILTERS)]

    def bit_at(place: str | int) -> Column:
        return F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, {place}, 1)) - 1)")

    earlier = sum((F.when(F.col("step") > j, bit_at(j)).otherwise(0) for j in range(1, len(FILTERS))), F.lit(0))
    rows = (
        _counts(masks, labels)
        .select("*", F.explode(F.split(F.lit(",".join(orders)), ",")).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
        .select("*", bit_at("step").alias("bit"), earlier.alias("prior"))
    )
    mask, bit, prior = F.col("mask"), F.col("bit"), F.col("prior")
    fails = mask.bitwiseAND(bit) != 0
    before = mask.bitwiseAND(prior) != 0
    removed = fails & ~before

    def total(chosen: Column, what: Column, name: str) -> Column:
        return F.sum(F.when(chosen, what).otherwise(F.lit(0))).cast("long").alias(name)

    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~before, F.col("n"), "kept"),
        total(removed, F.col("n"), "removed"),
        total(fails & before, F.col("n"), "redundant"),
        total(mask == bit, F.col("n"), "unique_fails"),
        total(removed, F.col("good"), "good_lost"),
        total(removed, F.col("toxic"), "toxic_lost"),
        # Of the filters that a row fails, each comes first in the same number of orders.
        total(fails, F.col("n") * F.expr(f"{len(orders)} div greatest(bit_count(mask), 1)"), "shapley"),
    )


def audit_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs``."""
    return audit(filter_masks(docs), labels)
