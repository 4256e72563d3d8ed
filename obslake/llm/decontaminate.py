"""Benchmark decontamination: an FM-index per training shard, searched backwards for test phrases."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from obslake.functions.names import quoted
from obslake.llm.hashing import ALPHANUMERIC, words
from obslake.session import cut_lineage

WINDOW = 13
# A document is contaminated when a word in MIN_SHARE is hit.
MIN_SHARE = 20
SHARD_BYTES = 4 << 20
# Windows that tasks hold at once (about 13 words of 4 bytes each); more are searched in several passes.
MAX_WINDOWS = 400_000
SAMPLE_EVERY = 16

SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
FOUND = [
    StructField("n_words", LongType()),
    StructField("n_hit", LongType()),
    StructField("item_ids", ArrayType(LongType())),
    StructField("spans", ArrayType(SPAN)),
    StructField("contaminated", BooleanType()),
]


@dataclass
class Phrases:
    """Test phrases of one block: ``codes[w]`` are the words of window w by number in ``vocabulary``, from 1, padded with 0."""

    vocabulary: np.ndarray
    codes: np.ndarray
    lengths: np.ndarray
    # The items of window w are items[item_at[w]:item_at[w + 1]]; ids[i] is an item's id or None.
    items: np.ndarray
    item_at: np.ndarray
    ids: list


def phrases_of(items: list[tuple[int | None, str | None]], window: int = WINDOW) -> Phrases:
    """The distinct windows of ``window`` words, or whole shorter items, and the items each occurs in."""
    hashes, _, _, at = words([(t or "").encode() for _, t in items] or [b""], ALPHANUMERIC)
    vocabulary, codes = np.unique(hashes, return_inverse=True)
    seen: dict[bytes, set[int]] = {}
    for i in range(len(items)):
        own = (codes[at[i] : at[i + 1]] + 1).astype(np.int32)
        length = min(window, len(own))
        for k in range(len(own) - length + 1 if length else 0):
            seen.setdefault(own[k : k + length].tobytes(), set()).add(i)
    codes = np.zeros((len(seen), window), dtype=np.int32)
    lengths = np.array([len(w) // 4 for w in seen], dtype=np.int64)
    for row, w in enumerate(seen):
        codes[row, : lengths[row]] = np.frombuffer(w, dtype=np.int32)
    item_at = np.zeros(len(seen) + 1, dtype=np.int64)
    np.cumsum([len(s) for s in seen.values()], out=item_at[1:])
    flat = np.array([i for s in seen.values() for i in sorted(s)], dtype=np.int64)
    return Phrases(vocabulary, codes, lengths, flat, item_at, [i for i, _ in items])


class WaveletTree:
    """Rank of symbols in a sequence; the bits of a level are laid out by the bits above."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[int, int, np.ndarray]] = []
        for shift in range(bits - 1, -1, -1):
            ones = (symbols >> shift) & 1
            counts = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(ones, out=counts[1:])
            self.levels.append((shift, len(symbols) - int(counts[-1]), counts))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        low, high = np.zeros(len(places), dtype=np.int64), places.astype(np.int64)
        for shift, zeros, counts in self.levels:
            one = (symbols >> shift) & 1 == 1
            low = np.where(one, zeros + counts[low], low - counts[low])
            high = np.where(one, zeros + counts[high], high - counts[high])
        return high - low


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """Suffix order of a sequence in which 0 ends a run: each 0 differs from the others, in order of place."""
    n = len(sequence)
    ends = sequence == 0
    order = np.argsort(sequence, kind="stable")
    new = np.concatenate(([True], sequence[order][1:] != sequence[order][:-1]))
    ranks = np.empty(n, dtype=np.int64)
    ranks[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks[ends] = np.arange(np.count_nonzero(ends))
    step = 1
    # Places whose rank is not yet theirs alone are sorted by the rank of what follows.
    while True:
        counts = np.bincount(ranks, minlength=n)
        tied = np.flatnonzero(counts[ranks] > 1)
        if not len(tied):
            break
        # A tied place lies in a run that goes on for ``step`` symbols at least: a 0 within is alone.
        key = ranks[tied] * (2 * n + 2) + ranks[np.minimum(tied + step, n - 1)]
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        group = ranks[tied]
        start = np.concatenate(([True], group[1:] != group[:-1]))
        position = np.arange(len(tied))
        offset = np.maximum.accumulate(np.where(first, position, 0)) - np.maximum.accumulate(np.where(start, position, 0))
        ranks[tied] = group + offset
        step *= 2
    return np.argsort(ranks, kind="stable")


class FMIndex:
    """Backward search over runs of symbols from 1 to ``top``, each run ended by a 0."""

    def __init__(self, sequence: np.ndarray, top: int) -> None:
        order = suffix_array(sequence)
        self.size = len(sequence)
        self.before = sequence[order - 1]
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(sequence, minlength=top + 1))))
        self.tree = WaveletTree(self.before, max(1, int(top).bit_length()))
        # Every sixteenth place is sampled, and the first of each run: no walk passes the end of a run.
        sampled = (order % SAMPLE_EVERY == 0) | (self.before == 0)
        self.sampled_before = np.concatenate(([0], np.cumsum(sampled)))
        self.sampled, self.places = sampled, order[sampled]

    def _step(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.smaller[symbols] + self.tree.rank(symbols, rows)

    def search(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of the suffix order that begin with each phrase."""
        low, high = np.zeros(len(codes), dtype=np.int64), np.full(len(codes), self.size, dtype=np.int64)
        for back in range(codes.shape[1]):
            live = np.flatnonzero((back < lengths) & (low < high))
            if not len(live):
                break
            symbols = codes[live, lengths[live] - 1 - back]
            low[live], high[live] = self._step(symbols, low[live]), self._step(symbols, high[live])
        high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place of each row: steps back to a sampled row, and forward again by their number."""
        places, steps = np.full(len(rows), -1, dtype=np.int64), 0
        rows, left = rows.copy(), np.arange(len(rows))
        while len(left):
            here = self.sampled[rows]
            places[left[here]] = self.places[self.sampled_before[rows[here]]] + steps
            rows, left = rows[~here], left[~here]
            rows = self._step(self.before[rows], rows)
            steps += 1
        return places


def search_shard(texts: list[bytes], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Hit words of a shard, and pairs of text and item.

    Returns a flag per word, where each text's words begin, the distinct (text, item) pairs, and
    the words' byte starts and ends in the joined texts.  Words outside the phrases' vocabulary
    occur in no phrase: they end a run, and only runs as long as the shortest phrase are indexed.
    """
    hashes, starts, ends, at = words(texts, ALPHANUMERIC)
    hit = np.zeros(len(hashes) + 1, dtype=np.int64)
    pairs = np.zeros((0, 2), dtype=np.int64)
    if not len(hashes) or not len(phrases.lengths):
        return hit[:-1] > 0, at, pairs, (starts, ends)
    code = np.searchsorted(phrases.vocabulary, hashes)
    code[code == len(phrases.vocabulary)] = 0
    code = np.where(phrases.vocabulary[code] == hashes, code + 1, 0)
    # Runs of known words within one text.
    breaks = np.ones(len(code) + 1, dtype=bool)
    breaks[1:-1] = (code[1:] == 0) | (code[:-1] == 0)
    breaks[at] = True
    run = np.flatnonzero(breaks)
    lengths = np.diff(run)
    kept = (code[run[:-1]] > 0) & (lengths >= phrases.lengths.min())
    if not kept.any():
        return hit[:-1] > 0, at, pairs, (starts, ends)
    first, lengths = run[:-1][kept], lengths[kept]
    # The runs one after another, each with a 0 behind it; ``word`` leads back to the shard's words.
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    word = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first, lengths + 1)
    sequence = np.where(word == np.repeat(first + lengths, lengths + 1), 0, code[np.minimum(word, len(code) - 1)])

    index = FMIndex(sequence.astype(np.int64), len(phrases.vocabulary))
    low, high = index.search(phrases.codes, phrases.lengths)
    counts = high - low
    window = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts - low, counts)
    begin = word[index.locate(rows)]
    # Overlapping spans merge: words with more beginnings than ends before them are hit.
    np.add.at(hit, begin, 1)
    np.add.at(hit, begin + phrases.lengths[window], -1)
    text = np.searchsorted(at, begin, side="right") - 1
    met = np.unique(np.stack((text, window), axis=1), axis=0)
    n_items = np.diff(phrases.item_at)[met[:, 1]]
    item = phrases.items[np.arange(n_items.sum()) - np.repeat(np.cumsum(n_items) - n_items - phrases.item_at[met[:, 1]], n_items)]
    pairs = np.unique(np.stack((np.repeat(met[:, 0], n_items), item), axis=1), axis=0)
    return np.cumsum(hit[:-1]) > 0, at, pairs, (starts, ends)


def _spans(text: bytes, offset: int, edges: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Runs of hit words as code points of the text."""
    spans, characters, done = [], 0, 0
    for a, b in zip(starts[edges[0::2]] - offset, ends[edges[1::2] - 1] - offset):
        characters += len(text[done:a].decode())
        length = len(text[a:b].decode())
        spans.append({"start": characters, "end": characters + length})
        characters, done = characters + length, b
    return spans


def _shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in pieces of about SHARD_BYTES of text."""
    for frame in frames:
        sizes = np.cumsum([len(t or "") for t in frame["text"]])
        for _, piece in frame.groupby(sizes // SHARD_BYTES, sort=True):
            yield piece.reset_index(drop=True)


def _runs(hit: np.ndarray) -> np.ndarray:
    """Begin and end of each run of hit words."""
    return np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))


def _search(shared):
    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        phrases = shared.value
        for frame in _shards(frames):
            texts = [(t or "").encode() for t in frame["text"]]
            hit, at, pairs, (starts, ends) = search_shard(texts, phrases)
            offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
            rows, first = [], np.searchsorted(pairs[:, 0], np.arange(len(texts) + 1))
            before = frame.pop("_before") if "_before" in frame else [None] * len(texts)
            for i, (text, earlier) in enumerate(zip(texts, before)):
                own = slice(at[i], at[i + 1])
                ids = {phrases.ids[k] for k in pairs[first[i] : first[i + 1], 1]} - {None}
                if earlier is not None:
                    ids |= set(earlier["item_ids"])
                    for a, b in zip(earlier["hit_words"][0::2], earlier["hit_words"][1::2]):
                        hit[own][a:b] = True
                runs = _runs(hit[own])
                spans = _spans(text, offsets[i], runs, starts[own], ends[own]) if len(runs) else []
                rows.append((at[i + 1] - at[i], int(hit[own].sum()), sorted(ids), spans, runs.tolist()))
            names = ("n_words", "n_hit", "item_ids", "spans", "hit_words")
            yield frame.assign(**dict(zip(names, map(list, zip(*rows)))))

    return search


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str] | None = None,
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """The columns ``keep`` of every row and what of its text occurs in the benchmark.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``item_ids`` (sorted),
    ``spans`` (merged runs of hit words, in code points, to be removed) and ``contaminated``
    (``n_hit`` > 0 and 20 * ``n_hit`` >= ``n_words``); columns of those names are replaced.

    A pass over the documents makes shards of about 4 MB of text, each with an FM-index of its
    own; nothing is shuffled and no shard depends on another.  The windows are searched in
    blocks of items of at most about ``max_windows`` windows, a pass for each block.

    Null or empty texts have no words; an item without words has no window.  An item without id
    hits words but is not listed.  Repeated rows and items are handled one by one.  An empty
    benchmark hits nothing; empty documents give no rows.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c.lower() not in {f.name.lower() for f in FOUND}]
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    letters = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-letters // (2 * max_windows)))  # a word and what parts it are two bytes at least
    types = {f.name: f for f in docs.schema.fields}
    # Columns to keep go under names of their own meanwhile, whatever they are called.
    carried = {c: f"_kept_{k}" for k, c in enumerate(keep) if c != "text"}
    own = [StructField("text", StringType()), *(StructField(a, types[c].dataType) for c, a in carried.items())]
    added = [*FOUND[:4], StructField("hit_words", ArrayType(LongType()))]
    found = docs.select("text", *[F.col(quoted(c)).alias(a) for c, a in carried.items()])
    for k in range(blocks):
        # At most about 2 * max_windows bytes of text.
        block = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()
        shared = spark.sparkContext.broadcast(phrases_of([tuple(r) for r in block], window))
        if k:
            before = F.struct("item_ids", "hit_words").alias("_before")
            found = cut_lineage(found).select("text", *carried.values(), before)
        found = found.mapInPandas(_search(shared), StructType([*own, *added]))
    result = (F.col("n_hit") > 0) & (F.col("n_hit") * MIN_SHARE >= F.col("n_words"))
    kept = [F.col(carried.get(c, "text")).alias(c) for c in keep]
    return found.select(*kept, *[f.name for f in FOUND[:4]], result.alias("contaminated"))


def contamination_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` (ids sorted as strings, comma-joined), ``contaminated``."""
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return contamination(docs, benchmark, ["doc_id"]).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with their own columns."""
    names = [f"_own_{k}" if c != "text" else c for k, c in enumerate(docs.columns)]
    clean = contamination(docs.toDF(*names), benchmark).where(~F.col("contaminated"))
    return clean.select(*names).toDF(*docs.columns)
