"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash cuts texts into phrases, the dictionary holds each phrase once, and only phrases
that another one resembles are opened.  No suffix array of dictionary or parse is built: strings
have one fixed length, so hashes of 64 bits tell which are equal, and their order is not needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from obslake.llm.columns import spread
from obslake.llm.hashing import U64, Rolling, joined, mix, packs
from obslake.session import cut_lineage

LENGTH = 100
TRIGGER = 24
# Filters have so many bits whatever the corpus: more keys let more through, and never drop one.
FILTER_BITS, SLICES = 1 << 27, 64
COMPARE_BYTES, SPLIT_BYTES = 2 << 20, 512 << 10
# Strings of one trigger that a task may compare; those of triggers with more are dealt by their hash.
TOGETHER = 1 << 18

_LAST = (1 << 63) - 1


def identity(docs: DataFrame) -> list[Column]:
    """What tells rows apart: the id (null last) and a hash of the text."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"),
        F.coalesce("text", F.lit("")).alias("text"),
    ]


def parse(texts: list[bytes], length: int = LENGTH, trigger: int = TRIGGER) -> tuple[np.ndarray, ...]:
    """The phrases of each text: text index, first start, distance to the trigger, starts, trigger hash, phrase hash.

    A string of ``length`` bytes contains one trigger: of its windows of ``trigger`` bytes, the
    first with the least hash.  Equal strings have their trigger at the same distance.  Starts in
    a row whose strings have the same trigger make a phrase: the bytes of all those strings.  So
    each string lies in one phrase, and phrases overlap by ``length`` - 1 bytes, which keeps the
    set of them prefix-free.
    """
    data, offsets = joined(texts)
    none = np.zeros(0, dtype=np.int64)
    n = len(data) - length + 1
    # A start is valid if its string ends before the line feed that ends the text.
    valid = np.zeros(max(n, 0), dtype=bool)
    for a, b in zip(offsets[:-1], offsets[1:] - length):
        valid[a : max(a, b)] = True
    if not valid.any():
        return none, none, none, none, none.astype(U64), none.astype(U64)
    rolling = Rolling(data)
    at = np.arange(len(data) - trigger + 1)
    hashes = rolling.of(at, at + trigger)
    # The upper half of the hash, and the place to prefer the first among equals.
    least = (hashes >> U64(32) << U64(32)) | at.astype(U64)
    windows, size = length - trigger + 1, 1
    while 2 * size <= windows:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = windows - size
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    place = (least[:n] & U64(0xFFFFFFFF)).astype(np.int64)
    change = np.ones(n, dtype=bool)
    change[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
    # A valid start that follows another text's is set apart by the invalid ones between.
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, n))
    keep = valid[first]
    first, count = first[keep], count[keep]
    text = np.searchsorted(offsets, first, side="right") - 1
    distance = place[first] - first
    phrase = mix(rolling.of(first, first + count + length - 1) ^ mix(distance.astype(U64)))
    return text, first - offsets[text], distance, count, hashes[place[first]], phrase


def _intervals(doc: np.ndarray, digest: np.ndarray, low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
    """Intervals of starts of the same text that touch become one; rows come sorted by text and ``low``."""
    if not len(doc):
        return pd.DataFrame({"doc": doc, "digest": digest, "low": low, "high": high})
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1]) | (low[1:] > high[:-1] + 1)
    first = np.flatnonzero(new)
    return pd.DataFrame({"doc": doc[first], "digest": digest[first], "low": low[first], "high": np.maximum.reduceat(high, first)})


def _phrases(frame: pd.DataFrame, length: int, wanted=None) -> tuple[np.ndarray, ...]:
    """Phrases of a batch as (row of the frame, low, distance, count, trigger, phrase, 1 if the phrase came before).

    They come sorted by phrase and, within one, by id, text and place.
    """
    parts = []
    for first, texts in packs(t.encode() for t in frame["text"]):
        text, *rest = parse(texts, length)
        if wanted is not None:
            keep = wanted(rest[3])
            text, rest = text[keep], [r[keep] for r in rest]
        parts.append((text + first, *rest))
    if not parts:
        return (np.zeros(0, dtype=np.int64),) * 7
    row, low, distance, count, trigger, phrase = (np.concatenate(c) for c in zip(*parts))
    rank = np.empty(len(frame), dtype=np.int64)
    rank[np.lexsort((frame["digest"].to_numpy(), frame["doc"].to_numpy()))] = np.arange(len(frame))
    order = np.lexsort((low, rank[row], phrase))
    row, low, distance, count, trigger, phrase = (c[order] for c in (row, low, distance, count, trigger, phrase))
    again = np.zeros(len(row), dtype=np.int8)
    again[1:] = phrase[1:] == phrase[:-1]
    return row, low, distance, count, trigger, phrase, again


def _distinct_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """A row that repeats id and text is the same document."""
    return frame.drop_duplicates(["doc", "digest"], ignore_index=True)


def _parse_rows(length: int):
    """Kind 0: a phrase where a batch has it first.  Kind 1: starts whose phrase came before in the batch."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in map(_distinct_rows, frames):
            doc, digest = frame["doc"].to_numpy(), frame["digest"].to_numpy()
            row, low, distance, count, trigger, phrase, again = _phrases(frame, length)
            new = again == 0
            yield pd.DataFrame(
                {
                    "trigger": trigger[new].astype(np.int64),
                    "phrase": phrase[new].astype(np.int64),
                    "doc": doc[row[new]],
                    "digest": digest[row[new]],
                    "low": low[new],
                    "high": low[new] + count[new] - 1,
                    "kind": np.zeros(int(new.sum()), dtype=np.int8),
                }
            )
            old = np.flatnonzero(~new)
            old = old[np.lexsort((low[old], row[old]))]
            found = _intervals(doc[row[old]], digest[row[old]], low[old], low[old] + count[old] - 1)
            yield found.assign(trigger=found["digest"], phrase=0, kind=np.int8(1))

    return rows


def _origins(same: np.ndarray, columns: tuple[np.ndarray, ...], first: tuple[int, ...] | None) -> list[np.ndarray]:
    """For each row the values of the first row of its run; a run that began in an earlier batch has ``first``."""
    start = np.maximum.accumulate(np.where(same, -1, np.arange(len(same))))
    return [np.where(start < 0, f, c[np.maximum(start, 0)]) for f, c in zip(first or (0,) * len(columns), columns)]


def _dictionary(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For rows sorted by trigger, phrase and place.

    Kind 1: starts whose phrase came before.  Kind 2: triggers with several phrases (``doc``) and
    how many strings their rows have (``low``).
    """
    last = first = None
    strings = further = 0

    def several(triggers, numbers) -> pd.DataFrame:
        return pd.DataFrame({"doc": triggers, "digest": 0, "low": numbers, "high": 0, "kind": np.int8(2)})

    for frame in frames:
        passed = frame["kind"].to_numpy() == 1
        yield frame.loc[passed, ["doc", "digest", "low", "high"]].assign(kind=np.int8(1))
        frame = frame[~passed]
        if not len(frame):
            continue
        trigger, phrase, doc, digest, low = (frame[c].to_numpy() for c in ("trigger", "phrase", "doc", "digest", "low"))
        same_trigger, same_phrase = np.zeros(len(frame), dtype=bool), np.zeros(len(frame), dtype=bool)
        same_trigger[1:] = trigger[1:] == trigger[:-1]
        same_phrase[1:] = same_trigger[1:] & (phrase[1:] == phrase[:-1])
        if last is not None:
            same_trigger[0] = trigger[0] == last[0]
            same_phrase[0] = same_trigger[0] and phrase[0] == last[1]
        origin = _origins(same_phrase, (doc, digest, low), first)
        itself = (doc == origin[0]) & (digest == origin[1]) & (low == origin[2])
        again = np.flatnonzero(same_phrase & ~itself)
        again = again[np.lexsort((low[again], digest[again], doc[again]))]
        high = frame["high"].to_numpy()
        yield _intervals(doc[again], digest[again], low[again], high[again]).assign(kind=np.int8(1))
        runs = np.union1d(0, np.flatnonzero(~same_trigger))
        own = np.add.reduceat(high - low + 1, runs)
        others = np.add.reduceat((same_trigger & ~same_phrase).astype(np.int64), runs)
        if same_trigger[0]:
            own[0] += strings
            others[0] += further
        elif further:
            yield several([last[0]], [strings])
        closed = np.flatnonzero(others[:-1])
        yield several(trigger[runs[closed]], own[closed])
        strings, further = int(own[-1]), int(others[-1])
        last, first = (trigger[-1], phrase[-1]), tuple(int(o[-1]) for o in origin)
    if further:
        yield several([last[0]], [strings])


def _bits(keys: np.ndarray) -> np.ndarray:
    keys = keys.astype(U64)
    return np.concatenate([(mix(keys ^ U64(s)) & U64(FILTER_BITS - 1)).astype(np.int64) for s in (1, 2)])


def _filter_bytes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for frame in frames:
        bits = _bits(frame["key"].to_numpy())
        np.bitwise_or.at(held, bits >> 3, np.left_shift(1, bits & 7).astype(np.uint8))
    for k, own in enumerate(held.reshape(SLICES, -1)):
        place = np.flatnonzero(own)
        if len(place):
            yield pd.DataFrame({"slice": [k], "places": [place.astype("<i4").tobytes()], "bits": [own[place].tobytes()]})


def _join_filters(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[int, np.ndarray] = {}
    for frame in frames:
        for row in frame.itertuples(index=False):
            own = held.setdefault(row.slice, np.zeros(FILTER_BITS // 8 // SLICES, dtype=np.uint8))
            own[np.frombuffer(row.places, dtype="<i4")] |= np.frombuffer(row.bits, dtype=np.uint8)
    for k, own in held.items():
        yield pd.DataFrame({"slice": [k], "bits": [own.tobytes()]})


def _filter(keys: DataFrame):
    """A Bloom filter of a column ``key``, built in tasks and joined by slices; of one size for any number of keys."""
    parts = keys.mapInPandas(_filter_bytes, "slice int, places binary, bits binary")
    found = spread(parts, "slice").mapInPandas(_join_filters, "slice int, bits binary")
    held = np.zeros((SLICES, FILTER_BITS // 8 // SLICES), dtype=np.uint8)
    for row in found.collect():
        held[row.slice] |= np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(held.reshape(-1))


def _passes(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = _bits(keys)
    return ((held[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1).reshape(2, -1).all(axis=0)


def _strings(frame: pd.DataFrame, length: int) -> tuple[np.ndarray, ...]:
    """Each string of phrases sorted by trigger and place, as (row, start in the phrase, hash, if it came before)."""
    parts = frame["bytes"].tolist()
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    counts = sizes - length + 1
    row = np.repeat(np.arange(len(frame)), counts)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(np.cumsum(sizes) - sizes, counts) + inside
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    hashes = Rolling(data).of(start, start + length) if len(start) else np.zeros(0, dtype=U64)
    again = np.ones(len(hashes), dtype=bool)
    again[np.unique(hashes, return_index=True)[1]] = False
    return row, inside, hashes, again


def _split(frame: pd.DataFrame, length: int) -> Iterator[pd.DataFrame]:
    """Kind 1: a string where a block of phrases has it first, keyed by its hash.  Kind 2: starts whose string came before in it."""
    frame = frame.sort_values(["key", "doc", "digest", "low"], ignore_index=True)
    blocks = np.cumsum([len(b) for b in frame["bytes"]]) // SPLIT_BYTES
    for _, part in frame.groupby(blocks, sort=True):
        row, inside, hashes, again = _strings(part, length)
        doc, digest, low = (part[c].to_numpy()[row] for c in ("doc", "digest", "low"))
        low = low + inside
        new = np.flatnonzero(~again)
        found = pd.DataFrame({"key": hashes[new].astype(np.int64), "doc": doc[new], "digest": digest[new], "low": low[new], "high": low[new]})
        yield found.assign(kind=np.int8(1), bytes=None)
        old = np.flatnonzero(again)
        old = old[np.lexsort((low[old], digest[old], doc[old]))]
        found = _intervals(doc[old], digest[old], low[old], low[old])
        yield found.assign(key=found["digest"], kind=np.int8(2), bytes=None)


def _open_rows(length: int, shared, crowded):
    """Phrases whose trigger has other phrases as well, with their bytes (kind 0); single strings of crowded triggers."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, many = shared.value, crowded.value
        for frame in map(_distinct_rows, frames):
            doc, digest = frame["doc"].to_numpy(), frame["digest"].to_numpy()
            row, low, _, count, trigger, _, again = _phrases(frame, length, lambda keys: _passes(held, keys))
            new = again == 0
            row, low, count, trigger = row[new], low[new], count[new], trigger[new]
            order = np.lexsort((low, row))
            row, low, count, trigger = row[order], low[order], count[order], trigger[order]
            cut, text, of = [], b"", -1
            for r, a, k in zip(row.tolist(), low.tolist(), count.tolist()):
                if r != of:
                    text, of = frame["text"].iat[r].encode(), r
                cut.append(text[a : a + k + length - 1])
            opened = pd.DataFrame({"key": trigger.astype(np.int64), "doc": doc[row], "digest": digest[row], "low": low, "bytes": cut})
            split = _passes(many, trigger)
            yield opened[~split].assign(high=low[~split], kind=np.int8(0))
            if split.any():
                yield from _split(opened[split], length)

    return rows


def _same_strings(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Starts whose string came before, among all phrases of some triggers, sorted by trigger and place.

    Every string of every phrase is put into the order of its hash, in which equal strings stand
    together and the earliest is first.
    """
    frame = frame.drop_duplicates(["key", "doc", "digest", "low"], ignore_index=True)
    trigger = frame["key"].to_numpy()
    alone = np.ones(len(frame), dtype=bool)
    alone[1:] &= trigger[1:] != trigger[:-1]
    alone[:-1] &= trigger[1:] != trigger[:-1]
    frame = frame[~alone]
    row, inside, _, again = _strings(frame, length)
    row, low = row[again], frame["low"].to_numpy()[row[again]] + inside[again]
    doc, digest = frame["doc"].to_numpy()[row], frame["digest"].to_numpy()[row]
    order = np.lexsort((low, digest, doc))
    return _intervals(doc[order], digest[order], low[order], low[order])


def _compare(length: int):
    """For rows sorted by kind, key and place: starts whose string came before."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last_string = first = None

        def settle(complete: pd.DataFrame) -> Iterator[pd.DataFrame]:
            # As many whole triggers at once as fill a few megabytes.
            ends = np.cumsum([len(b) for b in complete["bytes"]]) // COMPARE_BYTES
            block = pd.Series(ends).groupby(complete["key"].to_numpy()).transform("min").to_numpy()
            for _, part in complete.groupby(block, sort=True):
                yield _same_strings(part, length)

        for frame in frames:
            kind = frame["kind"].to_numpy()
            yield frame.loc[kind == 2, ["doc", "digest", "low", "high"]]
            strings = frame[kind == 1]
            if len(strings):
                key, doc, digest, low = (strings[c].to_numpy() for c in ("key", "doc", "digest", "low"))
                same = np.append(key[0] == last_string if first else False, key[1:] == key[:-1])
                origin = _origins(same, (doc, digest, low), first)
                again = np.flatnonzero(same & ~((doc == origin[0]) & (digest == origin[1]) & (low == origin[2])))
                again = again[np.lexsort((low[again], digest[again], doc[again]))]
                yield _intervals(doc[again], digest[again], low[again], low[again])
                last_string, first = key[-1], tuple(int(o[-1]) for o in origin)
            frame = frame[kind == 0]
            if not len(frame):
                continue
            held.append(frame)
            last = frame["key"].iat[-1]
            if frame["key"].iat[0] == last and (len(held) == 1 or held[0]["key"].iat[0] == last):
                continue  # one trigger so far
            whole = pd.concat(held, ignore_index=True)
            open_from = int(np.flatnonzero(whole["key"].to_numpy() != last)[-1]) + 1
            yield from settle(whole.iloc[:open_from].reset_index(drop=True))
            held = [whole.iloc[open_from:].reset_index(drop=True)]
        if held:
            yield from settle(pd.concat(held, ignore_index=True))

    return compare


def _opened(texts: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """What is left to compare: phrases by their trigger or, of crowded triggers, strings by their hash."""
    several = found.where("kind = 2").select(F.col("doc").alias("key"), F.col("low").alias("strings"))
    shared, crowded = _filter(several.select("key")), _filter(several.where(F.col("strings") > TOGETHER).select("key"))
    columns = "key long, kind byte, doc long, digest long, low long, high long, bytes binary"
    return texts.mapInPandas(_open_rows(length, shared, crowded), columns)


def repeated_starts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Intervals of starts (``doc``, ``digest``, ``low``, ``high``) whose string of ``length`` bytes starts earlier as well."""
    texts = docs.select(*identity(docs))
    phrases = texts.mapInPandas(
        _parse_rows(length), "trigger long, phrase long, doc long, digest long, low long, high long, kind byte"
    )
    ordered = spread(phrases, "trigger").sortWithinPartitions("trigger", "phrase", "doc", "digest", "low")
    found = cut_lineage(ordered.mapInPandas(_dictionary, "doc long, digest long, low long, high long, kind byte"))
    ordered = spread(_opened(texts, found, length), "key").sortWithinPartitions("kind", "key", "doc", "digest", "low")
    compared = ordered.mapInPandas(_compare(length), "doc long, digest long, low long, high long")
    return cut_lineage(found.where("kind = 1").drop("kind").unionByName(compared))


def _take_texts(shared):
    """The text only of rows that may have something removed."""

    def take(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(text=frame["text"].where(_passes(shared.value, frame["digest"].to_numpy()), None))

    return take


def removed_runs(intervals: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Bytes covered by the strings at the given starts, as maximal runs."""
    runs: list[list[int]] = []
    for low, high in sorted(intervals):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high + length)
        else:
            runs.append([low, high + length])
    return [tuple(r) for r in runs]


def _remove(length: int):
    def remove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, n, whole, intervals in zip(frame["text"], frame["n_bytes"], frame["kept_sha256"], frame["starts"]):
                if intervals is None or not len(intervals):
                    out.append((0, 0, whole, None))
                    continue
                data, runs = text.encode(), removed_runs([(i["low"], i["high"]) for i in intervals], length)
                edges = [0, *(x for r in runs for x in r), n]
                kept = b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2]))
                out.append((sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest(), kept.decode(errors="replace")))
            removed, spans, digest, kept = zip(*out) if out else ((), (), (), ())
            frame = frame.drop(columns=["starts", "text"])
            yield frame.assign(n_removed=removed, n_spans=spans, kept_sha256=digest, kept_text=kept)

    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and ``kept_text``.

    Each byte is removed that is covered by a string of ``length`` bytes which also starts
    earlier: in a smaller id, or in the same text at an earlier place.  ``kept_text`` is what
    remains, decoded with a replacement sign where a letter was cut; null where nothing is removed.

    1. Texts are parsed into phrases (``parse``).  A phrase that came before in the batch, or
       before in the corpus order of (trigger, phrase, id, place), has all its strings removed.
    2. What is left is the dictionary.  Triggers with a single phrase have no repeats.  The
       others are noted in a filter of a fixed size, and their phrases are read once more, now
       with their bytes, and brought together by trigger.
    3. Their strings are ordered; all but the earliest of equal ones are removed.  A trigger with
       more than ``TOGETHER`` strings is not brought together: its strings go by their own hash,
       each once per block of phrases, and are told apart in sorted order without being held.

    A phrase that many texts hold crosses the shuffle once per batch of rows.  Phrases and
    strings are compared by hashes of 64 bits.

    A null text is empty.  Rows without id come after all others.  Rows that repeat id and text
    are the same document and get the same result; rows that repeat an id with other texts come
    in the order of a hash.  Other columns do not matter.  An empty table gives no rows.
    """
    found = repeated_starts(docs, length)
    starts = found.groupBy("doc", "digest").agg(F.collect_list(F.struct("low", "high")).alias("starts"))
    shared = _filter(found.select(F.col("digest").alias("key")).distinct())
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *identity(docs)[:2],
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
        identity(docs)[2],
    )
    taken = "doc_id long, doc long, digest long, n_bytes long, kept_sha256 string, text string"
    rows = rows.mapInPandas(_take_texts(shared), taken)
    columns = "doc_id long, n_bytes long, kept_sha256 string, n_removed long, n_spans long, kept_text string"
    joined_rows = rows.join(starts, ["doc", "digest"], "left").drop("doc", "digest")
    done = joined_rows.mapInPandas(_remove(length), columns)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return done.select(*names, *["kept_text"] * with_text)
