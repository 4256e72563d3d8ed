"""N-gram Jaccard join with a token-group matrix.

Similar documents are partitioned into groups; a group is stored as the union of its members'
tokens; a query group is held against the matrix first, and only groups whose overlap can reach
the threshold are opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from obslake.llm.columns import spread, unused
from obslake.llm.components import components
from obslake.llm.hashing import NOT_SPACE, U64, mix, packs, words
from obslake.session import cut_lineage

WORDS, PERCENT = 3, 90
# Counters of tokens, whatever the corpus: more tokens make them coarser, never wrong.
COUNTERS, SLICES = 1 << 22, 64
# Tokens beyond the least prefix: so many must be shared, or all that a small set has to share.
SHARED = 4
GROUP_MEMBERS, GROUP_TOKENS = 128, 1 << 18
ASKED_AT_ONCE = 2048

_MOST = (1 << 31) - 1
_ODD = U64(0x9FB21C651E98DF25)
# Keys of a set: this many, each of so many least hashes.
KEYS, LEAST_HASHES = 3, 2
_SEEDS = [mix(np.array([0x2545F4914F6CDD1D + k], dtype=U64))[0] for k in range(KEYS * LEAST_HASHES)]


def shingle_sets(texts: list[bytes], n: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles of ``n`` words, as sorted hashes; all words if there are fewer; none without words."""
    hashes, _, _, at = words(texts, NOT_SPACE)
    counts = np.diff(at)
    factors = np.multiply.accumulate(np.full(n, _ODD))
    sums = np.zeros(len(hashes), dtype=U64)
    for k in range(min(n, len(hashes))):
        sums[: len(hashes) - k] += hashes[k:] * factors[k]
    sums = mix(sums)
    found = []
    for a, count in zip(at, counts):
        if count >= n:
            found.append(np.unique(sums[a : a + count - n + 1]))
        elif count:
            own = (hashes[a : a + count] * factors[:count]).sum(dtype=U64, keepdims=True)
            found.append(mix(own + U64(int(count))))
        else:
            found.append(np.zeros(0, dtype=U64))
    return found


def _least_shared(n: int, percent: int) -> int:
    """Tokens that a set of ``n`` shares at least with one it is linked to."""
    return -(-n * percent // 100)


def _signed(x) -> np.ndarray:
    return np.asarray(x, dtype=U64).astype(np.int64)


def _sets(frame: pd.DataFrame, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, texts in packs((t or "").encode() for t in frame["text"]):
        yield from enumerate(shingle_sets(texts, n), first)


def _keys(tokens: np.ndarray) -> np.ndarray:
    """Keys of a set; two sets agree in one of them the likelier, the more similar they are."""
    least = np.array([mix(tokens ^ seed).min() for seed in _SEEDS], dtype=U64).reshape(KEYS, LEAST_HASHES)
    keys = np.arange(1, KEYS + 1, dtype=U64)
    for k in range(LEAST_HASHES):
        keys = mix(keys * _ODD + least[:, k])
    return keys


def _count_tokens(n: int):
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(COUNTERS, dtype=np.int32)
        for frame in frames:
            for _, tokens in _sets(frame, n):
                np.add.at(counts, (tokens & U64(COUNTERS - 1)).astype(np.int64), 1)
        for k, own in enumerate(counts.reshape(SLICES, -1)):
            place = np.flatnonzero(own)
            # A task counts up to 65535; full slices go without places.
            if 2 * len(place) < len(own):
                places, own = place.astype("<i4").tobytes(), own[place]
            else:
                places = b""
            if len(place):
                yield pd.DataFrame({"slice": [k], "places": [places], "counts": [np.minimum(own, 65_535).astype("<u2").tobytes()]})

    return count


def _add_slices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for frame in frames:
        for row in frame.itertuples(index=False):
            own = sums.setdefault(row.slice, np.zeros(COUNTERS // SLICES, dtype=np.int64))
            places = np.frombuffer(row.places, dtype="<i4") if row.places else slice(None)
            own[places] += np.frombuffer(row.counts, dtype="<u2")
    for k, own in sums.items():
        yield pd.DataFrame({"slice": [k], "counts": [np.minimum(own, _MOST).astype("<i4").tobytes()]})


def token_counts(docs: DataFrame, n: int) -> np.ndarray:
    """How many texts hold a token of each of a fixed number of counters: counted in tasks, summed by slices."""
    parts = docs.select("text").mapInPandas(_count_tokens(n), "slice int, places binary, counts binary")
    summed = spread(parts, "slice").mapInPandas(_add_slices, "slice int, counts binary")
    counts = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.int32)
    for row in summed.collect():
        counts[row.slice] = np.frombuffer(bytes(row.counts), dtype="<i4")
    return counts.reshape(-1)


def _sketch(n: int, percent: int, shared):
    """Per text: size and digest of its set, keys that similar sets have in common, and its prefix of rare tokens."""

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shared.value
        for frame in frames:
            sizes = np.zeros(len(frame), dtype=np.int64)
            digests, keys, prefixes = np.zeros(len(frame), dtype=U64), [None] * len(frame), [None] * len(frame)
            for i, tokens in _sets(frame, n):
                size = sizes[i] = len(tokens)
                if not size:
                    keys[i] = prefixes[i] = np.zeros(0, dtype=np.int64)
                    continue
                mixed = mix(tokens)
                digests[i] = mix(np.array([mixed.sum(dtype=U64) ^ U64(int(size))]))[0]
                keys[i] = _signed(_keys(tokens))
                least = _least_shared(size, percent)
                length = min(size, size - least + min(SHARED, least))
                order = np.lexsort((tokens, counts[(tokens & U64(COUNTERS - 1)).astype(np.int64)]))
                prefixes[i] = _signed(tokens[order[:length]])
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "n": sizes, "digest": _signed(digests), "keys": keys, "tokens": prefixes}
            )

    return sketch


def _unions(percent: int):
    """Rows of the matrix: the tokens of each group, once, with what must be shared at least with one of its members."""

    def union(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lengths = np.array([len(t) for t in frame["tokens"]])
            if not lengths.sum():
                continue
            needs = np.array([min(SHARED, _least_shared(int(n), percent)) for n in frame["n"]])
            groups, inverse = np.unique(frame["grp"].to_numpy(), return_inverse=True)
            need = np.full(len(groups), SHARED)
            np.minimum.at(need, inverse, needs)
            rows = np.unique(np.stack((np.concatenate(frame["tokens"].to_numpy()), np.repeat(inverse, lengths)), axis=1), axis=0)
            yield pd.DataFrame({"token": rows[:, 0], "grp": groups[rows[:, 1]], "need": need[rows[:, 1]].astype(np.int32)})

    return union


def _pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of groups that meet at a token, for rows sorted by token; equal pairs of a batch are counted."""
    held_token, held = None, {}
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def meet(groups: np.ndarray, needs: np.ndarray) -> Iterator[pd.DataFrame]:
        order = np.argsort(groups)
        groups, needs = groups[order], needs[order]
        for k in range(len(groups) - 1):
            out.append((np.full(len(groups) - k - 1, groups[k]), groups[k + 1 :], np.minimum(needs[k], needs[k + 1 :])))
            if sum(len(o[0]) for o in out[-64:]) > 1 << 18:
                yield from flush()

    def flush() -> Iterator[pd.DataFrame]:
        if out:
            a, b, need = (np.concatenate(c) for c in zip(*out))
            out.clear()
            frame = pd.DataFrame({"a": a, "b": b, "shared": 1, "need": need})
            yield frame.groupby(["a", "b"], as_index=False).agg({"shared": "sum", "need": "min"})

    def close() -> Iterator[pd.DataFrame]:
        if len(held) > 1:
            yield from meet(np.array(list(held)), np.array(list(held.values())))

    for frame in frames:
        token, group, need = (frame[c].to_numpy() for c in ("token", "grp", "need"))
        if not len(token):
            continue
        edges = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True])))
        last = len(edges) - 2
        # Runs of one row in the middle of a batch meet nobody.
        for k in np.flatnonzero((np.diff(edges) > 1) | (np.arange(last + 1) == 0) | (np.arange(last + 1) == last)):
            a, b = edges[k], edges[k + 1]
            if token[a] != held_token:
                yield from close()
                held_token, held = token[a], {}
            for g, m in zip(group[a:b].tolist(), need[a:b].tolist()):
                held[g] = min(m, held.get(g, m))
            if k != last:
                yield from close()
                held_token, held = None, {}
        yield from flush()
    yield from close()
    yield from flush()


class _Group:
    """An opened group: its token union with the members of each token."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.digests: list[int] = []
        self.sets: list[np.ndarray] = []
        self.weights: list[int] = []
        self.seen: set[int] = set()
        self.root: list[int] = []

    def add(self, digest: int, tokens: np.ndarray, weight: int) -> None:
        if digest not in self.seen:
            self.seen.add(digest)
            self.digests.append(digest)
            self.sets.append(tokens)
            self.weights.append(weight)

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def build(self) -> list[tuple]:
        """Index the members; returns edges that connect those linked with each other."""
        self.sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        tokens = np.concatenate(self.sets)
        order = np.argsort(tokens, kind="stable")
        self.members = np.repeat(np.arange(len(self.sets)), self.sizes)[order]
        self.union, self.first = np.unique(tokens[order], return_index=True)
        self.first = np.append(self.first, len(tokens))
        self.root = list(range(len(self.sets)))
        self.links = np.zeros(len(self.sets), dtype=np.int64)
        self.weight = np.array(self.weights, dtype=np.int64)
        edges = []
        for i, own in enumerate(self.sets):
            linked = self.linked(own)
            linked = linked[linked != i]
            self.links[i] += self.weight[linked].sum()
            for j in linked.tolist():
                a, b = self._find(i), self._find(j)
                if a != b:
                    self.root[max(a, b)] = min(a, b)
                    edges.append((self.digests[i], self.digests[j], 0))
        self.own_links = self.links.copy()
        self.links[:] = 0
        return edges

    def linked(self, tokens: np.ndarray) -> np.ndarray:
        """Members at or above the threshold.  The overlap with the union bounds that with each member."""
        at = np.searchsorted(self.union, tokens)
        at[at == len(self.union)] = 0
        at = at[self.union[at] == tokens]
        if 100 * len(at) < self.percent * max(len(tokens), int(self.sizes.min())):
            return np.zeros(0, dtype=np.int64)
        lengths = self.first[at + 1] - self.first[at]
        where = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths - self.first[at], lengths)
        both = np.bincount(self.members[where], minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= self.percent * (self.sizes + len(tokens) - both))

    def ask(self, digest: int, tokens: np.ndarray, weight: int) -> list[tuple]:
        """An edge to each part of the group that is connected within, and the number of links."""
        linked = self.linked(tokens)
        if not len(linked):
            return []
        self.links[linked] += weight
        parts = {self._find(j): self.digests[j] for j in linked.tolist()}
        return [(digest, other, 0) for other in parts.values()] + [(digest, None, int(self.weight[linked].sum()))]

    def closed(self, count_own: bool) -> list[tuple]:
        links = self.links + (self.own_links if count_own else 0)
        return [(d, None, int(k)) for d, k in zip(self.digests, links) if k]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    a, b, links = zip(*rows) if rows else ((), (), ())
    # Whole numbers of 64 bits would lose digits beside a null in a plain column.
    return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": pd.array(b, dtype="Int64"), "links": np.array(links, dtype=np.int64)})


def _verify(n: int, percent: int):
    """Open each group and ask the sets routed to it: rows (a, b, 0) are links, rows (a, null, k) count k of them."""

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, group, built, asked = None, None, False, set()
        for frame in frames:
            out: list[tuple] = []
            rows = list(frame[["target", "salt", "kind", "digest", "weight"]].itertuples(index=False, name=None))
            for i, tokens in _sets(frame, n):
                target, salt, kind, digest, weight = rows[i]
                if (target, salt) != held:
                    if group is not None and group.sets:
                        edges = [] if built else group.build()
                        out += (edges if held[1] == 0 and not built else []) + group.closed(held[1] == 0)
                    held, group, built, asked = (target, salt), _Group(percent), False, set()
                mixed = mix(tokens)
                if int(_signed(mix(np.array([mixed.sum(dtype=U64) ^ U64(len(tokens))])))[0]) != digest:
                    continue  # another text with the same id
                if kind == 0:
                    group.add(digest, tokens, weight)
                elif group.sets and digest not in asked:
                    asked.add(digest)
                    if not built:
                        edges, built = group.build(), True
                        out += edges if salt == 0 else []
                    out += group.ask(digest, tokens, weight)
            yield _frame(out)
        if group is not None and group.sets:
            edges = [] if built else group.build()
            out = (edges if held[1] == 0 and not built else []) + group.closed(held[1] == 0)
            yield _frame(out)

    return verify


def _grouped(sketches: DataFrame) -> DataFrame:
    """A row per distinct set, with its least id, its number of rows and its group.

    Sets with the same key are similar as a rule.  Of its keys a set takes the one that most sets
    have, so a cloud of near copies gathers in few groups instead of leaving one for each copy whose
    changes touch a least hash.  A key with many sets, or large ones, is dealt over as many groups as
    keep each of them bounded.
    """
    sets = sketches.where("n > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("least"),
        F.count("*").alias("weight"),
        F.any_value("n").alias("n"),
        F.any_value("keys").alias("keys"),
        F.any_value("tokens").alias("tokens"),
    )
    sets = cut_lineage(sets)
    keys = sets.select("digest", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1")
    most = keys.join(shared, "key").groupBy("digest").agg(F.max_by("key", F.struct("sets", "key")).alias("most"))
    own = F.coalesce("most", F.element_at("keys", 1)).alias("key")
    sets = cut_lineage(sets.join(most, "digest", "left").select("digest", "least", "weight", "n", "tokens", own))
    parts = F.greatest(F.ceil(F.count("*") / GROUP_MEMBERS), F.ceil(F.sum("n") / GROUP_TOKENS))
    full = sets.groupBy("key").agg(parts.alias("parts")).where("parts > 1")
    group = F.xxhash64("key", F.pmod(F.xxhash64("digest"), F.coalesce("parts", F.lit(1))))
    return cut_lineage(sets.join(full, "key", "left").select("digest", "least", "weight", "n", "tokens", group.alias("grp")))


def _qualifying(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups that share as many rare tokens as linked members would: ``b``, the smaller one, asks ``a``."""
    rows = spread(sets.select("grp", "n", "tokens"), "grp").sortWithinPartitions("grp")
    matrix = rows.mapInPandas(_unions(percent), "token long, grp long, need int")
    met = spread(matrix, "token").sortWithinPartitions("token").mapInPandas(_pairs, "a long, b long, shared long, need long")
    pairs = met.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need")).where("shared >= need")
    sizes = sets.groupBy("grp").agg(F.count("*").alias("size"))
    of = lambda c: sizes.select(F.col("grp").alias(c), F.col("size").alias(f"size_{c}"))
    turned = F.col("size_a") < F.col("size_b")
    return cut_lineage(
        pairs.join(of("a"), "a").join(of("b"), "b").select(
            F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"),
            F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"),
            F.least("size_a", "size_b").alias("size"),
        )
    )


def _routes(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Where each set goes: to its own group as a member, and to the groups its group has to ask.

    A group asked by many is opened in several places (``salt``).
    """
    sets = sets.drop("tokens", "n")
    sizes = sets.groupBy("grp").agg(F.count("*").alias("size"))
    asks = pairs.groupBy("a").agg(F.ceil(F.sum("size") / ASKED_AT_ONCE).alias("parts"))
    opened = (
        sizes.join(asks.withColumnRenamed("a", "grp"), "grp", "left")
        .where("size > 1 or parts is not null")
        .select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1)).alias("salt"))
    )
    members = sets.join(opened, "grp").select(F.col("grp").alias("target"), "salt", F.lit(0).alias("kind"), "least", "digest", "weight")
    asked = (
        pairs.join(asks, "a")
        .select("a", F.col("b").alias("grp"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("long").alias("salt"))
        .join(sets, "grp")
        .select(F.col("a").alias("target"), "salt", F.lit(1).alias("kind"), "least", "digest", "weight")
    )
    return members.unionByName(asked)


def jaccard_components(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``n_links``.

    Texts are split by white space after A-Z are lowered; a set has the distinct shingles of
    ``n`` words, or all words as one if there are fewer.  Two documents are linked when
    100 * intersection >= ``percent`` * union; a component has the smallest id that is reachable
    by links.  Shingles, words and sets are compared by hashes of 64 bits.

    1. Tokens are counted in a fixed number of counters.  By (count, hash) all tokens have one
       order, in which a set's rare tokens come first.  Linked sets share tokens of their
       prefixes, whatever the order is; a good one makes others share none.
    2. Copies are folded into one set.  Sets with the same pair of least hashes form a group of
       at most about 128; of three such pairs a set goes by the one most sets have.  The matrix
       holds the tokens of each group's prefixes, once.
    3. Groups that share enough of the matrix are paired.  In a task, the members of a group are
       indexed by token; a set that overlaps with the union of their tokens by less than the
       threshold asks is turned away, and else its overlap with each member is counted.
    4. A link is handed on once for each part of a group that hangs together, and components come
       from stars over those.

    Every pair at or above the threshold is found, and no pair is formed of copies.  ``n_links``
    counts the linked documents, copies among them.

    Texts that are null or have no words have no shingles and no links: their component is their
    own id.  Rows without id are not linked; they have no component.  Repeated ids stand for
    their texts each; a component is then known by the id.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    counts = spark.sparkContext.broadcast(token_counts(texts, n))
    sketches = cut_lineage(
        texts.mapInPandas(_sketch(n, percent, counts), "doc_id long, n long, digest long, keys array<bigint>, tokens array<bigint>")
    )
    counts.destroy()
    sets = _grouped(sketches)
    routes = _routes(sets, _qualifying(sets, percent))
    opened = routes.join(texts.withColumnRenamed("doc_id", "least"), "least").drop("least")
    found = cut_lineage(
        spread(opened, "target", "salt")
        .sortWithinPartitions("target", "salt", "kind", "digest")
        .mapInPandas(_verify(n, percent), "a long, b long, links long")
    )
    nodes = components(found.where("b is not null").select("a", "b"))
    least = sets.select(F.col("digest").alias("node"), "least", "weight")
    joined = nodes.join(least, "node")
    smallest = joined.groupBy("component").agg(F.min("least").alias("smallest"))
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    linked = nodes.join(smallest, "component").select("node", "smallest")
    of_set = (
        least.join(linked, "node", "left")
        .join(links, "node", "left")
        .where("smallest is not null or weight > 1")
        .select(
            F.col("node").alias("digest"),
            F.coalesce("smallest", "least").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
        )
    )
    rows = sketches.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    return rows.join(of_set, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of near copies, the one with the smallest id, and all rows that are linked with none.

    Rows are told apart by id and text, so a text that shares its id with another one's copy stays.
    Rows without id count as well and come after all others; of equal ids the text's hash decides.
    Of rows that repeat id and text one stays, any of them.  Rows without words are linked with none.
    """
    (row,) = unused(docs.columns, "row")
    keyed = docs.withColumn(row, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))
    found = jaccard_components(keyed.select(F.col(row).alias("doc_id"), "text"), n, percent)
    ids = keyed.groupBy(F.col(row).alias("row")).agg(F.min("doc_id").alias("id"), F.count("*").alias("rows"))
    linked = found.where("n_links > 0").groupBy(F.col("doc_id").alias("row")).agg(F.min("component_id").alias("component"))
    linked = cut_lineage(linked.join(ids, "row"))
    order = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    first = linked.groupBy("component").agg(order).select(F.col("first.row").alias("row"), F.lit(True).alias("stays"))
    marked = cut_lineage(linked.join(first, "row", "left").select(F.col("row").alias(row), "stays", "rows"))
    single = keyed.join(marked.where("stays is null or rows > 1").select(row), row, "left_anti")
    repeated = keyed.join(marked.where("stays and rows > 1").select(row), row, "left_semi").dropDuplicates([row])
    return single.select(*docs.columns).unionByName(repeated.select(*docs.columns))
