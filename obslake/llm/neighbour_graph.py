"""Near duplicates among vectors: a robust-pruned flat graph over overlapping shards, searched by range."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.columns import spread
from obslake.llm.components import components
from obslake.operators.dimension import left_join_dimension
from obslake.session import cut_lineage

COSINE = 0.9
# Shards hold about this many vectors, times the number of shards a vector is in.
SHARD_ROWS = 2048
MAX_SHARDS = 4096
# Centroids are fitted on at most this many vectors, those with the least hashes.
SAMPLE_ROWS = 32_768
FIT_ROUNDS = 8
OVERLAP = 3
# Graph: candidates per vector, kept neighbours, and how much nearer a kept one must be to drop another.
CANDIDATES = 64
DEGREE = 24
ALPHA = 1.2
# Nodes a search opens before it looks no further than the range.
BEAM = 24
AUDIT_ROWS = 1024
LEAST_RECALL = 0.9
# Below the range by more than single precision can be wrong by.
_SLACK = 1e-4
_CELLS = 1 << 22


def unit_rows(packed: list[bytes], kind: str, width: int | None = None) -> np.ndarray:
    """Unit vectors in double precision, padded with zeros to the widest."""
    rows = [np.frombuffer(p, dtype=kind) for p in packed]
    cells = np.zeros((len(rows), width or max(map(len, rows), default=0)))
    for i, row in enumerate(rows):
        cells[i, : len(row)] = row[: cells.shape[1]]
    # Scaled first, so that squares of huge or tiny components stay finite.
    cells /= np.abs(cells).max(axis=1, initial=0, keepdims=True)
    return cells / np.sqrt(np.einsum("ij,ij->i", cells, cells))[:, None]


def _packer(kind: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed: list[bytes | None] = []
            for vector in batch.column("embedding"):
                cells = None if vector.values is None else vector.values
                if cells is None or cells.null_count or not len(cells):
                    packed.append(None)
                    continue
                row = cells.to_numpy().astype(kind) + 0.0
                packed.append(row.tobytes() if np.isfinite(row).all() and row.any() else None)
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "packed": pa.array(packed, pa.binary())})

    return pack


def fit_centroids(units: np.ndarray, shards: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Directions of about ``shards`` clusters of a sample, by spherical k-means from evenly spaced rows."""
    x = units.astype(np.float32)
    centres = x[np.linspace(0, len(x) - 1, shards).astype(int)]
    for _ in range(rounds if shards > 1 else 1):
        nearest = np.concatenate([(x[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        size = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-30)[:, None], centres)
    return centres


def _router(centres: np.ndarray, overlap: int, kind: str):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                piece = batch.slice(first, 2048)
                x = unit_rows(piece.column("packed").to_pylist(), kind, centres.shape[1]).astype(np.float32)
                near = np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :overlap]
                cells = pa.array(np.sort(near, axis=1).tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*piece.columns, cells], names=[*piece.schema.names, "shards"])

    return route


def robust_pruned(x: np.ndarray, candidates: int = CANDIDATES, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbours of each unit vector: of its nearest ones, nearest first, those that no kept one is ``alpha`` times nearer to."""
    x = x.astype(np.float32)
    found: list[np.ndarray] = []
    count = min(candidates, len(x) - 1)
    step = max(1, min(256, _CELLS // max(1, len(x))))
    for first in range(0, len(x) if count > 0 else 0, step):
        rows = np.arange(first, min(first + step, len(x)))
        near = x[rows] @ x.T
        near[np.arange(len(rows)), rows] = -2
        ids = np.argpartition(-near, count - 1, axis=1)[:, :count]
        cosine = np.take_along_axis(near, ids, axis=1)
        order = np.argsort(-cosine, axis=1, kind="stable")
        ids, cosine = np.take_along_axis(ids, order, axis=1), np.take_along_axis(cosine, order, axis=1)
        away = np.sqrt(np.maximum(0, 2 - 2 * cosine))
        vectors = x[ids]
        between = np.sqrt(np.maximum(0, 2 - 2 * (vectors @ vectors.transpose(0, 2, 1))))
        alive = np.ones(ids.shape, dtype=bool)
        kept = np.zeros(ids.shape, dtype=bool)
        for j in range(count):
            kept[:, j] = alive[:, j] & (kept.sum(axis=1) < degree)
            alive &= ~(kept[:, j, None] & (alpha * between[:, j] <= away))
        found.extend(i[k] for i, k in zip(ids, kept))
    return found or [np.zeros(0, dtype=np.int64)] * len(x)


def _build(kind: str):
    def build(shard: pd.DataFrame) -> pd.DataFrame:
        nodes = shard["node"].to_numpy()
        near = robust_pruned(unit_rows(shard["packed"].tolist(), kind))
        return pd.DataFrame({"node": nodes, "neighbours": [nodes[n].tolist() for n in near]})

    return build


class RangeSearch:
    """Range-expanding greedy search over the graph of one shard."""

    def __init__(self, units: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> None:
        self.units = units
        self.fast = units.astype(np.float32)
        order = np.argsort(heads, kind="stable")
        self.tails = tails[order]
        self.starts = np.searchsorted(heads[order], np.arange(len(units) + 1))
        middle = self.fast.sum(axis=0)
        self.medoid = int((self.fast @ middle).argmax()) if len(units) else 0

    def _opened(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours of the nodes, and which of the nodes each belongs to."""
        degree = self.starts[nodes + 1] - self.starts[nodes]
        owner = np.repeat(np.arange(len(nodes)), degree)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(degree) - degree, degree)
        return self.tails[self.starts[nodes][owner] + inside], owner

    def within(self, queries: np.ndarray, cosine: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``queries``, node) at ``cosine`` or above, the query itself left out.

        Each search starts at the medoid and, since a query is a node, at its own place.  It opens the
        nearest node that it has seen, ``beam`` of them, and then every node inside the range.
        """
        waiting = np.full((len(queries), len(self.units)), -np.inf, dtype=np.float32)
        seen = np.zeros(waiting.shape, dtype=bool)
        near: list[tuple[np.ndarray, np.ndarray]] = []
        at = np.arange(len(queries))

        def see(q: np.ndarray, nodes: np.ndarray) -> None:
            cosines = np.einsum("ij,ij->i", self.fast[queries[q]], self.fast[nodes])
            waiting[q, nodes] = cosines
            seen[q, nodes] = True
            inside = (cosines >= cosine - _SLACK) & (nodes != queries[q])
            near.append((q[inside], nodes[inside]))

        see(at, np.full(len(queries), self.medoid))
        other = queries != self.medoid
        see(at[other], queries[other])
        active, opened = at, 0
        while len(active):
            view = waiting if len(active) == len(queries) else waiting[active]
            best = view.argmax(axis=1)
            value = view[np.arange(len(active)), best]
            go = np.isfinite(value) & ((value >= cosine - _SLACK) | (opened < beam))
            active, best = active[go], best[go]
            waiting[active, best] = -np.inf
            nodes, owner = self._opened(best)
            q = active[owner]
            new = ~seen[q, nodes]
            q, nodes = q[new], nodes[new]
            for first in range(0, len(q), 1 << 16):
                see(q[first : first + (1 << 16)], nodes[first : first + (1 << 16)])
            opened += 1
        q, nodes = (np.concatenate(part) for part in zip(*near))
        exact = np.zeros(len(q), dtype=bool)
        for first in range(0, len(q), 1 << 16):
            piece = slice(first, first + (1 << 16))
            exact[piece] = np.einsum("ij,ij->i", self.units[queries[q[piece]]], self.units[nodes[piece]]) >= cosine
        return q[exact], nodes[exact]


def _joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The forest with the trees of each pair (a, b) made one; roots are the least places."""
    while True:
        while (parent[parent] != parent).any():
            parent = parent[parent]
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])


def _search(kind: str, cosine: float, beam: int):
    def search(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("node", ignore_index=True)
        number = int(shard["shard"].iloc[0])
        nodes = shard["node"].to_numpy()
        copies = shard["copies"].to_numpy()
        members = np.stack(shard["shards"].to_list())
        heads = np.repeat(np.arange(len(nodes)), [len(n) for n in shard["neighbours"]])
        keys = np.concatenate(shard["neighbours"].to_list()) if len(heads) else np.zeros(0, dtype=np.int64)
        tails = np.minimum(np.searchsorted(nodes, keys), len(nodes) - 1)
        here = nodes[tails] == keys
        heads, tails = np.concatenate([heads[here], tails[here]]), np.concatenate([tails[here], heads[here]])
        edges = np.unique(heads.astype(np.int64) * len(nodes) + tails)
        graph = RangeSearch(unit_rows(shard["packed"].tolist(), kind), edges // len(nodes), edges % len(nodes))
        links = np.zeros(len(nodes), dtype=np.int64)
        parent = np.arange(len(nodes))
        step = max(1, min(1024, _CELLS // len(nodes)))
        for first in range(0, len(nodes), step):
            queries = np.arange(first, min(first + step, len(nodes)))
            q, found = graph.within(queries, cosine, beam)
            q = queries[q]
            parent = _joined(parent, q, found)
            # A pair that shares several shards counts in the first of them.
            counted = np.zeros(len(q), dtype=bool)
            for part in range(0, len(q), 1 << 16):
                piece = slice(part, part + (1 << 16))
                mine, other = members[q[piece]], members[found[piece]]
                shared = (mine[:, :, None] == other[:, None, :]).any(axis=2)
                counted[piece] = np.where(shared, mine, np.iinfo(np.int32).max).min(axis=1) == number
            links += np.bincount(q[counted], weights=copies[found[counted]], minlength=len(nodes)).astype(np.int64)
        return pd.DataFrame({"node": nodes, "links": links, "root": nodes[parent]})

    return search


def _audited(units: np.ndarray, cosine: float, kind: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(units), dtype=np.int64)
        for batch in batches:
            copies = np.asarray(batch.column("copies"))
            for first in range(0, batch.num_rows, 2048):
                x = unit_rows(batch.column("packed").slice(first, 2048).to_pylist(), kind, units.shape[1])
                total += (units @ x.T >= cosine) @ copies[first : first + 2048]
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(len(units)), pa.int32()), "n": pa.array(total, pa.int64())})

    return count


def audit_recall(nodes: DataFrame, found: DataFrame, kind: str, width: int, cosine: float = COSINE, rows: int = AUDIT_ROWS) -> float:
    """Links found over links there are, for a sample of vectors compared with all others; 1.0 without links.

    The sample is the ``rows`` vectors whose hash comes first; all rows are read once.
    """
    # Each task adds rows of the sample's size, and the driver gets their sums.
    asked = (
        nodes.select("node", "packed", "copies")
        .orderBy(F.xxhash64(F.lit("audit"), "node"))
        .limit(rows)
        .join(found, "node", "left")
        .select("packed", "copies", F.coalesce("links", F.lit(0)).alias("links"))
        .collect()
    )
    if not asked:
        return 1.0
    units = unit_rows([r.packed for r in asked], kind, width)
    counts = nodes.mapInArrow(_audited(units, cosine, kind), "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    # Every vector is within the range of itself and its copies; links of those need no graph.
    true = {r.place: r.n - asked[r.place].copies for r in counts.collect()}
    there = sum(true.values())
    return min(1.0, sum(min(a.links, true[i]) for i, a in enumerate(asked)) / there) if there else 1.0


def link_nodes(
    nodes: DataFrame, kind: str, width: int, cosine: float = COSINE, shard_rows: int = SHARD_ROWS, overlap: int = OVERLAP, beam: int = BEAM
) -> tuple[DataFrame, DataFrame]:
    """``(node, links)`` and the edges ``(a, b)`` that connect linked nodes.

    ``nodes`` are different vectors with a key (``node``), packed components and their number of copies.
    """
    total = nodes.count()
    shards = max(1, min(MAX_SHARDS, -(-total // shard_rows)))
    sample = nodes.select("packed").orderBy(F.xxhash64("node")).limit(SAMPLE_ROWS).collect() if total else []
    centres = fit_centroids(unit_rows([r.packed for r in sample], kind, width), shards) if sample else np.zeros((1, width), np.float32)
    # One task reads few rows, and each is compared with all centroids.
    routed = cut_lineage(
        spread(nodes.select("node", "packed", "copies"), "node").mapInArrow(
            _router(centres, overlap, kind), "node long, packed binary, copies long, shards array<int>"
        )
    )
    graph = (
        routed.select(F.explode("shards").alias("shard"), "node", "packed")
        .groupBy("shard")
        .applyInPandas(_build(kind), "node long, neighbours array<long>")
    )
    united = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    found = cut_lineage(
        routed.join(united, "node")
        .select(F.explode("shards").alias("shard"), "node", "packed", "copies", "shards", "neighbours")
        .groupBy("shard")
        .applyInPandas(_search(kind, cosine, beam), "node long, links long, root long")
    )
    links = cut_lineage(found.groupBy("node").agg(F.sum("links").alias("links")))
    return links, found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, shard_rows: int = SHARD_ROWS, overlap: int = OVERLAP, beam: int = BEAM) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    Rows (columns ``vec_id`` and ``embedding``) link when the cosine of their vectors, in double
    precision, is at least ``cosine``.  ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable by links, itself included, and ``kept`` says
    that the row has that id.

    Equal vectors are folded into one node first, so copies cost nothing more however many there
    are.  Nodes go to the ``overlap`` nearest of the shards, whose centroids are fitted on a bounded
    sample (``SAMPLE_ROWS``).  Each shard builds a graph: the nearest candidates of a node, robustly
    pruned.  The lists a node got in its shards are united, and each shard searches the united
    graph for all its nodes, from its medoid, expanding everything inside the range.  Every
    link is verified in double precision; a pair in several shards is counted in the first.

    Afterwards a sample of nodes is compared with all others.  If less than ``LEAST_RECALL`` of
    their links were found, overlap, shards and beam are widened and the search runs again, up to
    a single shard; links between more different vectors than fit a few shards need that.

    Null, empty or zero vectors, those with a null or non-finite component, and rows with a null id
    link with nothing and are components of their own.  Rows that repeat an id and a vector are
    linked rows.  A shorter vector counts as padded with zeros.  An empty table gives no rows.
    Further columns are ignored, whatever their names.
    """
    double = "double" in vectors.schema["embedding"].dataType.simpleString()
    kind = "<f8" if double else "<f4"
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    packed = ids.mapInArrow(_packer(kind), "vec_id long, packed binary")
    key = F.when(F.col("vec_id").isNotNull(), F.xxhash64("packed"))
    rows = cut_lineage(packed.withColumn("node", F.when(F.col("packed").isNotNull(), key)))
    nodes = cut_lineage(
        rows.where("node is not null").groupBy("packed", "node").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    )
    bytes_each = 8 if double else 4
    width = (nodes.agg(F.max(F.octet_length("packed")).alias("n")).first()["n"] or 0) // bytes_each
    while True:
        links, edges = link_nodes(nodes, kind, width, cosine, shard_rows, overlap, beam)
        recall = audit_recall(nodes, links, kind, width, cosine)
        if recall >= LEAST_RECALL:
            break
        if shard_rows > (1 << 24) and beam > (1 << 12):
            raise RuntimeError(f"recall of {recall:.3f} after widening")
        shard_rows, overlap, beam = shard_rows * 4, overlap + 2, beam * 4
    groups = components(edges)
    named = nodes.join(groups, nodes["node"] == groups["node"], "left").select(
        nodes["node"], "least", "copies", F.coalesce("component", nodes["node"]).alias("component")
    )
    named = cut_lineage(named)
    least = named.groupBy("component").agg(F.min("least").alias("first"))
    facts = cut_lineage(
        left_join_dimension(named, least, "component", spread_by=["node"])
        .join(links, "node", "left")
        .select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("first").alias("component_id"))
    )
    out = left_join_dimension(rows.select("vec_id", "node"), facts, "node", spread_by=["vec_id"])
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
