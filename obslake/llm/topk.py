"""Exact top-k by inner product: an impact-ordered index processed score at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from obslake.session import cut_lineage

K = 20
SCALE = 64
QUERY_STEP = 20
BLOCK_ROWS = 8192
QUERIES_AT_ONCE = 512
# Impacts fall into levels by halves of the largest: the first holds those above 1/2, the next those above 1/4, ...
LEVELS = 3

PIECE = ["ids", "width", "kind", "cells"]
PACKED = "block long, piece int, ids binary, width int, kind string, cells binary"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``cells``: each component x as floor(scale * x).

    Rows with a null id, a null vector, or a null or non-finite component take no part.
    """
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fine, x).alias("cells")).where(
        "vec_id is not null and cells is not null"
    )


def _packer(rows: int):
    """Rows of one block as pieces of at most ``rows`` rows: ids, and a matrix padded with zeros to its widest row."""

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("vec_id", kind="stable", ignore_index=True)
        packed = []
        for first in range(0, len(block), rows):
            piece = block.iloc[first : first + rows]
            lengths = [len(c) for c in piece["cells"]]
            width = max(lengths)
            cells = np.zeros((len(piece), width), dtype=np.int64)
            for i, (n, c) in enumerate(zip(lengths, piece["cells"])):
                cells[i, :n] = c
            ids = piece["vec_id"].to_numpy(dtype=np.int64)
            most = int(np.abs(cells).max(initial=0))
            kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
            where = int(block["block"].iloc[0]), first // rows
            packed.append((*where, ids.tobytes(), width, kind, cells.astype(kind).tobytes()))
        return pd.DataFrame(packed, columns=["block", "piece", "ids", "width", "kind", "cells"])

    return pack


def _packed(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """``rows`` in blocks of about ``size``, and the number of blocks, which follows that of rows."""
    blocks = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "cells"), F.lit(blocks)).cast("long"))
    return cut_lineage(dealt.groupBy("block").applyInPandas(_packer(size), PACKED)), blocks


def _matrix(ids: bytes, width: int, kind: str, cells: bytes, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, dtype=np.int64)
    found = np.zeros((len(ids), wanted), dtype=np.int64)
    found[:, :width] = np.frombuffer(cells, dtype=kind).reshape(len(ids), width)
    return ids, found


class ImpactIndex:
    """Postings of one block of vectors in segments of falling impact.

    Segment s holds, for every dimension, the postings whose impact |v| lies in level s; the last
    holds the rest.  ``left[s]`` bounds, for each dimension, the impacts that come after segment s.
    """

    def __init__(self, cells: np.ndarray, kind: type, levels: int = LEVELS) -> None:
        self.cells = cells
        impact = np.abs(cells)
        top = int(impact.max(initial=0))
        level = np.zeros(cells.shape, dtype=np.int8)
        for s in range(1, levels):
            level[impact <= top >> s] = s
        self.segments = [np.where(level == s, cells, 0).astype(kind) for s in range(levels)]
        self.left = [np.where(level > s, impact, 0).max(axis=0, initial=0) for s in range(levels)]

    def search(self, own: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int, kind: type) -> list[tuple]:
        """For each query the ``k`` best rows: (query, row, score), ties to the smaller id."""
        active = np.arange(len(queries))
        sums = np.zeros((len(queries), len(ids)), dtype=kind)
        found: list[tuple] = []
        for s, segment in enumerate(self.segments):
            sums += queries[active].astype(kind) @ segment.T
            # Sums are within ``slack`` of the scores: whoever is further below the k-th sum is out, which is the proof.
            slack = np.abs(queries[active]) @ self.left[s]
            settled = np.zeros(len(active), dtype=bool)
            for i, q in enumerate(active):
                other = sums[i] if kind is object else sums[i].copy()
                same = ids == own[q]
                free = len(ids) - int(np.count_nonzero(same))
                if free > k:
                    other[same] = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
                    kth = np.partition(other, len(ids) - k)[len(ids) - k]
                    members = np.flatnonzero((other >= kth - 2 * slack[i]) & ~same)
                else:
                    members = np.flatnonzero(~same)
                if s + 1 < len(self.segments) and len(members) > 4 * k and free > 4 * k:
                    continue
                settled[i] = True
                scores = self.cells[members] @ queries[q]
                best = np.lexsort((ids[members], -scores))[:k]
                found.extend(zip([int(q)] * len(best), members[best].tolist(), scores[best].tolist()))
            active, sums = active[~settled], sums[~settled]
            if not len(active):
                break
        return found


def _search(k: int):
    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                width = max(row.width, row.q_width)
                ids, cells = _matrix(row.ids, row.width, row.kind, row.cells, width)
                own, queries = _matrix(row.q_ids, row.q_width, row.q_kind, row.q_cells, width)
                # Sums of float32 or float64 are exact up to 2^24 or 2^53; beyond that, 64-bit integers.
                most = int(np.abs(cells).max(initial=0)) * int(np.abs(queries).max(initial=0)) * width
                kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
                found = ImpactIndex(cells, kind).search(own, ids, queries, k, kind)
                q, members, scores = map(np.array, zip(*found)) if found else ([], [], [])
                q, members = np.asarray(q, dtype=np.int64), np.asarray(members, dtype=np.int64)
                yield pd.DataFrame(
                    {
                        "chunk": np.full(len(q), row.chunk, dtype=np.int64),
                        "part": np.full(len(q), row.part, dtype=np.int32),
                        "place": q,
                        "query_id": own[q],
                        "vec_id": ids[members],
                        "score": np.asarray(scores, dtype=np.int64),
                    }
                )

    return search


def top_k(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    k: int = K,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    queries_at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """The ``k`` rows of highest integer inner product for each query row: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Vectors (columns ``vec_id`` and ``embedding``) fall into blocks of about ``block_rows``, each
    with an index of its own; the query set, by default the rows whose id is divisible by 20,
    meets every block in pieces of ``queries_at_once``.  Within a block, segments of postings are
    processed from the highest quantised impact down for a piece of queries at once.  What is
    still to come bounds every score, and a query stops when the bound leaves few possible
    members, or none is left; those are rescored exactly.  Each block gives k rows for a query at
    most, of which the best k stay.  Every row is indexed and the result is exact.

    Ties go to the smaller id.  Null ids, null vectors and vectors with a null or non-finite
    component take no part.  A shorter vector counts as padded with zeros.  Rows that repeat an
    id are candidates each, except for the queries of that id; a repeated query row gets its k
    rows again.  Fewer than k candidates are all returned.  A score beyond 64 bits wraps, as a
    ``long`` does.  Other columns are ignored.
    """
    cells = cut_lineage(quantised(vectors, scale))
    asked = cells.where(F.col("vec_id") % QUERY_STEP == 0) if queries is None else quantised(queries, scale)
    blocks, _ = _packed(cells, block_rows)
    pieces, n = _packed(asked, queries_at_once)
    pieces = pieces.select(
        F.col("block").alias("chunk"), F.col("piece").alias("part"), *[F.col(c).alias(f"q_{c}") for c in PIECE]
    )
    # Whole blocks meet whole pieces of the stated query set: few, large rows.
    met = (
        blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>")))
        .join(pieces, "chunk")
        .repartition(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block", "piece", "chunk", "part")
    )
    near = met.mapInPandas(_search(k), "chunk long, part int, place long, query_id long, vec_id long, score long")
    best = Window.partitionBy("chunk", "part", "place").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
