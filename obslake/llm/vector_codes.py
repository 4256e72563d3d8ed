"""Product codes of vectors: integer k-means per part, with exact products from limb-split GEMM."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.columns import unused
from obslake.operators.dimension import left_join_dimension
from obslake.session import cut_lineage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Rows scored at once inside a task.
ROWS_AT_ONCE = 8192
_LOW = (1 << 32) - 1
_MOST = (1 << 63) - 1


def limb_bits(width: int) -> int:
    """How many bits a limb may have so that ``width`` products of limbs add up to 2^53 at most."""
    return (53 - max(0, width - 1).bit_length()) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Digits to the base 2^bits as float64, lowest first; the last one carries the sign."""
    found, rest = [], values
    while rest.size and max(int(rest.max()), -int(rest.min())) > 1 << bits:
        found.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*found, rest.astype(np.float64)]


def exact_products(a: list[np.ndarray], b: list[np.ndarray], bits: int) -> np.ndarray:
    """Inner products of all rows of two limb-split matrices as 64-bit integers.

    Each float64 product of two limbs is exact, so the sum of their shifted products is, too, as
    long as the true value fits 64 bits.
    """
    total = np.zeros((len(a[0]), len(b[0])), dtype=np.int64)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if bits * (i + j) < 64:
                total += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return total


class Codebook:
    """Entries of one part position, ready to be compared with the parts of vectors."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.bits = limb_bits(entries.shape[1])
        self._limbs = limbs(entries, self.bits)
        self._most = int(np.abs(entries).max(initial=0))

    def nearest(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the first entry at the least squared distance, and that distance."""
        most = max(self._most, int(np.abs(cells).max(initial=0)), 0)
        if cells.shape[1] * (2 * most) ** 2 > _MOST or cells.min(initial=0) == -_MOST - 1:
            return self._nearest_large(cells)
        squares = np.einsum("ij,ij->i", self.entries, self.entries)
        away = squares - 2 * exact_products(limbs(cells, self.bits), self._limbs, self.bits)
        codes = away.argmin(axis=1)
        own = np.einsum("ij,ij->i", cells, cells)
        return codes, own + away[np.arange(len(cells)), codes]

    def _nearest_large(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by integers of any length, for components whose squares exceed 64 bits."""
        codes = np.zeros(len(cells), dtype=np.int64)
        least = np.zeros(len(cells), dtype=object)
        entries = self.entries.astype(object)
        for row, cell in enumerate(cells.astype(object)):
            away = ((entries - cell) ** 2).sum(axis=1)
            codes[row] = min(range(len(away)), key=away.__getitem__)
            least[row] = away[codes[row]]
        return codes, least


def _parts(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """A column of integer lists as (row, part, component), padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths(), dtype=np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == parts * width).all():
        return values.reshape(len(column), parts, width)
    cells = np.zeros((len(column), parts * width), dtype=np.int64)
    cells[np.arange(parts * width) < lengths[:, None]] = values
    return cells.reshape(len(column), parts, width)


def _sums(codebooks: np.ndarray):
    """Inside a task: count and sums per (part, entry), the sums cut into 32 low bits and the rest."""
    parts, entries, width = codebooks.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        counts = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((2, parts, entries, width), dtype=np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                cells = _parts(batch.column("cells").slice(first, ROWS_AT_ONCE), parts, width)
                for p, book in enumerate(books):
                    codes, _ = book.nearest(cells[:, p])
                    order = np.argsort(codes, kind="stable")
                    present, starts, n = np.unique(codes[order], return_index=True, return_counts=True)
                    counts[p, present] += n
                    for half, values in enumerate((cells[order, p] >> 32, cells[order, p] & _LOW)):
                        sums[half, p, present] += np.add.reduceat(values, starts, axis=0)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(p, pa.int32()),
                "entry": pa.array(e, pa.int32()),
                "n": pa.array(counts[p, e], pa.int64()),
                "high": pa.array(list(sums[0, p, e]), pa.list_(pa.int64())),
                "low": pa.array(list(sums[1, p, e]), pa.list_(pa.int64())),
            }
        )

    return add


def _moved(cells: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round; entries that no part is nearest to stay."""
    summed = cells.mapInArrow(_sums(codebooks), "part int, entry int, n long, high array<long>, low array<long>")
    places = summed.select("part", "entry", "n", F.posexplode(F.arrays_zip("high", "low")).alias("place", "sums"))
    # As many rows as the codebooks have numbers.
    total = places.groupBy("part", "entry", "place").agg(
        F.sum("n").alias("n"), F.sum("sums.high").alias("high"), F.sum("sums.low").alias("low")
    )
    moved = codebooks.copy()
    for row in total.toLocalIterator():
        moved[row.part, row.entry, row.place] = ((row.high << 32) + row.low) // row.n
    return moved


def _coded(codebooks: np.ndarray):
    parts, _, width = codebooks.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                piece = batch.slice(first, ROWS_AT_ONCE)
                cells = _parts(piece.column("cells"), parts, width)
                codes, errors = zip(*[book.nearest(cells[:, p]) for p, book in enumerate(books)])
                exact = np.sum([e.astype(object) for e in errors], axis=0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": piece.column("vec_id"),
                        "label": piece.column("label"),
                        "code": pa.array(["".join(f"{c:02x}" for c in row) for row in np.stack(codes, axis=1).tolist()], pa.string()),
                        "error": pa.array([min(int(e), _MOST) for e in exact], pa.int64()),
                    }
                )

    return code


def codebooks_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components in decimal by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def fit_codes(
    vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks they refer to as (part, entry, component).

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``.  Each component x becomes
    floor(scale * x), and each vector is cut into ``parts`` equal stretches with a codebook each.
    Codebooks start as the parts of the rows with the smallest ids; each round assigns every part
    of every row to its nearest entry, ties to the lower index, and moves the entry to the floor
    of its parts' mean.  Distances are integers without rounding (limb-split products).  The
    result has ``vec_id``, ``label``, ``code`` (two hex digits or more per part) and ``error``,
    the squared distance to the entries of the code.

    Rows with a null vector, or with a null or non-finite component, are dropped.  A null id is a
    row like others and comes last in the order of ids; rows that repeat an id are ordered by
    their components.  Vectors of unlike or indivisible length count as padded with zeros.  With
    fewer rows than entries the codebooks are as small; an empty table gives no rows and empty
    codebooks.  A component beyond 64 bits after scaling becomes the nearest long, an error beyond
    them the largest.  Further columns are ignored, whatever their names.

    A round is one pass over the rows; what leaves a task is a sum per entry, and what reaches the
    driver is of the size of the codebooks.
    """
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    cells = cut_lineage(
        vectors.where(F.coalesce(fine, F.lit(False))).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").alias("label"),
            F.transform("embedding", lambda c: F.floor(c.cast("double") * scale)).alias("cells"),
        )
    )
    length = cells.agg(F.max(F.size("cells")).alias("n")).first()["n"] or 0
    width = -(-length // parts)
    first = cells.select("vec_id", "cells").orderBy(F.col("vec_id").asc_nulls_last(), "cells").limit(entries).collect()
    codebooks = np.zeros((parts, len(first), width), dtype=np.int64)
    for entry, row in enumerate(first):
        padded = np.zeros(parts * width, dtype=np.int64)
        padded[: len(row.cells)] = row.cells
        codebooks[:, entry] = padded.reshape(parts, width)
    if first:
        for _ in range(rounds):
            codebooks = _moved(cells, codebooks)
    kind = cells.schema["label"].dataType.simpleString()
    coded = cells.mapInArrow(_coded(codebooks), f"vec_id long, label {kind}, code string, error long")
    return coded, codebooks


def code_table(
    vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` for every kept vector.

    ``label_error`` is the sum of ``error`` over the rows with the same label, null labels
    together.  Rows, ties and odd input as in ``fit_codes``; a sum beyond 64 bits is the largest long.
    """
    coded, codebooks = fit_codes(vectors, scale, parts, entries, rounds)
    coded = cut_lineage(coded)
    key, total = unused(coded.columns, "key", "label_error")
    coded = coded.withColumn(key, F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    # Two halves keep the sums inside 64 bits.
    halves = coded.groupBy(key).agg(
        F.sum(F.shiftright("error", 32)).alias("high"), F.sum(F.col("error").bitwiseAND(F.lit(_LOW))).alias("low")
    )
    whole = F.col("high").cast("decimal(20,0)") * F.lit(Decimal(1 << 32)) + F.col("low").cast("decimal(20,0)")
    sums = halves.select(key, F.least(whole, F.lit(Decimal(_MOST))).cast("long").alias(total))
    return left_join_dimension(coded, sums, key, spread_by=["vec_id", "code"]).select(
        "vec_id", "code", "error", total, F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256")
    )
