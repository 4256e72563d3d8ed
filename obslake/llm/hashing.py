"""Vectorised hashing of words and byte windows, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

U64 = np.uint64
# The multipliers of splitmix64 and an odd base for the rolling hash.
_GOLDEN, _M1, _M2 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)

PACK_BYTES = 1 << 20

# Bytes split by white space 20, 09-0D; and words of digits, letters and bytes beyond ASCII.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x + _GOLDEN
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


_BYTES = mix(np.arange(1, 257, dtype=U64))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """Powers 0 to n of ``base`` modulo 2^64; kept, and at most doubled when more are needed."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        factors = np.full(max(n + 1, 2 * PACK_BYTES), base, dtype=U64)
        factors[0] = 1
        known = _powers[base] = np.multiply.accumulate(factors)
    return known


class Rolling:
    """Hashes of any byte ranges of one array, from prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self._sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(_BYTES[data] * _power(_BASE, n)[:n], out=self._sums[1:])
        self._back = _power(_INVERSE, n)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._back[starts])


def packs(texts: Iterable[bytes], size: int = PACK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``size`` bytes, each with the index of its first text."""
    first, held, total = 0, [], 0
    for i, text in enumerate(texts):
        if held and total + len(text) > size:
            yield first, held
            first, held, total = i, [], 0
        held.append(text)
        total += len(text) + 1
    if held:
        yield first, held


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one array, each followed by a line feed, and the offset of each (one more at the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return data, offsets


def words(texts: list[bytes], kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words of all texts: hashes, starts, ends, and where each text's words begin (one more at the end)."""
    data, offsets = joined(texts)
    data = LOWER[data]
    inside = kind[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    return Rolling(data).of(starts, ends), starts, ends, np.searchsorted(starts, offsets)
