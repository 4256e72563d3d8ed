import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from obslake.llm.vector_codes import Codebook, code_table, exact_products, fit_codes, limb_bits, limbs

SCHEMA = "vec_id long, embedding array<float>, label int, code string, Cells int"


def brute(rows, parts, entries, rounds, scale=1024):
    kept = [(i, label, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, label, *_ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(c) for *_, c in kept), default=0) // parts)
    kept = [(i, label, c + [0] * (parts * width - len(c))) for i, label, c in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cut = [[c[p * width : (p + 1) * width] for p in range(parts)] for *_, c in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        away = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        for p in range(parts):
            codes = [nearest(p, c[p])[0] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, code in zip(cut, codes) if code == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for (i, label, _), c in zip(kept, cut):
        found = [nearest(p, c[p]) for p in range(parts)]
        coded.append((i, label, "".join(f"{k:02x}" for k, _ in found), sum(d for _, d in found)))
    sums = {}
    for _, label, _, error in coded:
        sums[label] = sums.get(label, 0) + error
    return sorted([(i, code, error, sums[label], digest) for i, label, code, error in coded], key=repr)


def rows_of(n, width, scale=0.3, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i * 3 % n, [float(x) for x in rng.normal(0, scale, width)], [None, 1, 2][i % 3], "x", 1) for i in range(n)]
    rows[-1] = (rows[-1][0], rows[10][1], 2, "x", 1)
    return rows


def found(spark, rows, *settings):
    return sorted(map(tuple, code_table(spark.createDataFrame(rows, SCHEMA), 1024, *settings).collect()), key=repr)


@pytest.mark.parametrize("width,entries", [(16, 8), (13, 300), (4, 1)])
def test_matches_brute_force(spark, width, entries):
    rows = rows_of(200, width)
    rows += [(None, rows[0][1], 1, "x", 1), (None, rows[1][1], None, None, None), (5, rows[5][1], 1, "x", 1), (900, None, 1, "x", 1),
             (901, [1.0, None], 1, "x", 1), (902, [float("nan")] * width, 1, "x", 1), (903, [float("-inf")] * width, 1, "x", 1),
             (904, [], 1, "x", 1), (905, [0.5] * 3, None, "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert code_table(df).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert found(spark, rows, 4, entries, 3) == brute(rows, 4, entries, 3)


def test_several_limbs_and_large_components(spark):
    rows = rows_of(60, 8, scale=3e4)
    assert found(spark, rows, 4, 6, 2) == brute(rows, 4, 6, 2)
    # Squares beyond 64 bits are compared exactly; the error shown is the largest long.
    rows = rows_of(12, 4, scale=1e12)
    exact = brute(rows, 2, 3, 2)
    top = (1 << 63) - 1
    got = found(spark, rows, 2, 3, 2)
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [(r[0], r[1], min(r[2], top), r[4]) for r in exact]


def test_no_rows_and_equal_rows(spark):
    assert found(spark, [], 4, 256, 4) == []
    assert found(spark, [(1, None, 1, "x", 1)], 4, 256, 4) == []
    same = [(i, [0.5, 0.25, 0.0, -1.0], None, "x", 1) for i in range(9)]
    got = found(spark, same, 4, 4, 4)
    assert got == brute(same, 4, 4, 4) and {r[1:4] for r in got} == {("00000000", 0, 0)}
    coded, books = fit_codes(spark.createDataFrame(same, SCHEMA), entries=4)
    assert books.shape == (4, 4, 1) and coded.columns == ["vec_id", "label", "code", "error"]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 29), st.integers(0, 10_000))
def test_limb_products_are_exact(width, size, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-(1 << size) - 1, (1 << size) + 1, (7, width)) for _ in range(2))
    bits = limb_bits(width)
    assert width * (1 << 2 * bits) <= 1 << 53
    for low in (bits, 9):
        split = limbs(a, low)
        assert (sum(x.astype(np.int64) << (low * i) for i, x in enumerate(split)) == a).all()
        assert (exact_products(split, limbs(b, low), low) == a @ b.T).all()


def test_ties_go_to_the_lower_index():
    codes, away = Codebook(np.array([[4], [2], [2], [0]])).nearest(np.array([[3], [2], [1], [0]]))
    assert codes.tolist() == [0, 1, 1, 3] and away.tolist() == [1, 0, 1, 0]
