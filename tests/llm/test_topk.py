import math

import numpy as np
import pytest

from obslake.llm.topk import ImpactIndex, top_k

SCHEMA = "vec_id long, embedding array<float>, score string, Rank int"


def brute(rows, k, step=20):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for i, q in kept:
        if i % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in kept if j != i)
            found += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(found)


def rows_of(n, width, seed=2):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, width)], "x", 1) for i in range(n)]
    rows[50] = (50, rows[40][1], "x", 1)
    rows[51] = (51, rows[40][1], None, None)
    return rows


@pytest.mark.parametrize("blocks", [(8192, 512), (37, 4)])
def test_matches_brute_force(spark, blocks):
    rows = rows_of(300, 16)
    rows += [(None, rows[0][1], "x", 1), (400, None, "x", 1), (420, [1.0, None], "x", 1), (440, [float("nan")] * 16, "x", 1),
             (460, [float("inf")] * 16, "x", 1), (480, [], "x", 1), (500, [0.5] * 7, "x", 1), (501, [9.0] * 20, "x", 1)]
    found = top_k(spark.createDataFrame(rows, SCHEMA), None, 5, 64, *blocks)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 5)


def test_few_rows_and_repeats(spark):
    rows = [(0, [1.0, 2.0], "x", 1), (0, [1.0, 2.0], "x", 1), (1, [1.0, 1.0], "x", 1), (1, [1.0, 1.0], "x", 1)]
    found = sorted(map(tuple, top_k(spark.createDataFrame(rows, SCHEMA)).collect()))
    score = 64 * 64 + 128 * 64
    assert found == sorted(2 * [(0, 1, 1, score), (0, 2, 1, score)])
    assert top_k(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_values_stay_exact(spark):
    rows = [(i, [float(1 << 22), float(i), -float(1 << 20)], "x", 1) for i in range(41)]
    assert sorted(map(tuple, top_k(spark.createDataFrame(rows, SCHEMA), k=3).collect())) == brute(rows, 3)


def test_index_alone():
    rng = np.random.default_rng(4)
    cells = rng.integers(-40, 40, (500, 12))
    cells[:100] = cells[0]
    queries = cells[:8]
    found = ImpactIndex(cells, np.float32).search(np.arange(8), np.arange(500), queries, 20, np.float32)
    for q in range(8):
        scores = cells @ queries[q]
        expected = [i for i in np.lexsort((np.arange(500), -scores)) if i != q][:20]
        assert [m for a, m, _ in found if a == q] == expected
