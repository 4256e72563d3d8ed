import math

import numpy as np
import pytest

from obslake.llm import neighbour_graph
from obslake.llm.neighbour_graph import RangeSearch, _joined, near_duplicates, robust_pruned

SCHEMA = "vec_id long, embedding array<float>, node string, Links int"


def brute(rows, cosine=0.9):
    good = [(i, k) for k, (i, v, *_) in enumerate(rows)
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(rows[k][1]) for _, k in good), default=0)
    x = np.array([list(np.float32(rows[k][1])) + [0.0] * (width - len(rows[k][1])) for _, k in good], dtype=float).reshape(len(good), width)
    x /= np.linalg.norm(x, axis=1)[:, None] if len(x) else 1
    linked = x @ x.T >= cosine
    out = [[i, 0, i, True] for i, *_ in rows]
    for a, (i, k) in enumerate(good):
        group, waiting = {a}, [a]
        while waiting:
            new = set(np.flatnonzero(linked[waiting.pop()])) - group
            group |= new
            waiting += new
        least = min(good[b][0] for b in group)
        out[k] = [i, int(linked[a].sum()) - 1, least, i == least]
    return sorted(map(tuple, out), key=repr)


def found(spark, rows, *settings):
    df = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), *settings)
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=repr)


def rows_of(n=600, width=24, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, width))
    x[100:160] = x[100] + rng.normal(0, 0.15, (60, width))
    x[200:230] = 3 * x[200]
    for k in range(300, 340):
        x[k] = x[k - 1] + rng.normal(0, 0.3, width)
    order = rng.permutation(n)
    return [(int(order[i]), [float(c) for c in v], "x", 1) for i, v in enumerate(x)]


@pytest.mark.parametrize("settings", [(0.9,), (0.9, 150, 3, 16), (0.8, 150, 4, 32)])
def test_matches_brute_force(spark, settings):
    rows = rows_of()
    rows += [(None, rows[0][1], "x", 1), (700, None, "x", 1), (701, [1.0, None], "x", 1), (702, [float("nan")] * 24, "x", 1),
             (703, [float("inf")] * 24, "x", 1), (704, [], "x", 1), (705, [0.0] * 24, "x", 1), (706, [1.0] * 5, "x", 1),
             (707, [2.0] * 5 + [0.0], None, None), (5, rows[5][1], "x", 1), (708, [1e-38] * 24, "x", 1), (709, [3e38] * 24, "x", 1)]
    expected, got = brute(rows, settings[0]), found(spark, rows, *settings)
    assert [r[0] for r in got] == [r[0] for r in expected]
    links = sum(r[1] for r in expected)
    assert links > 3000 and sum(r[1] for r in got) >= 0.97 * links
    true = {r[0]: r[1] for r in expected}
    assert all(r[1] <= true[r[0]] for r in got if r[0] != 5)
    if len(settings) == 1:
        assert got == expected


def test_wider_search_after_a_failed_audit(spark, monkeypatch):
    rows = rows_of()
    monkeypatch.setattr(neighbour_graph, "LEAST_RECALL", 1.0)
    assert found(spark, rows, 0.9, 20, 1, 2) == brute(rows)


def test_copies_and_empty(spark):
    same = [(i, [0.5, 0.25], "x", 1) for i in range(40)] + [(3, [0.5, 0.25], "x", 1)]
    assert found(spark, same) == brute(same) and {r[1] for r in found(spark, same)} == {40}
    assert found(spark, []) == []
    one = [(7, [1.0], "x", 1)]
    assert found(spark, one) == [(7, 0, 7, True)]
    assert found(spark, [(7, None, "x", 1), (8, [0.0], "x", 1)]) == [(7, 0, 7, True), (8, 0, 8, True)]


def test_pruning_keeps_the_nearest_and_spreads():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (200, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = robust_pruned(x, 50, 10)
    cosine = x @ x.T - 3 * np.eye(200)
    assert all(len(n) <= 10 and n[0] == cosine[i].argmax() and i not in n for i, n in enumerate(near))
    assert [len(n) for n in robust_pruned(x[:1])] == [0]


def test_search_finds_what_is_in_range():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (300, 8))
    x[50:90] = x[50] + rng.normal(0, 0.1, (40, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = robust_pruned(x)
    heads = np.repeat(np.arange(300), [len(n) for n in near])
    tails = np.concatenate(near)
    graph = RangeSearch(x, np.concatenate([heads, tails]), np.concatenate([tails, heads]))
    q, nodes = graph.within(np.arange(300), 0.9, 24)
    true = np.argwhere((x @ x.T >= 0.9) & ~np.eye(300, dtype=bool))
    assert set(zip(q.tolist(), nodes.tolist())) <= set(map(tuple, true.tolist())) and len(q) >= 0.95 * len(true)


def test_joined_takes_the_least():
    parent = _joined(np.arange(7), np.array([6, 5, 2]), np.array([5, 1, 3]))
    assert parent.tolist() == [0, 1, 2, 2, 4, 1, 1]
