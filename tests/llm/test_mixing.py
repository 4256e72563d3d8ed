from collections import Counter, defaultdict

import numpy as np

from obslake.llm.mixing import flight, landing, mix_documents, mix_table, source_targets

SCHEMA = "doc_id long, text string, source string, size string, copies string"


def targets_by_hand(sizes, weights, total=1.5, most=2.0):
    """Excess over the most goes to the others by weight, again and again."""
    left, found = total * sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in found}
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in share if share[s] > most * sizes[s]]
        if not over:
            return {**found, **share}
        for s in over:
            found[s] = most * sizes[s]
            left -= found[s]


def rows_of():
    rng, rows = np.random.default_rng(3), []
    for source, n, mean in (("a", 900, 5), ("b", 5000, 40), ("c", 300, 60), ("d", 800, 30), (None, 400, 25)):
        for _ in range(n):
            rows.append((len(rows), " ".join(["w"] * int(rng.integers(1, 2 * mean))), source, "x", "y"))
    return rows


def test_targets(spark):
    sizes = {"a": 10, "b": 500, "c": 90, "d": 20, "e": 0, None: 70}
    rows = [("=" + s if s else "", s, n) for s, n in sizes.items()]
    found = source_targets(spark.createDataFrame(rows, "stratum string, source string, size long")).collect()
    expected = targets_by_hand(sizes, dict(zip(["a", "b", "c", "d", "e", None], [3, 1, 2, 3, 1, 2])))
    for r in found:
        assert abs(r.target - expected[r.stratum[1:] or None]) < 1e-6


def test_mix_is_balanced(spark):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mix_table(docs).collect()
    assert len(found) == len(rows)
    source = {r[0]: r[2] for r in rows}
    taken, most, target, counts, expected = defaultdict(int), defaultdict(int), {}, Counter(), Counter()
    for r in found:
        s = source[r.doc_id]
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[s] += r.taken
        most[s] = max(most[s], r["size"])
        target[s] = r.target
        counts[s] += r.taken // r["size"]
        expected[s] += r.target / r.source_size
    for s in target:
        assert abs(taken[s] - target[s]) <= 2 * most[s] and abs(counts[s] - expected[s]) <= 3
    again = mix_table(docs.repartition(5)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_mixed_rows_keep_their_columns(spark):
    docs = spark.createDataFrame(rows_of()[:1500], SCHEMA)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    taken = {r.doc_id: r.taken // r["size"] for r in mix_table(docs).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: n for k, n in taken.items() if n})


def test_nulls_and_empty(spark):
    rows = [(None, None, None, None, None), (1, "", "a", None, None), (1, "", "a", None, None), (2, "one two", "a", None, None)]
    found = mix_table(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id or 0), r["size"]) for r in found) == [(0, 0), (1, 0), (1, 0), (2, 2)]
    assert mix_table(spark.createDataFrame([], SCHEMA)).collect() == []


def test_chances_keep_their_mean():
    sizes = np.array([5.0, 3, 9, 2, 7, 7, 1, 4])
    chances = np.array([0.3, 0.5, 0.2, 0.7, 0.4, 0.4, 0.9, 0.1])
    rng, total = np.random.default_rng(1), np.zeros(8)
    for _ in range(4000):
        flown = flight(chances, sizes, rng.random(8))
        assert abs(flown @ sizes - chances @ sizes) < 1e-6 and abs(flown.sum() - chances.sum()) < 1e-6
        assert ((flown > 0) & (flown < 1)).sum() <= 2
        assert set(landing(flown, sizes)) <= {0.0, 1.0}
        total += flown
    assert np.abs(total / 4000 - chances).max() < 0.04
