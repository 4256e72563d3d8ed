import random

import pytest

from obslake.llm.components import components
from obslake.llm.ngram_join import jaccard_components, one_of_each

SCHEMA = "doc_id long, text string, n int, Component string"


def shingles(text, n):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(sets)
    for i in range(len(sets)):
        for j in range(i):
            (a, x), (b, y) = sets[i], sets[j]
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (a, _) in enumerate(sets):
        if a is not None:
            least[find(i)] = min(a, least.get(find(i), a))
    return sorted(((a, len(x), least.get(find(i)) if a is not None else None, links[i]) for i, (a, x) in enumerate(sets)), key=repr)


def corpus(n, seed, copies=0.5):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(50)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < copies:
            text = rng.choice(texts).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(vocabulary)
        else:
            text = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 9, 15, 30, 60, 150]))]
            if rng.random() < 0.4:
                text += passage
        texts.append(" ".join(text))
    ids = rng.sample(range(10 * n), n)
    return [(i, t if rng.random() < 0.9 else t.upper(), 1, "x") for i, t in zip(ids, texts)]


@pytest.mark.parametrize("seed, n, percent", [(1, 3, 90), (2, 5, 80), (3, 2, 60)])
def test_matches_brute_force(spark, seed, n, percent):
    rows = corpus(500, seed)
    found = jaccard_components(spark.createDataFrame(rows, SCHEMA), n, percent)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, n, percent)


def test_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for i in range(420):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            text[rng.randrange(60)] = f"e{rng.randrange(10_000)}"
        rows.append((i * 3, " ".join(text), 1, "x"))
    found = jaccard_components(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, 3, 90)


def test_nulls_and_repeats(spark):
    rows = [(5, None, None, None), (4, "", 1, "x"), (3, " \t", 1, "x"), (9, "One two", 1, "x"), (7, "one TWO", 1, "x"),
            (None, "one two", 1, "x"), (7, "one two", 1, "x"), (8, "é one", 1, "x"), (8, "other words here now", 1, "x"), (2, "long " * 50_000, 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = jaccard_components(docs).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows, 3, 90)
    assert sorted((r.doc_id or 0) for r in one_of_each(docs, 3, 90).collect()) == [2, 3, 4, 5, 7, 8, 8]
    assert one_of_each(docs).columns == docs.columns
    assert jaccard_components(docs.limit(0)).collect() == []


def test_one_row_of_each_group_and_every_clean_one(spark):
    text, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    rows = [(1, text, 1, "x"), (2, text, 1, "x"), (2, other, 1, "x"), (3, other + " more words", 1, "x"), (None, text, 1, "x"),
            (None, "alone " * 9, 1, "x"), (None, "alone " * 9, 1, "x"), (4, "single row", 1, "x"), (5, "same row", 1, "x"), (5, "same row", 1, "x")]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string, row int, rows string").repartition(3))
    assert kept.columns == ["doc_id", "text", "row", "rows"]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(
        [(1, text), (2, other), (0, "alone " * 9), (4, "single row"), (5, "same row")]
    )


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 500)] + [(1, 1), (None, 2)]
    parent = list(range(501))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((x, find(x)) for x in nodes)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
