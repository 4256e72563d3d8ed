import re

import numpy as np

from obslake.llm.decontaminate import FMIndex, contamination, contamination_table, remove_contaminated, suffix_array

DOCS = "doc_id long, text string, source string, N_words long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = "alpha beta gamma delta one two three four five six seven eight nine ten eleven"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(text, items):
    own, hit, ids = WORD.findall(lower(text or "")), set(), set()
    for item_id, item in items:
        w = WORD.findall(lower(item or ""))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for p in range(len(own) - n + 1):
                if own[p : p + n] == w[k : k + n]:
                    hit.update(range(p, p + n))
                    ids.add(item_id)
    return len(own), len(hit), sorted(ids - {None})


def test_suffix_order():
    rng = np.random.default_rng(5)
    for n in range(1, 40):
        s = rng.integers(0, 3, n)
        s[-1] = 0
        ends = np.cumsum(s == 0)
        key = lambda i: [(int(v), int(k) if v == 0 else 0) for v, k in zip(s[i:], ends[i:])]  # noqa: E731, B023
        assert list(suffix_array(s)) == sorted(range(n), key=key)


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(6)
    s = rng.integers(0, 5, 4000)
    s[-1] = 0
    index = FMIndex(s, 4)
    codes = rng.integers(1, 5, (50, 4))
    lengths = rng.integers(1, 5, 50)
    low, high = index.search(codes, lengths)
    for c, n, a, b in zip(codes, lengths, low, high):
        found = sorted(index.locate(np.arange(a, b)))
        assert found == [i for i in range(4000 - n + 1) if (s[i : i + n] == c[:n]).all()]


def cases():
    items = [(7, PASSAGE), (12, PASSAGE + " twelve"), (3, "Short item!"), (None, "only hits here"), (9, ""), (10, None), (7, PASSAGE)]
    noise = "noise words " * 200
    docs = [
        (1, f"start {PASSAGE.upper()} end", "a", 5),
        (2, f"{noise}{PASSAGE}; {noise}", "a", 5),
        (3, "ünder short-ITEM and SHORT item", None, 5),
        (4, "", "a", 5), (5, None, None, None), (None, "only hits here", "b", 5),
        (2, f"{noise}{PASSAGE}; {noise}", "a", 5), (8, " ".join(PASSAGE.split()[:12]), "a", 5),
        (9, "short. item é " * 3000, "a", 5),
    ]
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    frame = spark.createDataFrame(docs, DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for blocks in (400_000, 40):
        found = contamination(frame, benchmark, max_windows=blocks).collect()
        assert len(found) == len(docs)
        for r in found:
            n, hit, ids = brute(r.text, items)
            assert (r.n_words, r.n_hit, r.item_ids) == (n, hit, ids)
            assert r.contaminated == (hit > 0 and 20 * hit >= n)
            assert sum(len(WORD.findall(lower(r.text[s.start : s.end]))) for s in r.spans) == hit
    odd = frame.withColumnRenamed("source", "hit_words")
    kept = remove_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and {(r.doc_id, r.N_words) for r in kept.collect()} == {(2, 5), (4, 5), (5, None), (8, 5)}


def test_empty_tables(spark):
    docs, items = cases()
    frame, benchmark = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert contamination_table(frame.limit(0), benchmark).collect() == []
    assert {r.n_hit for r in contamination_table(frame, benchmark.limit(0)).collect()} == {0}
