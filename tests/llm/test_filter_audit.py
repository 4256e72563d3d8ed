from collections import Counter
from itertools import permutations

import pytest
from hypothesis import given, settings, strategies as st

from obslake.llm import filter_audit
from obslake.llm.filter_audit import TextTrie, audit_table, filter_masks, range_key

DOCS = "doc_id long, text string, lang string, mask int, Part string, n string"
LABELS = "doc_id long, quality int, toxic int, part string"


def brute_masks(rows):
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    found = Counter()
    for i, text, lang, *_ in rows:
        text = text or ""
        words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
        mask = (len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words))
        mask += 4 * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)) + 8 * any(c in "#$%&*|" for c in text)
        mask += 16 * (text in least if i is None else i > least[text])
        found[i, lang or "", mask] += 1
    return found


def masks_of(df):
    found = Counter()
    for row in df.collect():
        found[row.doc_id, row.part, row.mask] += row.n
    return found


def brute(rows, labels):
    good = {i for i, q, _, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, *_ in labels if t == 1 and i is not None}
    out = {}
    for (i, part, mask), n in brute_masks(rows).items():
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, name in enumerate(order, 1):
                r = out.setdefault((part, order, step), Counter())
                fails = bool(mask >> "ABCDE".index(name) & 1)
                r["unique_fails"] += n * (mask == 1 << "ABCDE".index(name))
                r["redundant"] += n * (fails and gone)
                if fails and not gone:
                    r["removed"] += n
                    r["good_lost"] += n * (i in good)
                    r["toxic_lost"] += n * (i in toxic)
                gone = gone or fails
                r["kept"] += n * (not gone)
    for (part, order, step), r in out.items():
        r["shapley"] = sum(o["removed"] for (p, x, s), o in out.items() if p == part and x[s - 1] == order[step - 1])
    return out


LONG = " ".join(f"word{i}" for i in range(250))
ROWS = [
    (1, LONG, "en", 1, "x", "y"), (2, LONG, "en", 1, "x", "y"), (2, LONG, "en", 1, "x", "y"), (None, LONG, "de", None, None, None),
    (3, None, "en", 1, "x", "y"), (4, "", None, 1, "x", "y"), (0, "", "", 1, "x", "y"), (5, "same " * 300, "de", 1, "x", "y"),
    (6, "A" + LONG.upper(), "en", 1, "x", "y"), (7, LONG + " 50%", "de", 1, "x", "y"), (8, "short | é", "en", 1, "x", "y"),
    (9, LONG + "x", "en", 1, "x", "y"), (None, "only here", "en", 1, "x", "y"), (None, "only here", "en", 1, "x", "y"),
    (-4, "short | é", "fr", 1, "x", "y"), (10, " a b\x0bc" * 90, "en", 1, "x", "y"), (11, "x" * 300_000, "en", 1, "x", "y"),
    (12, "x" * 300_000 + "y", "en", 1, "x", "y"), (13, "x" * 300_000, "en", 1, "x", "y"), (1, LONG, "en", 1, "x", "y"),
]
MARKS = [(2, 1, 0, "x"), (2, 0, 1, "x"), (3, 1, 1, "x"), (5, None, 1, "x"), (8, 1, None, "x"), (99, 1, 1, "x"), (None, 1, 1, "x")]


def test_audit_matches_brute_force(spark):
    df = spark.createDataFrame(ROWS, DOCS).repartition(5)
    expected = brute(ROWS, MARKS)
    got = audit_table(df, spark.createDataFrame(MARKS, LABELS)).collect()
    assert len(got) == len(expected) == 600 * 4
    for row in got:
        assert {k: v for k, v in row.asDict().items() if k not in ("part", "filter_order", "step")} == {
            k: expected[row.part, row.filter_order, row.step][k]
            for k in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
        }


@pytest.mark.parametrize("local,ranged,light", [(64 << 20, 32 << 20, 1 << 20), (300, 400, 1), (1, 20_000, 100)])
def test_masks_at_any_size_of_tries(spark, monkeypatch, local, ranged, light):
    monkeypatch.setattr(filter_audit, "LOCAL_BYTES", local)
    copies = [(100 + i % 70, LONG if i % 2 else LONG[: 9 + i % 40], "en", 1, "x", "y") for i in range(400)]
    rows = ROWS + copies
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    assert masks_of(filter_masks(df, ranged, light)) == brute_masks(rows)


def test_empty(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit_table(docs, labels).collect() == []
    one = audit_table(spark.createDataFrame(ROWS[:1], DOCS), labels).collect()
    assert len(one) == 600 and all(r.kept == 1 and r.good_lost == 0 for r in one)


def test_common_beginnings_get_longer_prefixes(spark):
    texts = [(("license " * 400 + str(i)).encode(),) for i in range(300)] + [((f"{i} other").encode(),) for i in range(300)]
    df = spark.createDataFrame(texts, "text binary")
    key, ranges = range_key(df, 1 << 20, 20_000)
    keys = {bytes(r[0]): r[1] for r in df.groupBy(key.alias("k")).count().collect()}
    assert max(keys.values()) == 1 and max(map(len, keys)) > 3000 and min(map(len, keys)) <= 8 and ranges >= 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=6)))
def test_trie_numbers_whole_texts(texts):
    trie = TextTrie()
    numbers = [trie.add(t) for t in texts]
    first = list(dict.fromkeys(texts))
    assert numbers == [first.index(t) for t in texts] and trie.size == len(first)
    assert list(trie.terminals()) == [first.index(t) for t in sorted(first)]
