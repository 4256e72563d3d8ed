import hashlib
import random

import numpy as np
import pytest
from pyspark.accumulators import AccumulatorParam

from obslake.llm import suffix_dedup
from obslake.llm.suffix_dedup import parse, remove_repeats

SCHEMA = "doc_id long, text string, low string, Digest int"


def brute(rows, length):
    seen, found = set(), {}
    order = sorted({(i if i is not None else 1 << 70, t or "") for i, t, *_ in rows})
    for i, text in order:
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for p in range(len(data)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        found[i, text] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((-1 if i is None else i, *found[i if i is not None else 1 << 70, t or ""]) for i, t, *_ in rows))


def corpus(n, seed):
    rng = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "é", " ", " ", "\n"]
    word = lambda k: "".join(rng.choice(syllables) for _ in range(k))
    passages = [word(rng.choice([40, 60, 90, 200])) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.2:
            text = rng.choice(rows)[1]
        elif rows and kind < 0.4:
            text = list(rng.choice(rows)[1])
            for _ in range(rng.randint(1, 3)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice("xyz")
            text = "".join(text)
        elif kind < 0.45:
            text = rng.choice(["ab", "a", "abc é "]) * rng.randint(1, 200)
        else:
            text = "".join(rng.choice([word(30), rng.choice(passages), word(100)]) for _ in range(rng.randint(1, 4)))
        rows.append((i * 7 % n, text, "x", 1))
    return rows


@pytest.mark.parametrize("seed, length", [(1, 100), (2, 40)])
def test_matches_brute_force(spark, seed, length):
    rows = corpus(180, seed)
    found = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(6), length, with_text=False)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, found.collect())) == brute(rows, length)


def test_every_string_lies_in_one_phrase():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab ") for _ in range(n)) for n in (0, 30, 99, 100, 101, 500)] + [b"a" * 300]
    text, low, distance, count, *_ = parse(texts)
    for k, t in enumerate(texts):
        starts = [p for a, c in zip(low[text == k], count[text == k]) for p in range(a, a + c)]
        assert sorted(starts) == list(range(max(0, len(t) - 99)))
    assert (np.array(distance) >= 0).all() and (np.array(distance) + 24 <= 100).all()


def test_nulls_and_repeats(spark):
    long = "many words of one long text " * 5
    rows = [(None, long, "x", 1), (None, None, None, None), (3, "", "x", 1), (4, long, "x", 1), (4, long, "x", 1), (2, "z" * 40_000, "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = remove_repeats(docs)
    assert sorted(tuple(r)[:5] if r.doc_id is not None else (-1, *tuple(r)[1:5]) for r in found.collect()) == brute(rows, 100)
    assert {r.kept_text for r in found.where("doc_id is null and n_bytes > 0").collect()} == {""}
    assert remove_repeats(docs.limit(0)).collect() == []


def test_no_task_gets_all_strings_of_a_passage(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = word(150)
    rows = [(i, word(150) + passage + word(150), "x", 1) for i in range(300)] + [(7, None, "x", 1), (9, word(90), "x", 1)]
    rows += rows[:20]
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 2000, raising=False)
    whole = suffix_dedup._compare

    def noted(length):
        compare, seen = whole(length), total

        def run(frames):
            def watch():
                for frame in frames:
                    opened = frame[frame["bytes"].notna()]
                    key = opened["key" if "key" in opened else "trigger"]
                    strings = opened["bytes"].map(len) - length + 1
                    seen.add({int(k): int(n) for k, n in strings.groupby(key).sum().items()})
                    yield frame

            return compare(watch())

        return run

    total = spark.sparkContext.accumulator({}, _Sums())
    monkeypatch.setattr(suffix_dedup, "_compare", noted)
    found = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), 100, with_text=False)
    assert sorted(map(tuple, found.collect())) == brute(rows, 100)
    assert max(total.value.values(), default=0) <= 2000


class _Sums(AccumulatorParam):
    def zero(self, value):
        return {}

    def addInPlace(self, a, b):
        return {k: a.get(k, 0) + b.get(k, 0) for k in a.keys() | b.keys()}


@pytest.mark.parametrize("together", [0, 300])
def test_matches_brute_force_with_crowded_triggers(spark, monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    rows = corpus(150, 3)
    rows += [rows[5], (None, rows[8][1], "x", 1), (None, None, "x", 1)]
    found = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(6), 40, with_text=False)
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted(key(tuple(r)) for r in found.collect()) == brute(rows, 40)
