import random

import numpy as np

from obslake.llm.quality import BAD, GOOD, LABELLERS, fit_label_model, fit_quality, quality_table, read, votes_of

SCHEMA = "doc_id long, text string, score string, Posterior string"


def corpus(n=400):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    rows, good = [], {}
    for i in range(n):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(40, 150))]
        text[::9] = [w + "." for w in text[::9]]
        good[i] = i % 5 != 0
        if not good[i]:
            kind = i // 5 % 3
            if kind == 0:
                text = [w.upper() + "!!" for w in text]
            elif kind == 1:
                text = [w + rng.choice(["%%%", "&&&", "***"]) for w in text]
            else:
                text = [text[0]] * 80
        rows.append((i, " ".join(text), "x", "y"))
    return rows, good


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.7
    accuracies = [0.9, 0.8, 0.7, 0.95, 0.6, 0.85, 0.75, 0.65]
    votes = np.stack([np.where(rng.random(20_000) < a, truth, ~truth) for a in accuracies], axis=1) * GOOD
    codes, n = np.unique(votes @ 3 ** np.arange(LABELLERS), return_counts=True)
    model = fit_label_model(dict(zip(codes.tolist(), n.tolist())), trust=0)
    assert abs(model.good - 0.7) < 0.03
    for k, a in enumerate(accuracies):
        assert abs(model.chances[k, 1, GOOD] - a) < 0.05 and abs(model.chances[k, 0, BAD] - a) < 0.05


def test_votes():
    texts = [b"", b"a b", ("WORD!! " * 50).encode(), ("fine words here are all. " * 3).encode()]
    votes = votes_of(read(texts))
    assert votes.shape == (4, LABELLERS) and votes[2, 1] == BAD and votes[1, 5] == BAD and votes[3, 0] == GOOD


def test_scorer_finds_bad_texts(spark):
    rows, good = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = quality_table(docs).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert sum((r.predicted == 1) == good[r.doc_id] for r in found) / len(found) > 0.95


def test_nulls_and_empty_tables(spark):
    rows, _ = corpus(50)
    odd = [(None, None, None, None), (7, "", "x", "y"), (7, "", "x", "y"), (8, "long. " * 100_000, "x", "y")]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    model = fit_quality(docs)
    found = quality_table(docs, model).collect()
    assert len(found) == 54 and not any(np.isnan(r.score) for r in found)
    assert quality_table(docs.limit(0)).collect() == []
    again = fit_quality(docs.repartition(5))
    assert np.allclose(model.weights, again.weights)
