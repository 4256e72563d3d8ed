import random
import zlib

from obslake.llm.toxicity import Lexicon, fit_lexicon, folded, measured, remove_toxic, toxicity, toxicity_table

DOCS = "doc_id long, text string, lang string, Score string"
LABELS = "doc_id long, quality int, toxic int"
BAD = ["blargh", "snarfle", "gronkt"]


def corpus(n=600):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        toxic = int(i % 6 == 0)
        for _ in range(2 * toxic):
            text[rng.randrange(len(text))] = rng.choice(BAD) + rng.choice(["", "ed", "ing"])
        docs.append((i, " ".join(text), "en", "x"))
        labels.append((i, 1, toxic))
    return docs, labels


def test_folding():
    assert folded("1D1​ОТ, Мoron") == " idiot  moron"
    lexicon = Lexicon({"idiot": 3.0, "trash": 2.0}).automaton()
    weight = lambda t: measured(folded(t), lexicon)[0]
    assert weight("an 1d!0t") == 0 and weight("an ID10T!") > 0 and weight("idіots") > 0
    assert weight("the trash can") == 0 and weight("the trash, can trash") > 0 and weight("Xidiot") == 0 and weight("") == 0
    assert measured(folded("idiot " + "a " * 10), lexicon)[1] > measured(folded("idiot " + "a " * 1000), lexicon)[1]


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    found = toxicity_table(frame, marks).collect()
    truth = {i: t for i, _, t in labels}
    assert len(found) == len(docs) and {r.held_out for r in found} == {True, False}
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    kept = remove_toxic(frame, marks)
    assert kept.columns == frame.columns and 480 <= kept.count() <= 520


def test_held_out_labels_have_no_effect(spark):
    docs, labels = corpus(200)
    frame = spark.createDataFrame(docs, DOCS)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (fit_lexicon(frame, spark.createDataFrame(x, LABELS)) for x in (labels, turned))
    assert list(a.weights) == list(b.weights) and list(a.weights)


def test_nulls_and_empty_tables(spark):
    docs, labels = corpus(60)
    rows = [(None, "blargh", None, None), (900, None, None, None), (901, "", "en", "x"), (901, "", "en", "x"), (902, "blargh " * 40_000, "en", "x")]
    frame = spark.createDataFrame(docs + rows, DOCS)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (900, None, None), (902, 1, 7)], LABELS)
    lexicon = Lexicon({"blargh": 3.0}, scale=(-3.0, 2.0, 1.0))
    found = {(r.doc_id, r.text): r.score for r in toxicity(frame, lexicon).collect()}
    assert found[None, "blargh"] > 0.5 > found[900, None] == found[901, ""] and found[902, rows[-1][1]] > 0.5
    assert len(toxicity_table(frame, marks).collect()) == 65
    assert toxicity_table(frame.limit(0), marks).collect() == []
    assert {r.predicted for r in toxicity_table(frame, marks.limit(0)).collect()} == {0}


def test_rare_telling_terms_are_learned(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdeilmnorstu") for _ in range(n))
    insults = ["zq" + word(6) for _ in range(60)]
    docs, labels = [], []
    for i in range(4000):
        toxic = int(i % 5 == 0)
        docs.append((i, " ".join([word(8) for _ in range(12)] + [insults[i // 5 % 60]] * toxic), "en", "x"))
        labels.append((i, 1, toxic))
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    # Each insult is in one of sixty toxic texts and in no other; all other words are there once.
    found = fit_lexicon(frame, marks).weights
    assert sum(any(w.startswith(t) for t in found) for w in insults) >= 55
    # One term is expected by chance.
    assert sum(not any(w.startswith(t) for w in insults) for t in found) <= 3
    wordless = spark.createDataFrame([(i, "!?", "en", "x") for i in range(20)], DOCS)
    assert fit_lexicon(wordless, marks.where("doc_id < 20")).weights == {}


def test_only_copies_count_once(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdeilmnorstu") for _ in range(n))
    common, same = [word(5) for _ in range(40)], [word(8) for _ in range(60)]
    docs, labels = [], []
    for i in range(600):
        toxic = int(i % 5 == 0)
        text = rng.sample(common, 35) + [word(8) for _ in range(20)] + ["zqinsult"] * toxic
        if i % 10 == 5:
            text = [*same[: i % 7], word(8), *same[i % 7 :], "zqcopied"]
        docs.append((i, " ".join(text), "en", "x"))
        labels.append((i, 1, toxic))
    found = fit_lexicon(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).weights
    # Texts that share common words are all learned from; what only copies of one text hold is no evidence.
    assert any("zqinsult".startswith(t) for t in found)
    assert not any("zqcopied".startswith(t) for t in found)
