"""The pipeline stage by stage against plain versions, and run() as a whole."""

from collections import Counter, defaultdict

import corpus_pipeline
from obslake.llm.toxicity import toxicity_table
from tests.llm import test_decontaminate, test_ngram_join


def brute_mix_holds(before, after):
    """Each source comes near its target and no row more than twice."""
    size = lambda t: len((t or "").encode().split())
    sources = sorted({r.source for r in before}, key=lambda s: (s is None, s))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    sizes, most, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r.source] += size(r.text)
        most[r.source] = max(most[r.source], size(r.text))
    for r in after:
        taken[r.source] += size(r.text)
    targets, free, left = {}, set(sources), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weights[s] for s in free)
        full = [s for s in free if level * weights[s] > 2 * sizes[s]]
        if not full:
            targets |= {s: level * weights[s] for s in free}
            break
        for s in full:
            targets[s] = 2 * sizes[s]
            left -= targets[s]
            free.remove(s)
    copies = Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 2 and set(copies) <= {r.doc_id for r in before}
    return all(abs(taken[s] - targets[s]) <= 2 * most[s] for s in sources)


def test_every_stage(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        rows = after.collect()
        if k < 4:
            assert after.columns == columns
        if k == 0:
            toxic = {r.doc_id for r in toxicity_table(docs, labels).where("predicted = 1").collect()}
            assert toxic and sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in before if r.doc_id not in toxic)
        elif k == 1:
            expected = test_ngram_join.brute([(r.doc_id, r.text) for r in before], 5, 80)
            assert sorted(r.doc_id for r in rows) == sorted(d for d, _, c, _ in expected if c == d)
        elif k == 2:
            kept = []
            for r in before:
                n, hit, _ = test_decontaminate.brute(r.text, items)
                if not (hit and 20 * hit >= n):
                    kept.append(r.doc_id)
            assert sorted(r.doc_id for r in rows) == sorted(kept) and len(rows) < len(before)
        elif k == 3:
            assert brute_mix_holds(before, rows)
        else:
            assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in before)
            counts = Counter(r.shard for r in rows)
            assert max(counts.values()) - min(counts.values()) <= 1
        docs = after
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, whole), key=repr) == sorted(map(tuple, rows), key=repr)
