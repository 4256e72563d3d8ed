import zlib
from collections import Counter

from obslake.llm.sharding import shard_documents, shard_table

SCHEMA = "doc_id long, text string, source string, shard string, Rank int"


def rows_of(n):
    sources = ["a"] * 5 + ["b"] * 2 + [None]
    return [(i, f"text {i}", sources[i % 8], "x", i) for i in range(n)]


def test_counts_differ_by_one_and_match_the_mixture(spark):
    docs = spark.createDataFrame(rows_of(9601), SCHEMA)
    found = shard_documents(docs, shards=12).collect()
    assert len(found) == 9601 and len({r.doc_id for r in found}) == 9601
    counts = Counter(r.shard for r in found)
    assert set(counts) == set(range(12)) and max(counts.values()) - min(counts.values()) <= 1
    for k, n in counts.items():
        assert sorted(r.slot for r in found if r.shard == k) == list(range(n))
    for (_, source), n in Counter((r.shard, r.source) for r in found).items():
        expected = {"a": 500, "b": 200, None: 100}[source]
        assert abs(n - expected) <= 2
    assert found[0].Rank is not None


def test_same_rows_again(spark):
    docs = spark.createDataFrame(rows_of(500), SCHEMA)
    once = sorted(map(tuple, shard_table(docs).collect()))
    assert once == sorted(map(tuple, shard_table(docs.repartition(7)).collect()))


def test_nulls_repeats_and_few_rows(spark):
    rows = [(None, None, None, "x", 1), (1, "", "a", "x", 1), (1, "", "a", "x", 1), (2, "é" * 9, None, None, None)]
    found = shard_table(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r["size"], r.text_crc32) for r in found) == [
        (0, 8, 0), (1, 8, 0), (1, 8, 0), (2, 26, zlib.crc32(("é" * 9).encode())),
    ]
    assert {r.slot for r in found} == {0} and len({r.shard for r in found}) == 4
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}


def test_empty_table(spark):
    assert shard_table(spark.createDataFrame([], SCHEMA)).collect() == []
