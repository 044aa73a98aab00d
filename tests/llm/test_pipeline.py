"""Each stage by its own rule, on real and odd tables."""

import collections

import corpus_pipeline as p
from rowharbor.llm.common import materialise


def test_stages(spark, sf_dir, documents, texts):
    docs = documents
    seen = {}
    for name, stage in p.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"test-{name}")
        seen[name] = collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        if name != "shards":
            assert docs.columns == documents.columns
    assert set(seen["language"]) == {d for d, t in texts.items() if any(map(str.isalpha, t))}
    assert max(seen["near_copies"].values()) == 1 and set(seen["near_copies"]) <= set(seen["language"])
    first = {}
    for d in sorted(seen["language"]):
        first.setdefault(texts[d], d)
    assert set(seen["near_copies"]) <= set(first.values())  # exact copies leave their first
    assert set(seen["mixture"]) <= set(seen["benchmark_leaks"]) and max(seen["mixture"].values()) <= 3
    assert seen["shards"] == seen["mixture"]
    assert {"shard", "slot", "text", "lang"} <= set(docs.columns)


def test_odd_tables(spark, odd, empty, sf_dir):
    for docs in (odd, empty):
        for name, stage in p.STAGES:
            docs = materialise(stage(spark, docs, sf_dir), f"odd-{name}")
        assert docs.count() >= 0
    left = p.near_copies(spark, odd, sf_dir)
    assert sorted(r["doc_id"] for r in left.select("doc_id").collect() if r["doc_id"]) == [1, 2, 3, 6, 7, 8]
