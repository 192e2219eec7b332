from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.helpers import HAS_DATA, SF, documents
from tests.llm.test_jaccard import brute_force
from veilmark.llm import queries
from veilmark.sources.shared import cut
from veilmark.sources.tables import read


@pytest.mark.skipif(not HAS_DATA, reason="no test tables")
def test_stages(spark):
    docs, texts = read(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        after = cut(stage(spark, docs, SF), name)
        if name == "packing":
            assert {r["doc_id"] for r in after.collect()} == set(before)
            break
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        texts = {r["doc_id"]: r["text"] for r in after.select("doc_id", "text").collect()}
        assert after.count() == len(texts) and all(before[i] == t for i, t in texts.items())
        if name == "near_duplicates":
            assert set(texts) == {c for _, _, c in brute_force(before.items(), 5, 80, 100)}
        if name == "decontamination":
            items = {r["item_id"]: r["text"] for r in read(spark, SF, "benchmark").collect()}
            holding = {i for i, t in before.items() if any(x in t for x in items.values())}
            assert holding.isdisjoint(texts) and len(texts) >= len(before) - len(holding) - 2
        docs = after
    whole = corpus_pipeline.run(spark, SF)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(map(tuple, whole.select(*columns).collect())) == Counter(map(tuple, after.select(*columns).collect()))


@pytest.mark.skipif(not HAS_DATA, reason="no test tables")
def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "...,;"), (4, "the and of " * 20_000), (5, "a word is here now"), (5, "a word is here now"), (None, "no id for the text"), (6, "the text of that one")]
    for name, stage in corpus_pipeline.STAGES:
        docs = documents(spark, rows)
        out = stage(spark, docs, SF)
        assert name == "packing" or out.columns == docs.columns
        got = Counter(str(r["doc_id"]) for r in out.select("doc_id").collect())
        if name == "language":
            assert set(got) == {"4", "5", "6", "None"}
        elif name == "near_duplicates":
            assert got == Counter({"1": 1, "2": 1, "3": 1, "4": 1, "5": 1, "6": 1, "None": 1})
        elif name != "packing":
            assert got == Counter(str(i) for i, _ in rows)
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_registered():
    for n in range(1, 11):
        assert len([q for q in queries.QUERIES if q.startswith(f"op{n}_")]) == 1
    assert len(corpus_pipeline.STAGES) == 5
