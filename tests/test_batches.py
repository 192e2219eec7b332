"""Batch functions over words, chunks and spans against the plain way, and what they hold."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import features as ft
from veilmark.functions import kernels
from veilmark.functions import spans as sp
from veilmark.operators import detect, model as md
from veilmark.queries.detection import CHUNK_MODEL, WORD_MODEL, _RE2_ABLE

ODD = [
    None, "", " ", "a", "Zürich Élan ²³ x² 123456789012 ABCDEFGHIJKLM Ǆungla ǅungla _a1 naïve naïve",
    " Ada\x85Novak\x1cat　中文 字 ٣٤٥ 12 😀A😀 a@b.c Mr. x.y@", "İstanbul ſtraße KELVIN K 𝐀𝐛𝟏 é ö.ö",
    " ".join(f"word{i} Title x" for i in range(40)), " ".join("low case words 7 mail@host.org" for _ in range(30)),
    "one two three four five six seven eight nine ten eleven Twelve street 4111 1111 1111 1111 tail",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").repartition(2).cache()


def as_rows(df):
    return sorted((r["doc_id"], r["span_start"], r["span_end"], r["category"], round(r["confidence"], 9)) for r in df.collect())


@pytest.mark.parametrize("position", ["each", "first"])
def test_words_of_a_batch_equal_words_one_by_one(docs, position, monkeypatch):
    monkeypatch.setattr(kernels, "SLICE", 50)
    got = detect.to_rows(detect.model_word_spans(docs, WORD_MODEL, position=position), ["doc_id"], text=None)
    rows = detect.words(docs, ["doc_id", "text"]).withColumn("word", F.expr("substring(text, start + 1, end - start)"))
    f = ft.word(F.col("word"))
    kind = sp.word_type(f["length"], f["has_at"], f["has_dot"], f["digit_ratio"], f["first_upper"])
    wide = rows.select("*", F.array(*[c.cast("double") for c in f.values()]).alias("features"), kind.alias("kind"))
    found = md.score(wide, WORD_MODEL).collect()
    first = {}
    for r in sorted(found, key=lambda r: (r["doc_id"], r["start"])):
        first.setdefault((r["doc_id"], r["word"]), r["start"])
    want = []
    for r in found:
        at = r["start"] if position == "each" else first[r["doc_id"], r["word"]]
        if r["prob"] > 0.5:
            want.append((r["doc_id"], at, at + r["end"] - r["start"], r["kind"], round(r["prob"], 9)))
    assert as_rows(got) == sorted(want) and len(want) > 20


def test_chunks_of_a_batch_equal_chunks_one_by_one(docs, monkeypatch):
    monkeypatch.setattr(kernels, "SLICE", 50)
    rows = detect.chunks(docs, ["doc_id"])
    f = ft.in_context(F.col("chunk"), F.col("context"))
    wide = rows.select("*", F.array(*[c.cast("double") for c in f.values()]).alias("features"), sp.chunk_category(F.col("chunk")).alias("kind"))
    model = md.Model([(w, b + 0.1) for w, b in CHUNK_MODEL.layers])
    for use in (CHUNK_MODEL, model):
        found = docs.withColumn("hits", kernels.chunk_hits(use.layers, 50)(detect.tx.plain_with_cases(F.col("text"))))
        got = found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*").collect()
        want = [r for r in md.score(wide, use).collect() if r["prob"] > 0.5]
        assert sorted((r["doc_id"], r["first"], r["start"], r["end"], round(r["p"], 9)) for r in got) == sorted(
            (r["doc_id"], 10 * r["chunk_no"], r["start"], r["end"], round(r["prob"], 9)) for r in want
        )
        merged = detect.to_rows(detect.model_chunk_spans(docs, use), ["doc_id"], text=None).collect()
        kinds = {(r["doc_id"], round(r["prob"], 9)): r["kind"] for r in want}
        assert want and all(kinds[r["doc_id"], round(r["confidence"], 9)] == r["category"] for r in merged)


def test_slices_are_whole_rows(monkeypatch):
    monkeypatch.setattr(kernels, "SLICE", 10)
    assert kernels.slices(np.array([4, 6, 1, 50, 0, 3])) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert kernels.slices(np.zeros(0, int)) == []


def peak(body, *columns):
    tracemalloc.start()
    out = body(*columns)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, most


def test_suppression_holds_a_part_of_a_batch():
    """Memory follows the slice, and slices change no result."""
    texts, k = 3000, 401
    lens = pa.array([[[3, 4] * (k // 2) + [2]] * 3] * texts, pa.list_(pa.list_(pa.int32())))
    out, most = peak(kernels.first_come(False).func, lens)
    assert len(out) == texts and out[0] == out[texts - 1] and len(out[0]) == k // 2
    assert most < 8 * 16 * kernels.SLICE + 20 * texts * k  # results, and the arrays of a slice

    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    spans = pa.array([[{"start": 5 * i, "end": 5 * i + 3} for i in range(200)]] * texts, pa.list_(span))
    out, most = peak(kernels.first_come_spans(False).func, spans)
    assert len(out) == texts and len(out[texts - 1]) == 200
    assert most < 60 * 200 * texts


def test_a_missing_text_has_no_extended_spans(docs):
    rows = detect.detect_extended(docs).select("doc_id", F.size("spans").alias("n")).collect()
    found = {r["doc_id"]: r["n"] for r in rows}
    assert found[0] == found[1] == 0 and found[9] > 0 and len(found) == len(ODD)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_facts_of_a_text_are_gathered_once(docs):
    lens = docs.select(F.explode_outer(sp.lengths_of_all(F.concat("text", F.lit("x")), _RE2_ABLE)).alias("x"))
    assert plan(lens).count("translate(") == 1
    one = {p.name: docs.select(sp.lengths(F.concat("text", F.lit("x")), p).alias("n")).collect() for p in _RE2_ABLE[:5]}
    rows = docs.select("doc_id", F.explode(sp.lengths_of_all(F.concat("text", F.lit("x")), _RE2_ABLE[:5])).alias("x")).select("doc_id", "x.*")
    for name, want in one.items():
        got = [r["lens"] for r in rows.where(F.col("pattern") == name).collect()]
        assert sorted(map(str, got)) == sorted(str(r["n"]) for r in want)


def test_drawn_spans_are_found_once(spark, docs, tmp_path):
    from veilmark.queries import REGISTRY

    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    df = REGISTRY["spans_drawn_by_confidence"].run(spark, str(tmp_path))
    alone = detect.detect_fallback(docs).select("doc_id", "spans")
    name = catalog.FALLBACK[3].name
    assert plan(df).count(f"category, {name}") == plan(alone).count(f"category, {name}") > 0


def test_fallback_patterns_wait_for_the_model(docs):
    """The patterns stand behind the model's spans, in one expression with them."""
    found = detect.detect_with_policy(docs, WORD_MODEL)
    assert "word_spans" in plan(found) or "run(" in plan(found)
    assert plan(found).index("CASE WHEN (size(_model") < plan(found).index("CREDIT_CARD")
