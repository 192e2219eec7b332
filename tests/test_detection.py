"""Spans against a plain regular-expression scan of the same texts."""

from __future__ import annotations

import json
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import spans as sp
from veilmark.operators import detect, spantable
from veilmark.operators.model import Model
from veilmark.operators.suppress import suppress

HERE = os.path.dirname(__file__)
TEXTS = [
    "",
    "plain text without anything",
    "Dr. Anna Maria Smith-Jones, 12 Oak Street, met Mr. Lee Wong near New York. CEO of Northwest County Council.",
    "mail: jane.doe+x@sub.example.co.uk, JANE@EXAMPLE.COM; caféjohn@x.com é.john@x.com a|b@c.d|e",
    "call +1-555-123-4567 or (555) 123-4567, 555.123.4567, 5551234567; ssn 123-45-6789 123456789",
    "cards 4111 1111 1111 1111, 4111-1111-1111-1111, 4111111111111111; ip 192.168.1.1 999.999.999.999",
    "dates 05/15/1980, 1980-05-15, 1-2-34; zip 12345-6789 12345; account 1234567890",
    "btc 1BoatSLRHtKNngkdXEeobR76b53LETtpyT eth 0x52908400098527886E0F7030069857D2E4169EE7 IBAN DE89370400440532013000 BIC DEUTDEFF500",
    "v6 2001:0db8:85a3:0000:0000:8a2e:0370:7334 mac 00:1B:44:11:3A:B7 a@handle user@name_1 password: s3cret!x pass=hunter22",
    "Male Female F M non-binary Urban downtown 52.520008, 13.404954 North NE",
    "Mozilla/5.0 (X11) AppleWebKit/537.36 (KHTML) Chrome/120.0.0.0 https://www.example.com/a?b=c iPhone 15 Pro",
    "Parish Of Saint Paul; texas TX ny; [FULLNAME_1] and [CITY_22] [lower_1]",
    "😀 mail a@b.co 😀 10.0.0.1 naïve Ünïcode Wörter ÄÖÜ 12٣4 x",
    "tab\tline\nnext\r\nlast sep nbsp John\nSmith",
    "x@y.zz",
    " marker a@b.co",
    "123-45-6789 123-45-6789 123-45-6789",
]
BLOCKS = {
    "core": catalog.CORE, "fallback": catalog.FALLBACK, "truth": catalog.TRUTH, "extended": catalog.extended(),
    "extended_case": catalog.extended(False), "words": (catalog.WORD, catalog.PUNCTUATION, catalog.TEMPLATE_MARKER),
}


def scan(p: catalog.Pattern, text: str):
    return [m.span() for m in re.finditer(p.regex, text, re.IGNORECASE if p.ignore_case else 0)]


def table(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("name", BLOCKS)
def test_offsets_equal_a_scan(spark, name):
    patterns = BLOCKS[name]
    got = table(spark).select("doc_id", sp.find(F.col("text"), patterns).alias("s")).collect()
    for row in got:
        want = [(p.name, *span) for p in patterns for span in scan(p, TEXTS[row["doc_id"]])]
        assert [(s["category"], s["start"], s["end"]) for s in row["s"]] == want, TEXTS[row["doc_id"]]


def test_every_extended_pattern_is_hit(spark):
    hit = {p.name for p in catalog.extended() for t in TEXTS if scan(p, t)}
    assert hit == {p.name for p in catalog.extended()}


def greedy(text: str, patterns, strict: bool):
    kept = []
    for p in patterns:
        for s, e in scan(p, text):
            if strict:
                clash = any(s < b and a < e for _, a, b in kept)
            else:
                clash = any(a <= s <= b or a <= e <= b for _, a, b in kept)
            if not clash:
                kept.append((p.name, s, e))
    return sorted(kept, key=lambda k: k[1])


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("ignore_case", [False, True])
def test_suppression(spark, strict, ignore_case):
    rows = detect.detect_extended(table(spark), ignore_case=ignore_case, strict=strict).collect()
    for row in rows:
        want = greedy(TEXTS[row["doc_id"]], catalog.extended(ignore_case), strict)
        assert [(s["category"], s["start"], s["end"]) for s in row["spans"]] == want


def test_suppression_of_a_span_array(spark):
    spans = [("A", 5, 9, 1.0, "t", 0), ("B", 9, 12, 1.0, "t", 1), ("C", 0, 20, 1.0, "t", 2), ("D", 13, 14, 1.0, "t", 3)]
    df = spark.createDataFrame([(1, spans[::-1])], f"doc_id long, spans {sp.SPANS_TYPE}")
    closed = [s["category"] for s in suppress(df).first()["spans"]]
    strict = [s["category"] for s in suppress(df, strict=True).first()["spans"]]
    assert closed == ["C", "A"]  # B touches A, C encloses A and passes, D lies in C
    assert strict == ["A", "B", "D"]


CASES = [
    [], [(0, 5)], [(0, 5), (5, 9)], [(0, 5), (6, 9)], [(0, 9), (2, 3), (9, 12), (14, 15)],
    [(3, 4), (0, 10), (10, 11), (12, 13), (13, 20), (30, 31)], [(i, i + 2) for i in range(0, 60, 3)],
]


def union(spans):
    out = []
    for s, e, cat, conf in sorted(spans, key=lambda x: x[0]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
            if conf > out[-1][3]:
                out[-1][2], out[-1][3] = cat, conf
        else:
            out.append([s, e, cat, conf])
    return [tuple(x) for x in out]


def test_merge_as_arrays_and_as_rows(spark):
    data = []
    for case in CASES:
        data.append([(f"C{i}", s, e, [0.5, 1.0, 0.7][i % 3], "t", i) for i, (s, e) in enumerate(case)])
    df = spark.createDataFrame(list(enumerate(data)), f"doc_id long, spans {sp.SPANS_TYPE}")
    want = {i: union([(s, e, c, f) for c, s, e, f, _, _ in d]) for i, d in enumerate(data)}
    arrays = df.select("doc_id", sp.merge(F.col("spans")).alias("m")).collect()
    assert {r["doc_id"]: [(s["start"], s["end"], s["category"], s["confidence"]) for s in r["m"]] for r in arrays} == want
    rows = spantable.merge_rows(detect.to_rows(df, ["doc_id"], text=None), ["doc_id"], slices=5).collect()
    got = {i: [] for i in want}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["span_start"])):
        got[r["doc_id"]].append((r["span_start"], r["span_end"], r["category"], r["confidence"]))
    assert got == want


def test_dedupe_keeps_the_first(spark):
    spans = [("A", 1, 2, 1.0, "m", 0), ("B", 1, 2, 1.0, "r", 0), ("C", 0, 2, 1.0, "r", 0), ("D", 1, 3, 1.0, "r", 1)]
    df = spark.createDataFrame([(1, spans)], f"doc_id long, spans {sp.SPANS_TYPE}")
    assert [s["category"] for s in df.select(sp.dedupe(F.col("spans")).alias("d")).first()["d"]] == ["C", "A", "D"]


def test_known_truth_documents(spark):
    with open(os.path.join(HERE, "data", "truth_documents.json"), encoding="utf-8") as f:
        docs = json.load(f)
    df = spark.createDataFrame([(d["id"], d["text"]) for d in docs], "doc_id string, text string")
    got = {r["doc_id"]: [[s["category"], s["start"], s["end"]] for s in r["spans"]] for r in detect.detect_truth(df).collect()}
    for d in docs:
        want = d["entities"]
        if d["id"] == "DOC_006":  # its list lacks one address that the pattern finds
            want = want + [["IP_ADDRESS", 352, 366]]
        assert got[d["id"]] == want


def test_nested_truth_pair_merges(spark):
    df = spark.createDataFrame([(1, "card 5355261132841095 end")], "doc_id long, text string")
    found = detect.detect_truth(df)
    raw = [(s["category"], s["start"], s["end"]) for s in found.first()["spans"]]
    assert raw == [("PHONE", 11, 21), ("CREDIT_CARD", 5, 21)]
    merged = found.select(sp.merge(F.col("spans")).alias("m")).first()["m"]
    assert [(s["category"], s["start"], s["end"]) for s in merged] == [("CREDIT_CARD", 5, 21)]


def test_span_text_matches_offsets(spark):
    rows = detect.to_rows(detect.detect_fallback(table(spark)), ["doc_id"]).collect()
    assert rows
    for r in rows:
        assert TEXTS[r["doc_id"]][r["span_start"] : r["span_end"]] == r["span_text"]


def test_words_and_chunks(spark):
    text = "  one two\nthree  four " + " ".join(f"w{i}" for i in range(130))
    df = spark.createDataFrame([(1, text), (2, ""), (3, "solo")], "doc_id long, text string")
    words = detect.words(df, ["doc_id"]).where("doc_id = 1").orderBy("pos").collect()
    assert [(w["word"], w["start"], w["end"]) for w in words] == [(m.group(), *m.span()) for m in re.finditer(r"\w+", text)]
    rows = detect.chunks(df, ["doc_id"]).orderBy("doc_id", "chunk_no").collect()
    tokens = text.split()
    want = [" ".join(tokens[i : i + 50]) for i in range(0, len(tokens), 10)]
    got = [r for r in rows if r["doc_id"] == 1]
    assert [r["chunk"] for r in got] == want
    for i, r in enumerate(got):
        context = (want[i - 1] if i else "") + (" " + want[i + 1] if i + 1 < len(want) else "")
        assert r["context"] == context
        assert text[r["start"] : r["end"]].split() == r["chunk"].split()
    assert [r["chunk"] for r in rows if r["doc_id"] == 3] == ["solo"]


MODEL = Model.by_rule([6, 8, 4, 2], 1.8)


def features_of(text: str) -> list[float]:
    words = text.split()
    return [
        min(len(text) / 50, 2.0), float("@" in text), float("@" in text and "." in text.split("@")[-1]),
        sum(c.isdigit() for c in text) / max(len(text), 1), float(any(w.istitle() for w in words)), len(words) / 20,
    ]


def test_chunk_facts_give_the_context_features(spark):
    from veilmark.functions import features as ft

    texts = [
        " ".join(["word"] * 30 + ["a@b", "x.", "Name"] + ["low"] * 40 + ["c@d.e"] + ["9", "8.7"] * 20),
        " ".join(["w"] * 12), "One", " ".join([f"p{i}@q" for i in range(70)] + ["."]),
    ]
    df = table(spark, texts)
    rows = detect.chunks(df, ["doc_id"]).select(
        "doc_id", "chunk_no", "chunk", "context",
        F.array(*ft.in_context(F.col("chunk"), F.col("context")).values()).alias("direct"),
    ).collect()
    facts = df.withColumn("c", detect._chunk_array("text", 50)).withColumn("f", F.transform("c", lambda c: ft.chunk_facts(c["chunk"])))
    combined = facts.select(
        "doc_id",
        F.transform("f", lambda f, i: ft.from_facts(F.when(i > 0, F.get("f", i - 1)), F.get("f", i + 1), f)).alias("x"),
    ).collect()
    by_doc = {r["doc_id"]: r["x"] for r in combined}
    for r in rows:
        full = f"{r['context']} {r['chunk']}" if r["context"] else r["chunk"]
        assert list(r["direct"]) == pytest.approx(features_of(full))
        assert list(by_doc[r["doc_id"]][r["chunk_no"]]) == pytest.approx(features_of(full))


def test_model_spans_hybrid_and_policy(spark):
    from veilmark.functions import kernels

    df = table(spark)
    probability = lambda f: kernels.softmax(kernels.forward(MODEL.layers, np.array([f]))[-1])[0, 1]
    got = detect.model_word_spans(df, MODEL, threshold=0.1).collect()
    first = {r["doc_id"]: r["spans"] for r in detect.model_word_spans(df, MODEL, threshold=0.1, position="first").collect()}
    for r in got:
        text, want, want_first = TEXTS[r["doc_id"]], [], []
        for m in re.finditer(r"\w+", text):
            w = m.group()
            p = probability([min(len(w) / 10, 2.0), 0, 0, sum(c.isdigit() for c in w) / len(w), float(w[0].isupper()), 0.1])
            if p > 0.1:
                want.append(m.span())
                want_first.append(re.search(r"\b" + re.escape(w) + r"\b", text).span())
        assert [(s["start"], s["end"]) for s in r["spans"]] == want
        assert [(s["start"], s["end"]) for s in first[r["doc_id"]]] == want_first
    hybrid = detect.detect_hybrid(df, MODEL).select("doc_id", "spans").collect()
    for r in hybrid:
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    policy = detect.detect_with_policy(df, Model.by_rule([6, 4, 3, 2])).collect()  # finds nothing
    plain = {r["doc_id"]: r["spans"] for r in detect.detect_fallback(df).collect()}
    assert all(r["spans"] == plain[r["doc_id"]] for r in policy)


def test_overlap_join(spark):
    schema = "doc_id long, category string, span_start int, span_end int"
    truth = spark.createDataFrame([(1, "A", 0, 5), (1, "B", 10, 15), (2, "A", 0, 5), (3, "A", 7, 9)], schema)
    found = spark.createDataFrame([(1, "A", 0, 5), (1, "X", 12, 20), (1, "Y", 30, 31), (3, "A", 9, 12)], schema)
    rows = {(r["side"], r["doc_id"], r["span_start"]): r["status"] for r in spantable.compare(found, truth, ["doc_id"]).collect()}
    assert rows == {
        ("truth", 1, 0): "exact", ("truth", 1, 10): "partial", ("truth", 2, 0): "missed", ("truth", 3, 7): "missed",
        ("detected", 1, 0): "exact", ("detected", 1, 12): "partial", ("detected", 1, 30): "spurious",
        ("detected", 3, 9): "spurious",
    }


@pytest.mark.parametrize("slices", [1, 5, 64])
def test_overlap_join_against_brute_force(spark, slices):
    rng = random.Random(slices)

    def side(n):
        rows = [(None if rng.random() < 0.1 else rng.randrange(3), rng.choice("AB"), rng.randrange(60)) for _ in range(n)]
        spans = [(d, c, s, s + rng.choice((0, 1, 3, 9, 40))) for d, c, s in rows]
        return spans + spans[:5] + [(9, "LONG", 0, 100000), (9, "A", 50000, 50001)]  # repeats, a long one

    found, truth = side(120), side(90) + [(9, "B", 99999, 100001)]
    schema = "doc_id long, category string, span_start int, span_end int"
    judged = spantable.compare(
        spark.createDataFrame(found, schema).withColumn("more", F.lit(1)), spark.createDataFrame(truth, schema), ["doc_id"], slices
    ).collect()

    def status(span, others, alone):
        d, _, s, e = span
        met = [(a, b) for k, _, a, b in others if k == d and s < b and a < e]
        return "exact" if (s, e) in met else "partial" if met else alone

    want = sorted(
        [("truth", *x, status(x, found, "missed")) for x in set(truth)]
        + [("detected", *x, status(x, truth, "spurious")) for x in set(found)], key=str,
    )
    got = [(r["side"], r["doc_id"], r["category"], r["span_start"], r["span_end"], r["status"]) for r in judged]
    assert sorted(got, key=str) == want
    none = spark.createDataFrame([], schema)
    assert spantable.compare(none, none, ["doc_id"]).collect() == []


def test_ranks_of_spans(spark):
    schema = "doc_id long, span_start int, span_end int, priority int"
    spans = spark.createDataFrame([(i % 2, i * 7 % 50, i * 7 % 50 + 2, i % 3) for i in range(50)], schema)
    for descending in (False, True):
        rows = spantable.rank_spans(spans, ["doc_id"], descending).collect()
        for doc in (0, 1):
            own = [r for r in rows if r["doc_id"] == doc]
            own.sort(key=lambda r: (-r["span_start"] if descending else r["span_start"], r["priority"], r["span_end"]))
            assert [r["rank"] for r in own] == list(range(1, 26))


def test_lookups(spark):
    df = spark.createDataFrame([("EMAIL", 0.9), ("IBAN", 0.6), ("NAME", 0.59), ("SHOE", 0.8)], "c string, p double")
    rows = df.select(sp.type_group(F.col("c")).alias("g"), sp.band(F.col("p")).alias("b"), sp.is_basic(F.col("c")).alias("k")).collect()
    assert [tuple(r) for r in rows] == [
        ("CONTACT", "HIGH", True), ("FINANCIAL", "MEDIUM", True), ("PERSONAL", "LOW", False), ("GENERAL", "HIGH", False)
    ]
    chunks = ["mail a@b.co", "x@y z.", "no 12 34 56 78", "only Name here", "the main road", "nothing"]
    got = table(spark, chunks).select(sp.chunk_category(F.col("text")).alias("k")).collect()
    assert [r["k"] for r in got] == ["EMAIL", "EMAIL", "PHONE", "NAME", "ADDRESS", "GENERIC_PII"]
