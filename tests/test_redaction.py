"""End-to-end redaction of known texts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import redaction as rd
from veilmark.functions import spans as sp
from veilmark.operators import detect
from veilmark.plans import redact as plan

RECORD = (
    "Patient Record:\nName: John Smith\nEmail: john.smith@hospital.com\nPhone: (555) 123-4567\nSSN: 123-45-6789\n"
    "Address: 123 Medical Center Dr, Boston, MA\nDate of Birth: 05/15/1980\nCredit Card: 4111-1111-1111-1111\n"
    "IP Address: 192.168.1.100\n"
)
REDACTED = (
    "Patient Record:\nName: John Smith\nEmail: [EMAIL]\nPhone: (555) 123-4567\nSSN: [SSN]\n"
    "Address: 123 Medical Center Dr, Boston, MA\nDate of Birth: [DATE]\nCredit Card: [CREDIT_CARD]\n"
    "IP Address: [IP_ADDRESS]\n"
)
MEMO = (
    "Hello, my name is Ann Brown and my email is ann.brown@example.com.\n"
    "    You can call me at 555-123-4567. My SSN is 123-45-6789 and my card is 4111-1111-1111-1111.\n"
    "    I was born on 01/15/1985 and my IP address is 10.20.30.40."
)


def test_known_record(spark):
    got = plan.redact_text(spark, RECORD, style="category_specific")
    assert got["original_text"] == RECORD
    assert got["redacted_text"] == REDACTED
    assert [(e["category"], e["start"], e["end"], e["confidence"]) for e in got["detected_entities"]] == [
        ("IP_ADDRESS", 217, 230, 1.0), ("CREDIT_CARD", 185, 204, 1.0), ("DATE", 161, 171, 1.0),
        ("SSN", 91, 102, 1.0), ("EMAIL", 40, 63, 1.0),
    ]
    for e in got["detected_entities"]:
        assert RECORD[e["start"] : e["end"]] == e["text"]
    assert got["statistics"] == {
        "total_characters": 231, "redacted_characters": 76, "entity_count": 5,
        "categories_detected": ["CREDIT_CARD", "DATE", "EMAIL", "IP_ADDRESS", "SSN"],
    }
    assert got["pipeline_info"]["redaction_style"] == "category_specific"


@pytest.mark.parametrize(
    "style, expected",
    [
        ("mask", "email is [REDACTED]."), ("hash", "email is ####."), ("partial", "email is a***@example.com."),
        ("category_specific", "email is [EMAIL]."), ("no such style", "email is [REDACTED]."),
        ("blocks", "email is " + "█" * 21 + "."),
    ],
)
def test_styles(spark, style, expected):
    assert expected in plan.redact_text(spark, MEMO, style=style)["redacted_text"]


def test_partial_rules(spark):
    text = "ab@example.com 555-123-4567 10.20.30.40 01/02/34 abc@x.org 1.2.3.4"
    got = plan.redact_text(spark, text, style="partial")["redacted_text"]
    assert got == "a***m ***-***-4567 1***0 0***4 a***@x.org 1***4"


def test_category_filter(spark):
    got = plan.redact_text(spark, MEMO, style="category_specific", categories=["email", "PHONE"])
    assert {e["category"] for e in got["detected_entities"]} == {"EMAIL", "PHONE"}
    assert "[EMAIL]" in got["redacted_text"] and "[PHONE]" in got["redacted_text"]
    assert "123-45-6789" in got["redacted_text"]
    with pytest.raises(ValueError):
        plan.redact_text(spark, MEMO, categories=["EMAIL", "SHOE_SIZE"])


def test_no_spans_is_identity_and_null_safe(spark):
    df = spark.createDataFrame([(1, "nothing here"), (2, ""), (3, None)], "doc_id long, text string")
    rows = detect.detect_core(df).select("doc_id", rd.redact("text", "spans", "mask").alias("r"), "text").collect()
    assert all(r["r"] == r["text"] for r in rows)


def test_long_text_is_cut_in_blocks(spark):
    text = ("é" * 3000 + " a.b@example.com " + "x" * 5000 + " 10.20.30.40 ") * 3
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = detect.detect_core(df)
    got = found.select(rd.redact("text", "spans", "category_specific").alias("r")).first()["r"]
    assert got == text.replace("a.b@example.com", "[EMAIL]").replace("10.20.30.40", "[IP_ADDRESS]")
    masked = found.select(rd.redact("text", "spans", "blocks").alias("r")).first()["r"]
    assert len(masked) == len(text)


def test_splice_where_a_span_crosses_blocks(spark):
    text = "".join(chr(97 + i % 26) for i in range(9000))
    cuts = [(0, 1), (2040, 2060), (2060, 2061), (4095, 6200), (8999, 9000)]
    df = spark.createDataFrame([(text, [("X", s, e, 1.0, "t", 0) for s, e in cuts])], f"text string, spans {sp.SPANS_TYPE}")
    got = df.select(sp.splice(F.col("text"), F.col("spans"), lambda s, t: F.concat(F.lit("<"), t, F.lit(">"))).alias("r")).first()["r"]
    want = text
    for s, e in reversed(cuts):
        want = want[:s] + "<" + text[s:e] + ">" + want[e:]
    assert got == want


def test_privacy_level_draw(spark):
    probability = spark.range(1).select(
        *[rd.redaction_probability(F.lit(e)).alias(f"p{i}") for i, e in enumerate(catalog.EPSILONS)]
    ).first()
    assert list(probability) == pytest.approx([0.95, 0.95, 0.5, 1 / 3, 0.2, 0.125])
    spans = [("X", i, i + 1, 0.5, "t", 0) for i in range(4000)]
    df = spark.createDataFrame([(1, spans)], f"doc_id long, spans {sp.SPANS_TYPE}")
    draw = lambda **k: rd.drawn(F.col("spans"), F.col("doc_id"), F.lit(2.0), **k)
    row = df.select(
        F.size(draw()).alias("plain"), F.size(draw(by_confidence=True)).alias("weighted"), (draw() == draw()).alias("same"),
    ).first()
    assert abs(row["plain"] - 2000) < 150 and abs(row["weighted"] - 1000) < 150 and row["same"]


def test_headers(spark):
    df = detect.detect_fallback(spark.createDataFrame([("a", "mail a.b@example.com")], "doc_id string, text string"))
    df = df.withColumn("spans", F.filter("spans", lambda s: s["category"] == "EMAIL"))
    args = (F.col("text"), F.col("spans"), F.lit("a.txt"), F.lit(8.0), F.lit("2024-01-01 00:00:00"))
    full, basic = df.select(plan.export_text(*args, F.lit("Model")).alias("a"), plan.basic_header(*args).alias("b")).first()
    assert "Detection Mode: Model" in full and "Average Confidence: 70.0%" in full and full.endswith("mail a.b@example.com")
    assert "Basic PII Count: 1" in basic and "Other PII Count: 0" in basic and "Total PII: 1" in basic


def test_output_formats(spark):
    done = plan.redact_documents(spark.createDataFrame([("a", MEMO)], "doc_id string, text string"))
    assert plan.formatted(done, "text").first()["output"] == done.first()["result"]["redacted_text"]
    assert '"entity_count":6' in plan.formatted(done, "json").first()["output"]
    with pytest.raises(ValueError):
        plan.formatted(done, "xml")
