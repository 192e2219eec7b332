"""Redaction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import redaction as rd
from veilmark.functions import spans as sp
from veilmark.functions.arrays import let
from veilmark.operators import detect, evaluate
from veilmark.plans import redact as plan
from veilmark.queries.base import CORE_MERGED, merged_spans, query, raw_spans, uniform_sql
from veilmark.sources.tables import texts


def _spliced(replacement: str, extra: str = "", where: str = "merged") -> str:
    """SQL that replaces the spans of ``where`` (doc_id, category, s, e)."""
    return (
        f"WITH {CORE_MERGED}{extra}, "
        f"x AS (SELECT m.doc_id, m.category, m.s, m.e, d.text, substring(d.text, m.s + 1, m.e - m.s) AS piece, "
        f"lag(m.e, 1, 0) OVER (PARTITION BY m.doc_id ORDER BY m.s) AS p, "
        f"row_number() OVER (PARTITION BY m.doc_id ORDER BY m.s DESC) AS back "
        f"FROM {where} m JOIN documents d USING (doc_id)), "
        f"y AS (SELECT doc_id, string_agg(substring(text, p + 1, s - p) || {replacement} || "
        f"CASE WHEN back = 1 THEN substring(text, e + 1) ELSE '' END, '' ORDER BY s) AS r FROM x GROUP BY doc_id) "
        "SELECT d.doc_id, coalesce(y.r, d.text) AS redacted_text FROM documents d LEFT JOIN y USING (doc_id)"
    )


_ENDS = "CASE WHEN length(piece) > 4 THEN left(piece, 1) || '***' || right(piece, 1) ELSE '***' END"
_PARTIAL = (
    "CASE WHEN category = 'EMAIL' AND strpos(piece, '@') > 3 THEN left(piece, 1) || '***@' || "
    "substring(piece, strpos(piece, '@') + 1) "
    "WHEN category = 'PHONE' AND length(regexp_replace(piece, '[^0-9]', '', 'g')) >= 4 THEN "
    f"'***-***-' || right(regexp_replace(piece, '[^0-9]', '', 'g'), 4) ELSE {_ENDS} END"
)


def _redacted(spark, sf, style):
    found = detect.detect_core(texts(spark, sf).select("doc_id", "text"))
    return found.select("doc_id", rd.redact("text", "spans", style).alias("redacted_text"))


@query("redact_mask", _spliced("'[REDACTED]'"))
def redact_mask(spark, sf):
    return _redacted(spark, sf, "mask")


@query("redact_unknown_style", _spliced("'[REDACTED]'"))
def redact_unknown_style(spark, sf):
    return _redacted(spark, sf, "no such style")


@query("redact_hash", _spliced("'####'"))
def redact_hash(spark, sf):
    return _redacted(spark, sf, "hash")


@query("redact_partial", _spliced(_PARTIAL))
def redact_partial(spark, sf):
    return _redacted(spark, sf, "partial")


@query("redact_category_labels", _spliced("'[' || category || ']'"))
def redact_category_labels(spark, sf):
    return _redacted(spark, sf, "category_specific")


@query("redact_blocks", _spliced("repeat('█', e - s)"))
def redact_blocks(spark, sf):
    return _redacted(spark, sf, "blocks")


_DRAWN = (
    f", drawn AS (SELECT * FROM merged WHERE {uniform_sql('42', 'doc_id', 's', 'e')} "
    "< least(0.95::DOUBLE, greatest(0.1::DOUBLE, 1.0::DOUBLE / 2.0)))"
)


@query("redact_by_privacy_level", _spliced("repeat('█', e - s)", _DRAWN, "drawn"))
def redact_by_privacy_level(spark, sf):
    """Each span with the probability of epsilon = 2."""
    found = detect.detect_core(texts(spark, sf).select("doc_id", "text"))
    chosen = rd.drawn(F.col("spans"), F.col("doc_id"), F.lit(2.0))
    return found.withColumn("spans", chosen).select(
        "doc_id", rd.redact("text", "spans", "blocks").alias("redacted_text")
    )


_LEVELS = "(VALUES " + ", ".join(
    f"({e}::DOUBLE, '{a}', '{b}', '{c}')" for e, a, b, c in catalog.PRIVACY_LEVELS
) + ") AS lv(epsilon, privacy_level, redaction_level, report_level)"


@query(
    "redaction_by_epsilon",
    f"WITH {CORE_MERGED}, "
    f"hit AS (SELECT epsilon, doc_id, s, e FROM merged, {_LEVELS} WHERE {uniform_sql('7', 'doc_id', 's', 'e')} "
    "< least(0.95::DOUBLE, greatest(0.1::DOUBLE, 1.0::DOUBLE / epsilon))), "
    "t AS (SELECT epsilon, count(*) AS n, sum(e - s) AS c FROM hit GROUP BY epsilon), "
    "a AS (SELECT sum(length(text)) AS chars FROM documents) "
    "SELECT lv.epsilon, privacy_level, redaction_level, report_level, "
    "CASE WHEN lv.epsilon <= 1 THEN 'STRONG' WHEN lv.epsilon <= 3 THEN 'MODERATE' ELSE 'LIGHT' END AS strength, "
    "round(least(0.95::DOUBLE, greatest(0.1::DOUBLE, 1.0::DOUBLE / lv.epsilon)), 6) AS probability, "
    "coalesce(n, 0) AS n_spans, round(coalesce(c, 0) * 100.0::DOUBLE / (SELECT chars FROM a), 6) AS redaction_percent "
    f"FROM {_LEVELS} LEFT JOIN t ON t.epsilon = lv.epsilon",
)
def redaction_by_epsilon(spark, sf):
    """Spans redacted and share of characters per privacy level, over all documents."""
    found = detect.detect_core(texts(spark, sf).select("doc_id", "text"))
    levels = F.explode(F.array(*[F.lit(e) for e in catalog.EPSILONS])).alias("epsilon")
    per_doc = found.select("doc_id", F.length("text").alias("n"), "spans", levels)
    chosen = rd.drawn(F.col("spans"), F.col("doc_id"), F.col("epsilon"), seed=7)
    sums = (
        per_doc.select("epsilon", "n", chosen.alias("c"))
        .groupBy("epsilon")
        .agg(
            F.sum(F.size("c")).alias("n_spans"),
            (
                F.sum(F.aggregate("c", F.lit(0), lambda a, s: a + s["end"] - s["start"])) * 100.0 / F.sum("n")
            ).alias("p"),
        )
    )
    return evaluate.privacy_levels(sums).select(
        "epsilon", "privacy_level", "redaction_level", "report_level",
        rd.strength_band(F.col("epsilon")).alias("strength"),
        F.round(rd.redaction_probability(F.col("epsilon")), 6).alias("probability"),
        "n_spans", F.round("p", 6).alias("redaction_percent"),
    )


_FALLBACK_DRAW = f"{uniform_sql('11', 'doc_id', 's', 'e')} < 0.5::DOUBLE * 0.7::DOUBLE"


@query(
    "spans_drawn_by_confidence",
    f"WITH {raw_spans(catalog.FALLBACK)} SELECT doc_id, count(*) AS n_spans, "
    f"count_if({_FALLBACK_DRAW}) AS n_drawn FROM raw GROUP BY doc_id",
)
def spans_drawn_by_confidence(spark, sf):
    """Draw with probability times confidence (epsilon = 2, confidence 0.7)."""
    found = detect.detect_fallback(texts(spark, sf).select("doc_id", "text"))

    def counted(spans):
        drawn = rd.drawn(spans, F.col("doc_id"), F.lit(2.0), seed=11, by_confidence=True)
        return F.struct(F.size(spans).cast("long").alias("n_spans"), F.size(drawn).cast("long").alias("n_drawn"))

    # One row a document, behind an explode: a plain filter would detect twice.
    rows = found.select("doc_id", F.explode_outer(F.array(let(F.col("spans"), counted))).alias("x"))
    return rows.where("x.n_spans > 0").select("doc_id", "x.*")


@query(
    "redaction_rate",
    f"WITH {CORE_MERGED}, c AS (SELECT doc_id, sum(e - s) AS c FROM merged GROUP BY doc_id) "
    "SELECT doc_id, round(CASE WHEN length(text) > 0 THEN coalesce(c, 0)::DOUBLE / length(text) * 100 ELSE 0 END, 6) "
    "AS percent FROM documents LEFT JOIN c USING (doc_id)",
)
def redaction_rate(spark, sf):
    found = detect.detect_core(texts(spark, sf).select("doc_id", "text"))
    covered = found.withColumn("r", rd.redact("text", "spans", "blocks"))
    return covered.select("doc_id", F.round(rd.redaction_rate(F.col("text"), F.col("r")), 6).alias("percent"))


@query(
    "document_statistics",
    f"WITH {CORE_MERGED}, t AS (SELECT doc_id, sum(e - s) AS c, count(*) AS n, "
    "list_sort(list_distinct(list(category))) AS k FROM merged GROUP BY doc_id) "
    "SELECT doc_id, length(text) AS total_characters, CAST(coalesce(c, 0) AS INTEGER) AS redacted_characters, "
    "CAST(coalesce(n, 0) AS INTEGER) AS entity_count, coalesce(array_to_string(k, ','), '') AS categories "
    "FROM documents LEFT JOIN t USING (doc_id)",
)
def document_statistics(spark, sf):
    found = detect.detect_core(texts(spark, sf).select("doc_id", "text"))
    stats = found.select("doc_id", rd.span_stats(F.col("text"), F.col("spans")).alias("s")).select("doc_id", "s.*")
    return stats.withColumn("categories", F.array_join("categories_detected", ",")).drop("categories_detected")


@query(
    "document_confidence",
    f"WITH {raw_spans(catalog.FALLBACK)}, t AS (SELECT doc_id, count(*) AS n FROM raw GROUP BY doc_id) "
    "SELECT doc_id, coalesce(n, 0) AS n_spans, CASE WHEN n > 0 THEN 0.7::DOUBLE ELSE 0.0::DOUBLE END AS mean_confidence, "
    "'MEDIUM' AS band, 'Regex Fallback' AS detection_mode FROM documents LEFT JOIN t USING (doc_id)",
)
def document_confidence(spark, sf):
    """Detection mode, mean confidence and band of the fallback catalog."""
    found = detect.detect_fallback(texts(spark, sf).select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("spans").cast("long").alias("n_spans"),
        F.round(rd.mean_confidence(F.col("spans")), 6).alias("mean_confidence"),
        sp.band(F.lit(catalog.FALLBACK_CONFIDENCE)).alias("band"),
        F.lit(plan.FALLBACK_MODE).alias("detection_mode"),
    )


def _record_sql() -> str:
    entity = "{'text': substring(text, s + 1, e - s), 'category': category, 'start': s, 'end': e, 'confidence': 1.0::DOUBLE}"
    spliced = _spliced("'[' || category || ']'").replace("SELECT d.doc_id, coalesce(y.r, d.text) AS redacted_text FROM documents d LEFT JOIN y USING (doc_id)", "")
    return (
        f"{spliced.rstrip()}, k AS (SELECT doc_id, list({entity} ORDER BY s DESC) AS l, sum(e - s) AS n, list_sort(list(DISTINCT category)) AS c "
        "FROM merged JOIN documents USING (doc_id) GROUP BY doc_id), "
        "z AS (SELECT d.doc_id, text, coalesce(y.r, text) AS r, coalesce(l, []) AS l, coalesce(n, 0) AS n, coalesce(c, []) AS c "
        "FROM documents d LEFT JOIN y USING (doc_id) LEFT JOIN k USING (doc_id)) "
        "SELECT doc_id, CAST(to_json({'original_text': text, 'redacted_text': r, 'detected_entities': l, 'statistics': {'total_characters': length(text), "
        "'redacted_characters': CAST(n AS BIGINT), 'entity_count': len(l), 'categories_detected': c}, "
        "'pipeline_info': {'redaction_style': 'category_specific'}}) AS VARCHAR) AS details, r AS redacted_text FROM z"
    )


@query("redaction_records", _record_sql())
def redaction_records(spark, sf):
    """Full result record per document as JSON."""
    done = plan.redact_documents(texts(spark, sf).select("doc_id", "text"), style="category_specific")
    return done.select("doc_id", F.to_json("result").alias("details"), F.col("result.redacted_text").alias("redacted_text"))


_HEADER = (
    "'=== Redacted Document - Model-Based Detection ===' || chr(10) || 'Detection Mode: Regex Fallback' || chr(10) || "
    "'Privacy Level: ε=8.0' || chr(10) || 'Original File: document-' || d.doc_id || chr(10) || 'Redaction Date: 2024-01-01 00:00:00' || chr(10) || "
    "'PII Detected: ' || coalesce(n, 0) || chr(10) || 'Average Confidence: ' || CASE WHEN n > 0 THEN '70.0%' ELSE '0.0%' END || chr(10) || "
    "'Color Coding: Bright=High, Medium=Medium, Pastel=Low confidence' || chr(10) || repeat('=', 50) || chr(10) || chr(10)"
)


@query(
    "export_with_header",
    f"WITH {raw_spans(catalog.FALLBACK)}, {merged_spans()}, "
    "x AS (SELECT m.doc_id, s, e, text, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS p, "
    "row_number() OVER (PARTITION BY doc_id ORDER BY s DESC) AS back FROM merged m JOIN documents USING (doc_id)), "
    "k AS (SELECT doc_id, count(*) AS n FROM raw GROUP BY doc_id), y AS (SELECT doc_id, string_agg(substring(text, p + 1, s - p) || repeat('█', e - s) || "
    "CASE WHEN back = 1 THEN substring(text, e + 1) ELSE '' END, '' ORDER BY s) AS r FROM x GROUP BY doc_id) "
    f"SELECT d.doc_id, {_HEADER} || coalesce(r, d.text) AS content FROM documents d LEFT JOIN y USING (doc_id) LEFT JOIN k USING (doc_id)",
)
def export_with_header(spark, sf):
    """Redacted text under a metadata header."""
    found = detect.detect_fallback(texts(spark, sf).select("doc_id", "text"))
    merged = found.withColumn("merged", sp.merge(F.col("spans")))
    return merged.select(
        "doc_id",
        plan.export_text(
            rd.redact("text", "merged", "blocks"), F.col("spans"),
            name=F.concat(F.lit("document-"), F.col("doc_id")), epsilon=F.lit(8.0),
            when=F.lit("2024-01-01 00:00:00"), mode=F.lit(plan.FALLBACK_MODE),
        ).alias("content"),
    )


@query(
    "batch_summary",
    f"WITH {CORE_MERGED} SELECT (SELECT count(*) FROM documents) AS total_files, "
    "(SELECT count(*) FROM documents) AS processed_files, 0::BIGINT AS failed_files, "
    "(SELECT count(*) FROM merged) AS entities",
)
def batch_summary(spark, sf):
    from veilmark.operators.profile import batch_summary as summary

    found = detect.detect_core(texts(spark, sf).select("doc_id", "text"))
    return summary(found, F.size("spans"), F.lit(None).cast("string"))
