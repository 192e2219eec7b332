"""Span algebra queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import spans as sp
from veilmark.operators import detect, spantable
from veilmark.operators.suppress import suppress
from veilmark.queries.base import CORE_MERGED, merged_spans, query, raw_spans, suppressed
from veilmark.sources.tables import texts

_BOTH = (
    f"{raw_spans(catalog.CORE, 'c_')}, {raw_spans(catalog.TRUTH, 't_')}, "
    "both_sides AS (SELECT 0 AS rank, * FROM c_raw UNION ALL SELECT 1 AS rank, * FROM t_raw)"
)


def _rows(df, spans="spans"):
    return detect.to_rows(df, ["doc_id"], spans, text=None)


def _raw_core(spark, sf):
    docs = texts(spark, sf).select("doc_id", "text")
    return docs.withColumn("spans", sp.find(F.col("text"), catalog.CORE))


@query(
    "spans_merged_as_rows",
    f"WITH {CORE_MERGED} SELECT doc_id, category, s AS span_start, e AS span_end FROM merged",
)
def spans_merged_as_rows(spark, sf):
    """Merge of a span table: running maxima instead of arrays."""
    return spantable.merge_rows(_rows(_raw_core(spark, sf)), ["doc_id"]).select(
        "doc_id", "category", "span_start", "span_end"
    )


_DEDUPED = (
    f"WITH {_BOTH} SELECT doc_id, s AS span_start, e AS span_end, category, rank AS source_rank FROM "
    "(SELECT *, row_number() OVER (PARTITION BY doc_id, s, e ORDER BY rank, priority) AS rn FROM both_sides) WHERE rn = 1"
)


@query("spans_deduplicated", _DEDUPED)
def spans_deduplicated(spark, sf):
    """Two detectors, one span per position, the first detector wins."""
    docs = texts(spark, sf).select("doc_id", "text")
    both = sp.dedupe(
        F.concat(sp.find(F.col("text"), catalog.CORE, source="0"), sp.find(F.col("text"), catalog.TRUTH, source="1"))
    )
    return _rows(docs.withColumn("spans", both)).select(
        "doc_id", "span_start", "span_end", "category", F.col("source").cast("int").alias("source_rank")
    )


@query("spans_deduplicated_rows", _DEDUPED)
def spans_deduplicated_rows(spark, sf):
    docs = texts(spark, sf).select("doc_id", "text")
    both = docs.withColumn(
        "spans",
        F.concat(sp.find(F.col("text"), catalog.CORE, source="0"), sp.find(F.col("text"), catalog.TRUTH, source="1")),
    )
    kept = spantable.dedupe_rows(_rows(both), ["doc_id"], ["source", "priority"])
    return kept.select(
        "doc_id", "span_start", "span_end", "category", F.col("source").cast("int").alias("source_rank")
    )


@query(
    "spans_ranked",
    f"WITH {CORE_MERGED} SELECT doc_id, category, s AS span_start, "
    "row_number() OVER (PARTITION BY doc_id ORDER BY s DESC) AS rank FROM merged",
)
def spans_ranked(spark, sf):
    """Spans of each document from last to first (the order of replacement)."""
    found = detect.detect_core(texts(spark, sf).select("doc_id", "text"))
    ordered = found.withColumn("spans", sp.in_order(F.col("spans"), descending=True))
    return _rows(ordered).select("doc_id", "category", "span_start", (F.col("span_no") + 1).alias("rank"))


@query(
    "spans_of_chosen_categories",
    f"WITH {CORE_MERGED} SELECT doc_id, category, s AS span_start, e AS span_end FROM merged "
    "WHERE category IN ('EMAIL', 'PHONE')",
)
def spans_of_chosen_categories(spark, sf):
    found = detect.detect_core(texts(spark, sf).select("doc_id", "text"), categories=["email", "Phone"])
    return _rows(found).select("doc_id", "category", "span_start", "span_end")


@query(
    "spans_suppressed",
    f"WITH {raw_spans(catalog.FALLBACK)}, {suppressed(len(catalog.FALLBACK))} "
    "SELECT doc_id, category, s AS span_start, e AS span_end FROM kept",
)
def spans_suppressed(spark, sf):
    """Greedy suppression of an existing span array (fallback catalog)."""
    found = detect.detect_fallback(texts(spark, sf).select("doc_id", "text"))
    return _rows(suppress(found)).select("doc_id", "category", "span_start", "span_end")


def _judge(own: str, other: str, alone: str, side: str) -> str:
    return (
        f"SELECT '{side}' AS side, a.doc_id, a.category, a.s AS span_start, a.e AS span_end, "
        f"CASE WHEN max(CASE WHEN a.s = b.s AND a.e = b.e THEN 1 ELSE 0 END) = 1 THEN 'exact' "
        f"WHEN count(b.s) > 0 THEN 'partial' ELSE '{alone}' END AS status "
        f"FROM {own} a LEFT JOIN {other} b ON a.doc_id = b.doc_id AND a.s < b.e AND b.s < a.e "
        "GROUP BY a.doc_id, a.category, a.s, a.e"
    )


@query(
    "detected_against_truth",
    f"WITH {raw_spans(catalog.CORE, 'c_')}, {merged_spans('c_')}, {raw_spans(catalog.TRUTH, 't_')}, "
    f"judged AS ({_judge('t_raw', 'c_merged', 'missed', 'truth')} UNION ALL "
    f"{_judge('c_merged', 't_raw', 'spurious', 'detected')}) "
    "SELECT side, category, status, count(*) AS n_spans FROM judged GROUP BY ALL",
)
def detected_against_truth(spark, sf):
    """Interval overlap join of detected and true spans."""
    docs = texts(spark, sf).select("doc_id", "text")
    judged = spantable.compare(
        _rows(detect.detect_core(docs)), _rows(detect.detect_truth(docs)), ["doc_id"]
    )
    return judged.groupBy("side", "category", "status").agg(F.count(F.lit(1)).alias("n_spans"))
