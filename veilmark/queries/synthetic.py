"""Synthetic documents for every customer key, so work grows with the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark.operators import detect, spantable
from veilmark.queries.base import query, uniform_sql
from veilmark.sources import synth
from veilmark.sources.tables import read, spread


def made(spark, sf):
    return synth.documents(spread(read(spark, sf, "customer").select("c_custkey")), "c_custkey")


@query("synthetic_documents")
def synthetic_documents(spark, sf):
    return made(spark, sf).select("c_custkey", "doc_type", "text", F.size("planted").alias("n_planted"))


@query("synthetic_truth_spans")
def synthetic_truth_spans(spark, sf):
    return detect.to_rows(made(spark, sf), ["c_custkey"], "pii_entities").select(
        "c_custkey", "category", "span_start", "span_end", "span_text"
    )


@query("synthetic_summary")
def synthetic_summary(spark, sf):
    return synth.summary(made(spark, sf))


@query("synthetic_recovery")
def synthetic_recovery(spark, sf):
    """How many planted values the core patterns find, per category."""
    docs = made(spark, sf)
    found = detect.to_rows(detect.detect_core(docs), ["c_custkey"], text=None)
    planted = docs.select("c_custkey", F.explode_outer("planted").alias("p")).where("p IS NOT NULL").select(
        "c_custkey", F.col("p.category").alias("category"), F.col("p.start").alias("span_start"), F.col("p.end").alias("span_end")
    )
    judged = spantable.compare(found, planted, ["c_custkey"])
    return judged.groupBy("side", "category", "status").agg(F.count(F.lit(1)).alias("n_spans"))


_U, _V = uniform_sql("42", "c_custkey", "'u0'"), uniform_sql("42", "c_custkey", "'v0'")


@query(
    "synthetic_features",
    f"SELECT c_custkey, round(sqrt(-2 * ln(1 - {_U})) * cos(2 * pi() * {_V}), 6) AS x0, "
    f"CASE WHEN {uniform_sql('42', 'c_custkey', chr(39) + 'y' + chr(39))} < 0.18::DOUBLE THEN 1 ELSE 0 END AS label FROM customer",
)
def synthetic_features(spark, sf):
    rows = synth.feature_matrix(read(spark, sf, "customer").select("c_custkey"), "c_custkey")
    return rows.select("c_custkey", F.round(F.get("features", F.lit(0)), 6).alias("x0"), "label")
