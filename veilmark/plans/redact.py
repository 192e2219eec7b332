"""Redaction jobs: a table of texts, or a folder of files, in one narrow pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilmark.functions import redaction as rd
from veilmark.functions import spans as sp
from veilmark.operators import detect
from veilmark.operators.model import Model
from veilmark.sources import files
from veilmark.sources.named import write_named

MODEL_MODE, FALLBACK_MODE = "Model", "Regex Fallback"


def redact_documents(
    df: DataFrame, text: str = "text", style: str = "mask", categories: list[str] | None = None,
    model: Model | None = None, accuracy: float | None = None,
) -> DataFrame:
    """Adds ``result``: texts, entities, statistics and run information.

    Detection covers all categories first and filters afterwards: a span merged
    from two categories belongs to the more confident one.
    """
    if model is None:
        found = detect.detect_core(df, text, "_spans")
    else:
        found = detect.detect_hybrid(df, model, text, "_spans")
    spans = F.col("_spans") if categories is None else sp.only(F.col("_spans"), categories)
    source = F.col(text)
    chosen = found.withColumn("_chosen", spans)
    entities = F.transform(
        F.reverse("_chosen"),
        lambda s: F.struct(
            sp.span_text(source, s).alias("text"), s["category"].alias("category"), s["start"].alias("start"),
            s["end"].alias("end"), s["confidence"].alias("confidence"),
        ),
    )
    info = F.struct(
        F.lit(model.epsilon if model else None).cast("double").alias("model_epsilon"),
        F.lit(accuracy).cast("double").alias("model_accuracy"),
        F.lit(style).alias("redaction_style"),
    )
    result = F.struct(
        source.alias("original_text"),
        rd.redact(text, "_chosen", style).alias("redacted_text"),
        entities.alias("detected_entities"),
        rd.span_stats(source, F.col("_chosen")).alias("statistics"),
        info.alias("pipeline_info"),
    )
    return chosen.withColumn("result", result).drop("_spans", "_chosen")


def formatted(done: DataFrame, output_format: str = "text") -> DataFrame:
    """``text``: the redacted text; ``json`` and ``both``: the record as JSON."""
    if output_format == "text":
        return done.withColumn("output", F.col("result.redacted_text"))
    if output_format in ("json", "both"):
        return done.withColumn("output", F.to_json("result"))
    raise ValueError(f"unknown output format {output_format!r}")


def redact_text(spark: SparkSession, text: str, **options) -> dict:
    """One literal text; returns the result record."""
    done = redact_documents(files.literal(spark, [("text", text)]), **options)
    return done.select("result").first()["result"].asDict(recursive=True)


# -- fixed values: header lines of exported texts -----------------------------------


def export_text(
    redacted: Column, spans: Column, name: Column, epsilon: Column, when: Column, mode: Column
) -> Column:
    """A metadata header (mode, level, file, date, counts, confidence) and the text;
    ``spans`` are the detected ones, before they are merged for redaction."""
    rule = F.lit("=" * 50)
    lines = F.concat_ws(
        "\n",
        F.lit("=== Redacted Document - Model-Based Detection ==="),
        F.concat(F.lit("Detection Mode: "), mode),
        F.concat(F.lit("Privacy Level: ε="), epsilon.cast("string")),
        F.concat(F.lit("Original File: "), F.coalesce(name, F.lit("Unknown"))),
        F.concat(F.lit("Redaction Date: "), when.cast("string")),
        F.concat(F.lit("PII Detected: "), F.size(spans).cast("string")),
        F.concat(F.lit("Average Confidence: "), F.format_string("%.1f%%", rd.mean_confidence(spans) * 100.0)),
        F.lit("Color Coding: Bright=High, Medium=Medium, Pastel=Low confidence"),
        rule,
    )
    return F.concat(lines, F.lit("\n\n"), redacted)


def basic_header(redacted: Column, spans: Column, name: Column, epsilon: Column, when: Column) -> Column:
    """Header variant with counts of basic and other types."""
    basic = F.size(F.filter(spans, lambda s: sp.is_basic(s["category"])))
    lines = F.concat_ws(
        "\n",
        F.lit("=== Redacted Document ==="),
        F.concat(F.lit("Original: "), F.coalesce(name, F.lit("Unknown"))),
        F.concat(F.lit("Privacy Level: ε="), epsilon.cast("string")),
        F.concat(F.lit("Redaction Date: "), when.cast("string")),
        F.concat(F.lit("Basic PII Count: "), basic.cast("string")),
        F.concat(F.lit("Other PII Count: "), (F.size(spans) - basic).cast("string")),
        F.concat(F.lit("Total PII: "), F.size(spans).cast("string")),
        F.lit("=" * 33),
    )
    return F.concat(lines, F.lit("\n\n"), redacted)


def redact_folder(
    spark: SparkSession, folder: str, out: str, style: str = "mask", categories: list[str] | None = None,
    model: Model | None = None, text_files: bool = False, named_files: bool = False,
) -> DataFrame:
    """Redact every *.txt file of a folder; returns the one-row summary. ``named_files``
    also writes each text to a file of its output name under ``named_files``; names that
    repeat (in a glob over several folders) raise a ValueError. ``text_files`` makes a
    folder that bears the output name instead, which is for a few files only.

    Text and details are written as tables under ``out`` with the output names
    as columns; undecodable files are counted as failed and do not stop the job.
    """
    from veilmark.operators.profile import batch_summary

    scanned = files.read_folder(spark, folder)
    done = redact_documents(scanned, style=style, categories=categories, model=model)
    named = done.withColumn("output_file", files.redacted_name(F.col("path"))).withColumn(
        "details_file", files.details_name(F.col("path"))
    )
    named.write.mode("overwrite").parquet(f"{out}/results")
    results = spark.read.schema(named.schema).parquet(f"{out}/results")
    ok = results.where("error IS NULL")
    name, text = F.element_at(F.split("output_file", "/"), -1), F.col("result.redacted_text")
    ok.select("output_file", text.alias("value")).write.mode("overwrite").json(f"{out}/text")
    if text_files:
        ok.select(name.alias("name"), text.alias("value")).write.mode("overwrite").partitionBy("name").text(f"{out}/text_files")
    if named_files:
        write_named(ok, f"{out}/named_files", name, text)
    ok.select("details_file", "result.*").write.mode("overwrite").json(f"{out}/details")
    ok.select(
        F.col("path").alias("input_file"), "output_file", F.col("result.statistics.entity_count").alias("entity_count")
    ).write.mode("overwrite").json(f"{out}/files")
    summary = batch_summary(results, F.col("result.statistics.entity_count"), F.col("error"))
    summary.write.mode("overwrite").json(f"{out}/summary")
    return summary
