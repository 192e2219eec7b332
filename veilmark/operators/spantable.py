"""Operators on span tables (one row per span), for spans that arrive as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilmark.operators.order import running, slice_bounds
from veilmark.sources.shared import cut


def dedupe_rows(spans: DataFrame, ids: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """One row per (document, start, end); the smallest ``prefer`` values win.

    A grouped minimum combines on the map side, so repeats never pile up.
    """
    rest = [c for c in spans.columns if c not in (*ids, "span_start", "span_end")]
    ranked = F.struct(*[F.col(c) for c in prefer])
    best = spans.groupBy(*ids, "span_start", "span_end").agg(F.min_by(F.struct(*rest), ranked).alias("b"))
    return best.select(*ids, "span_start", "span_end", *[F.col(f"b.{c}").alias(c) for c in rest])


def merge_rows(spans: DataFrame, ids: Sequence[str], slices: int = 64) -> DataFrame:
    """Union of overlapping or touching spans per document.

    Gaps and islands: a span opens an island if it starts after everything
    before it has ended. Both running values are sliced by position, so a
    document with very many spans is spread over tasks.
    """
    keys = list(ids)
    spans = cut(spans.select(*keys, "category", "span_start", "span_end", "confidence", "priority"), "spans")
    order = ["span_start", "priority", "span_end"]
    bounds = slice_bounds(spans, order, slices)
    reach = running(spans, keys, order, {"_reach": ("max", F.col("span_end"))}, bounds, before=["_reach"])
    opens = F.when(F.col("span_start") <= F.col("_reach"), 0).otherwise(1)
    marked = running(
        reach.withColumn("_opens", opens).drop("_reach"), keys, order, {"_island": ("sum", F.col("_opens"))}, bounds
    )
    lead = F.struct(F.col("confidence"), -F.col("span_start"), -F.col("priority"))
    return marked.groupBy(*keys, "_island").agg(
        F.max_by("category", lead).alias("category"),
        F.min("span_start").alias("span_start"),
        F.max("span_end").alias("span_end"),
        F.max("confidence").alias("confidence"),
    ).drop("_island")


def compare(detected: DataFrame, truth: DataFrame, ids: Sequence[str], slices: int = 64) -> DataFrame:
    """Status of every span: exact, partial, missed (truth) or spurious (detected).

    A span overlaps the other side if, of the other side's spans that start before
    its end, one ends after its start. So each span is two events, its start (which
    brings its end along) and its end (which asks), and one running maximum per side
    over the events of a document answers all. Rows moved are two a span, however long
    spans are and however many overlap; a document with very many is sliced. NULL ids
    are a document of their own. Row ids are (document, category, start, end).
    """
    keys, own = list(ids), ["side", "category", "span_start", "span_end", "both"]

    def rows(df: DataFrame, side: str) -> DataFrame:
        return df.select(*keys, "span_start", "span_end", F.struct(F.lit(side).alias("side"), "category").alias("own"))

    # One row a place: repeats combine on the map side, and a set has one entry a side and category.
    places = rows(detected, "detected").unionByName(rows(truth, "truth")).groupBy(*keys, "span_start", "span_end")
    of = places.agg(F.collect_set("own").alias("own"))
    has = [F.array_contains(F.col("own.side"), s) for s in ("detected", "truth")]
    both = has[0] & has[1] & (F.col("span_start") < F.col("span_end"))
    spans = cut(of.withColumn("both", both).withColumn("own", F.explode("own")).select("*", "own.*").drop("own"), "sides")
    is_truth = F.col("side") == "truth"
    events = spans.select(
        *keys, *own,
        F.explode(F.array(
            F.struct(F.col("span_end").alias("at"), F.lit(False).alias("starts")),
            F.struct(F.col("span_start").alias("at"), F.lit(True).alias("starts")),
        )).alias("e"),
    ).select(*keys, *own, "e.at", "e.starts")
    ends = {s: F.when(F.col("starts") & (F.col("side") == s), F.col("span_end")) for s in ("detected", "truth")}
    # at one place, ends ask before starts are seen
    swept = running(
        events, keys, ["at", "starts", "span_start", "span_end", "side", "category"],
        {f"_{s}": ("max", value) for s, value in ends.items()}, slices,
    ).where(~F.col("starts"))
    reach = F.when(is_truth, F.col("_detected")).otherwise(F.col("_truth"))
    status = (
        F.when(F.col("both"), "exact")
        .when(reach > F.col("span_start"), "partial")
        .otherwise(F.when(is_truth, "missed").otherwise("spurious"))
    )
    return swept.select("side", *keys, "category", "span_start", "span_end", status.alias("status"))


def rank_spans(spans: DataFrame, ids: Sequence[str], descending: bool = False) -> DataFrame:
    """Rank of each span in its document by start (no global sort, long documents sliced)."""
    by = F.col("span_start") * (-1 if descending else 1)
    placed = running(
        spans.withColumn("_by", by), list(ids), ["_by", "priority", "span_end"], {"rank": ("sum", F.lit(1).cast("long"))}
    )
    return placed.drop("_by")
