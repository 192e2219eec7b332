"""Greedy overlap suppression: the one span operator whose result depends on
the order of acceptance, so it runs as an Arrow batch function per document."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import kernels, matching
from veilmark.functions import spans as sp
from veilmark.functions.arrays import let


def suppress(df: DataFrame, spans: str = "spans", strict: bool = False) -> DataFrame:
    """Greedy suppression of a span array column in order of (priority, position)."""
    ranked = F.array_sort(
        F.transform(
            F.col(spans),
            lambda s, i: F.struct(s["priority"].alias("p"), i.alias("i"), s.alias("s")),
        )
    )
    ordered = df.withColumn(spans, F.transform(ranked, lambda x: x["s"]))
    edges = F.transform(F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    picked = ordered.withColumn("_kept", kernels.first_come_spans(strict)(edges))
    kept = F.transform(F.col("_kept"), lambda h: F.get(F.col(spans), h["priority"]))
    return picked.withColumn(spans, sp.in_order(kept)).drop("_kept")


@cache
def _lengths(text: str, ignore_case: bool) -> Column:
    patterns = catalog.extended(ignore_case)
    return let(
        matching.facts(F.col(text), patterns),
        lambda facts: F.array(*[sp.lengths(F.col(text), p, facts) for p in patterns]),
    )


def detect_extended(
    df: DataFrame, text: str = "text", ignore_case: bool = True, strict: bool = False, out: str = "spans"
) -> DataFrame:
    """29-pattern detection with greedy suppression, sorted by start.

    The expressions run in the JVM; only match lengths go to the Arrow function.
    """
    patterns = catalog.extended(ignore_case)
    lens = _lengths(text, ignore_case)
    names = F.array(*[F.lit(p.name) for p in patterns])
    hits = F.transform(
        F.col("_hits"),
        lambda h: F.struct(
            F.get(names, h["priority"]).alias("category"),
            h["start"].alias("start"),
            h["end"].alias("end"),
            F.lit(1.0).alias("confidence"),
            F.lit("extended").alias("source"),
            h["priority"].alias("priority"),
        ),
    )
    found = df.withColumn("_hits", kernels.first_come(strict)(lens))
    return found.withColumn(out, sp.in_order(hits).cast(sp.SPANS_TYPE)).drop("_hits")
