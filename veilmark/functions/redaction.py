"""Replacement rules and per-document redaction results."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import spans as sp
from veilmark.functions.text import uniform

Rule = Callable[[Column, Column], Column]


def mask(span: Column, piece: Column) -> Column:
    return F.lit(catalog.MASK)


def hash_sign(span: Column, piece: Column) -> Column:
    return F.lit(catalog.HASH)


def partial(span: Column, piece: Column) -> Column:
    """Keep a hint: first letter and domain, last four digits, or both ends."""
    local = F.substring_index(piece, "@", 1)
    domain = F.substring(piece, F.length(local) + 2, F.length(piece))
    digits = F.regexp_replace(piece, r"[^\p{Nd}]", "")
    ends = F.when(
        F.length(piece) > 4, F.concat(F.left(piece, F.lit(1)), F.lit("***"), F.right(piece, F.lit(1)))
    ).otherwise("***")
    return (
        F.when(
            (span["category"] == "EMAIL") & F.contains(piece, F.lit("@")) & (F.length(local) > 2),
            F.concat(F.left(piece, F.lit(1)), F.lit("***@"), domain),
        )
        .when(
            (span["category"] == "PHONE") & (F.length(digits) >= 4),
            F.concat(F.lit("***-***-"), F.right(digits, F.lit(4))),
        )
        .otherwise(ends)
    )


def category_label(span: Column, piece: Column) -> Column:
    known = list(catalog.CATEGORY_LABELS)
    return F.when(span["category"].isin(known), F.concat(F.lit("["), span["category"], F.lit("]"))).otherwise(
        catalog.DEFAULT_LABEL
    )


def blocks(span: Column, piece: Column) -> Column:
    """One block character per character: the length of the text stays."""
    return F.repeat(F.lit(catalog.BLOCK), span["end"] - span["start"])


#: style name -> rule; callers may add their own rules
STYLES: dict[str, Rule] = {
    "mask": mask,
    "hash": hash_sign,
    "partial": partial,
    "category_specific": category_label,
    "blocks": blocks,
}


def redact(text: str, spans: str, style: str = "mask") -> Column:
    """Redacted text from a text column and a sorted, disjoint span array column.

    An unknown style is a mask.
    """
    return _redacted(text, spans, STYLES.get(style, mask))


@cache
def _redacted(text: str, spans: str, rule: Rule) -> Column:
    # Columns are unresolved expressions: building one costs hundreds of calls
    # into the JVM, so it is built once per process.
    return sp.splice(F.col(text), F.col(spans), rule)


def redaction_probability(epsilon: Column) -> Column:
    return F.least(F.lit(0.95), F.greatest(F.lit(0.1), F.lit(1.0) / epsilon))


def drawn(
    spans: Column, doc_id: Column, epsilon: Column, seed: int = 42, by_confidence: bool = False
) -> Column:
    """Spans chosen for redaction, each with the probability of the privacy level
    (times its confidence if ``by_confidence``); the draw is reproducible."""

    def keep(s: Column) -> Column:
        p = redaction_probability(epsilon)
        if by_confidence:
            p = p * s["confidence"]
        return uniform(F.lit(seed), doc_id, s["start"], s["end"]) < p

    return F.filter(spans, keep)


def redaction_rate(original: Column, redacted: Column) -> Column:
    """Share of characters that became blocks, in percent."""
    n = F.length(original)
    left = F.length(F.replace(redacted, F.lit(catalog.BLOCK), F.lit("")))
    return F.when(n > 0, (n - left) / n * 100.0).otherwise(0.0)


def span_stats(text: Column, spans: Column) -> Column:
    """Per-document statistics struct."""
    return F.struct(
        F.length(text).alias("total_characters"),
        F.aggregate(spans, F.lit(0), lambda a, s: a + s["end"] - s["start"]).alias("redacted_characters"),
        F.size(spans).alias("entity_count"),
        F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["category"]))).alias("categories_detected"),
    )


def mean_confidence(spans: Column) -> Column:
    total = F.aggregate(spans, F.lit(0.0), lambda a, s: a + s["confidence"])
    return F.when(F.size(spans) > 0, total / F.size(spans)).otherwise(0.0)


def strength_band(epsilon: Column) -> Column:
    return F.when(epsilon <= 1.0, "STRONG").when(epsilon <= 3.0, "MODERATE").otherwise("LIGHT")
