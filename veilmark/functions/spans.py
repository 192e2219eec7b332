"""Span arrays: finding, merging, de-duplicating and splicing.

A span array is ``array<struct<category:string, start:int, end:int,
confidence:double, source:string, priority:int>>`` with 0-based character
offsets and an exclusive end. All functions are narrow: they read one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import matching
from veilmark.functions import text as tx
from veilmark.functions.arrays import indices, let, prefix_sums

SPAN_TYPE = (
    "struct<category:string,start:int,end:int,confidence:double,source:string,priority:int>"
)
SPANS_TYPE = f"array<{SPAN_TYPE}>"

# Private-use characters: one marks match borders, the other replaces the first
# where a text already holds it (same Unicode class, so patterns see no change).
_MARK, _STAND_IN = "", ""
_BLOCK_BITS, _PART_BITS = 9, 15
_BLOCK_CHARS = 1 << _BLOCK_BITS
# A span without a start comes first; the lower half of a sort key is a place.
_FIRST, _PLACE = -(2**31), 2**32 - 1


def lengths(text: Column, pattern: catalog.Pattern, facts: Column | None = None) -> Column:
    """``array<int>``: lengths of gap, match, gap, match, ..., gap.

    One regex pass puts a border character around each match; splitting at the
    borders gives the pieces, whose running lengths are the match offsets. ``facts``
    (``matching.facts``) are shared by the patterns that run on a text.
    """
    regex, second = matching.expression(pattern)
    marks = f"$1{_MARK}$2{_MARK}" if second else f"{_MARK}$0{_MARK}"
    marked = F.regexp_replace(F.replace(text, F.lit(_MARK), F.lit(_STAND_IN)), regex, marks)
    pieces = F.transform(F.split(marked, _MARK, -1), F.length)
    found = matching.facts(text, [pattern]) if facts is None else facts
    return F.when(matching.possible(text, pattern, found), pieces).otherwise(F.array().cast("array<int>"))


def lengths_of_all(text: Column, patterns: Iterable[catalog.Pattern]) -> Column:
    """``array<struct<pattern,lens>>``: :func:`lengths` of each pattern by name. The text
    (which may be a longer expression) and its facts are evaluated once for all of them."""
    patterns = list(patterns)

    def all_of(text: Column) -> Column:
        return let(
            matching.facts(text, patterns),
            lambda facts: F.array(*[F.struct(F.lit(p.name).alias("pattern"), lengths(text, p, facts).alias("lens")) for p in patterns]),
        )

    return let(text, all_of)


def _places(
    text: Column, pattern: catalog.Pattern, facts: Column | None, place: Callable[[Column, Column], Column], kind: str
) -> Column:
    """``place(start, end)`` (of type ``kind``) of all matches, left to right."""
    return let(
        lengths(text, pattern, facts),
        lambda lens: F.when(
            F.size(lens) > 1,
            let(
                prefix_sums(lens),
                lambda ends: F.transform(
                    indices(F.size(lens), 1, 2), lambda i: place(F.get(ends, i - 1), F.get(ends, i))
                ),
            ),
        ).otherwise(F.array().cast(f"array<{kind}>")),
    )


def offsets(text: Column, pattern: catalog.Pattern, facts: Column | None = None) -> Column:
    """``array<struct<start:int,end:int>>`` of all matches, left to right."""
    return _places(
        text, pattern, facts, lambda start, end: F.struct(start.alias("start"), end.alias("end")),
        "struct<start:int,end:int>",
    )


def find(
    text: Column, patterns: Iterable[catalog.Pattern], confidence: float = 1.0, source: str = "regex"
) -> Column:
    """All matches of a catalog as one span array, in (pattern, position) order."""

    def labelled(rank: int, p: catalog.Pattern, facts: Column) -> Column:
        return _places(
            text, p, facts,
            lambda start, end: F.struct(
                F.lit(p.name).alias("category"),
                start.alias("start"),
                end.alias("end"),
                F.lit(float(confidence)).alias("confidence"),
                F.lit(source).alias("source"),
                F.lit(rank).alias("priority"),
            ),
            SPAN_TYPE,
        )

    patterns = list(patterns)
    return let(
        matching.facts(text, patterns),
        lambda facts: F.flatten(F.array(*[labelled(i, p, facts) for i, p in enumerate(patterns)])),
    ).cast(SPANS_TYPE)


def span_text(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


def with_text(text: Column, spans: Column) -> Column:
    return F.transform(spans, lambda s: s.withField("text", span_text(text, s)))


def in_order(spans: Column, descending: bool = False) -> Column:
    """Spans by start; those with an equal start keep their order."""

    def ordered(spans: Column) -> Column:
        # Start and place as one number: numbers are sorted without a comparison function.
        def key(s: Column, i: Column) -> Column:
            start = -s["start"] if descending else s["start"]
            return F.shiftleft(F.coalesce(start, F.lit(_FIRST)).cast("long"), 32) + i

        keys = F.sort_array(F.transform(spans, key))
        return F.transform(keys, lambda k: F.get(spans, k.bitwiseAND(F.lit(_PLACE)).cast("int")))

    return let(spans, ordered)


def only(spans: Column, categories: Iterable[str]) -> Column:
    """Keep spans of the given categories (any case); unknown names are an error."""
    wanted = [c.strip().upper() for c in categories]
    unknown = sorted(set(wanted) - set(catalog.CATEGORIES))
    if unknown:
        raise ValueError(f"unknown categories: {', '.join(unknown)}")
    return F.filter(spans, lambda s: s["category"].isin(wanted))


def merge(spans: Column) -> Column:
    """Union of overlapping or touching spans.

    A merged span runs from the first start to the largest end and takes the
    attributes of its most confident member, the earliest one on ties.
    """

    def merged(ordered: Column) -> Column:
        # Where span i of the order starts behind all ends before it, and there only, those
        # are the i smallest ends. Sorted ends then say both where an island begins and
        # how far the one before it reaches.
        def islands(reach: Column) -> Column:
            firsts = F.filter(
                indices(F.size(ordered)),
                lambda i: (i == 0) | (F.get(ordered, i)["start"] > F.get(reach, i - 1)),
            )

            def close(first: Column) -> Column:
                def one(i: Column, n: Column) -> Column:
                    stop = F.coalesce(F.get(first, n + 1), F.size(ordered))

                    def united(stop: Column) -> Column:
                        sure = F.transform(F.slice(ordered, i + 1, stop - i), lambda s: s["confidence"])
                        best = let(sure, lambda c: F.coalesce(F.array_position(c, F.array_max(c)), F.lit(1)).cast("int"))
                        return let(
                            F.get(ordered, F.when(stop - i == 1, i).otherwise(i + best - 1)),
                            lambda s: s.withField("start", F.get(ordered, i)["start"]).withField(
                                "end", F.get(reach, stop - 1)
                            ),
                        )

                    return let(stop, united)

                return F.transform(first, one)

            return let(firsts, close)

        return let(F.sort_array(F.transform(ordered, lambda s: s["end"])), islands)

    return let(spans, lambda s: F.when(F.size(s) > 1, let(in_order(s), merged)).otherwise(s))


def dedupe(spans: Column) -> Column:
    """One span per (start, end): the first in the array wins."""

    def kept(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda x, n: (n == 0)
            | (F.get(ordered, n - 1)["start"] != x["start"])
            | (F.get(ordered, n - 1)["end"] != x["end"]),
        )

    keyed = F.transform(
        spans,
        lambda s, i: F.struct(s["start"].alias("start"), s["end"].alias("end"), i.alias("i"), s.alias("s")),
    )
    return F.transform(let(F.array_sort(keyed), kept), lambda x: x["s"])


def fallback(first: Column, second: Column) -> Column:
    """``first`` where it holds any span for this document, else ``second``."""
    return F.when(F.size(first) > 0, first).otherwise(second)


def _cuts(text: Column, bits: int) -> Column:
    """``text`` in pieces of 2**bits characters; one empty piece of an empty text."""
    return F.transform(
        F.sequence(F.lit(0), F.shiftright(F.greatest(F.length(text) - 1, F.lit(0)), bits)),
        lambda b: F.substring(text, b * (1 << bits) + 1, F.lit(1 << bits)),
    )


def _blocks(text: Column) -> Column:
    """``text`` in blocks. They are cut from longer parts: a block of a long text costs
    what leads to it."""
    return F.flatten(F.transform(_cuts(text, _PART_BITS), lambda part: _cuts(part, _BLOCK_BITS)))


def _cutter(text: Column, blocks: Column) -> Callable[[Column, Column], Column]:
    # Cutting from a block is O(block), cutting from a long text O(position).
    def cut(start: Column, end: Column) -> Column:
        def from_block(low: Column) -> Column:
            high = F.shiftright(end - 1, _BLOCK_BITS)
            near = F.when(high == low, F.get(blocks, low)).otherwise(
                F.array_join(F.slice(blocks, low + 1, high - low + 1), "")
            )
            return F.substring(near, start - low * _BLOCK_CHARS + 1, end - start)

        return (
            F.when(end <= start, F.lit(""))
            .when(F.size(blocks) == 1, F.substring(text, start + 1, end - start))
            .otherwise(let(F.shiftright(start, _BLOCK_BITS), from_block))
        )

    return cut


def splice(text: Column, spans: Column, replacement: Callable[[Column, Column], Column]) -> Column:
    """Replace every span of a sorted, disjoint array.

    ``replacement(span, span_text)`` gives the new text of a span.
    """

    def build(blocks: Column) -> Column:
        cut = _cutter(text, blocks)

        def between(behind: Column) -> Column:
            def pieces(s: Column, i: Column) -> Column:
                return F.concat(cut(F.get(behind, i), s["start"]), replacement(s, cut(s["start"], s["end"])))

            return F.array_join(F.transform(spans, pieces), "")

        # what stands before a span begins behind the one before it
        behind = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
        tail = cut(F.element_at(spans, F.lit(-1))["end"], F.length(text))
        return F.concat(let(behind, between), tail)

    return F.when(F.size(spans) > 0, let(_blocks(text), build)).otherwise(text)


def is_basic(category: Column) -> Column:
    return category.isin(*catalog.BASIC_TYPES)


def type_group(category: Column) -> Column:
    """PERSONAL / CONTACT / FINANCIAL / GENERAL of a span type."""
    group = None
    for name, members in catalog.TYPE_GROUPS.items():
        group = (F if group is None else group).when(category.isin(*members), F.lit(name))
    return group.otherwise(F.lit(catalog.DEFAULT_GROUP))


def band(confidence: Column) -> Column:
    return F.when(confidence >= 0.8, "HIGH").when(confidence >= 0.6, "MEDIUM").otherwise("LOW")


def chunk_category(chunk: Column) -> Column:
    """Category of a text chunk: first core pattern found, else heuristics."""

    def decide(digits: Column) -> Column:
        category = None
        for p in catalog.CORE:
            guard = F.contains(chunk, F.lit(p.needs)) if p.needs else digits > 0
            category = (F if category is None else category).when(guard & chunk.rlike(p.java), F.lit(p.name))
        return (
            category.when(tx.dot_after_last_at(chunk), "EMAIL")
            .when(digits > 7, "PHONE")
            .when(chunk.rlike(tx.HAS_TITLE_WORD), "NAME")
            .when(chunk.rlike(tx.has_word(catalog.STREET_WORDS)), "ADDRESS")
            .otherwise(catalog.GENERIC)
        )

    return let(tx.digit_count(chunk), decide)


def word_type(length: Column, at: Column, dot_at: Column, digits: Column, caps: Column) -> Column:
    """Type of a word from its features (thresholds are fixed values)."""
    return (
        F.when((at > 0.5) & (dot_at > 0.5), "EMAIL")
        .when((digits > 0.7) & (length > 1.0), F.when(digits > 0.9, "CREDIT_CARD").otherwise("PHONE"))
        .when((caps > 0.5) & (length > 1.0), F.when(digits < 0.1, "NAME").otherwise("ACCOUNT_NUMBER"))
        .when(digits > 0.3, "NUMERIC_ID")
        .when(at > 0.5, "USERNAME")
        .otherwise("GENERAL_PII")
    )
