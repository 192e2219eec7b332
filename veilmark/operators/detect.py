"""Detection on a documents table: each operator adds a span array column."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import kernels
from veilmark.functions import spans as sp
from veilmark.functions import text as tx
from veilmark.functions.arrays import indices, let, prefix_sums
from veilmark.operators.model import Model
from veilmark.operators.suppress import detect_extended

__all__ = [
    "chunks", "detect_core", "detect_extended", "detect_fallback", "detect_hybrid", "detect_truth",
    "detect_with_policy", "model_chunk_spans", "model_word_spans", "tokens", "to_rows", "words",
]

CHUNK = 50

# A column expression is unresolved and reusable; building one of these takes
# hundreds of calls into the JVM, so each is built once per process.


@cache
def _core(text: str) -> Column:
    return sp.merge(sp.find(F.col(text), catalog.CORE))


@cache
def _fallback(text: str) -> Column:
    return sp.find(F.col(text), catalog.FALLBACK, catalog.FALLBACK_CONFIDENCE, "fallback")


@cache
def _truth(text: str) -> Column:
    return sp.find(F.col(text), catalog.TRUTH, 1.0, "truth")


def detect_core(df: DataFrame, text: str = "text", out: str = "spans", categories=None) -> DataFrame:
    """Six core patterns, overlapping and touching matches merged."""
    found = _core(text)
    return df.withColumn(out, found if categories is None else sp.only(found, categories))


def detect_fallback(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Four patterns with a flat confidence; overlaps stay."""
    return df.withColumn(out, _fallback(text))


def detect_truth(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Ground-truth extractor; overlaps stay."""
    return df.withColumn(out, _truth(text))


def to_rows(df: DataFrame, ids: list[str], spans: str = "spans", text: str | None = "text") -> DataFrame:
    """Span table: one row per span, with its text if ``text`` names the source column."""
    # Outer, then filtered: a plain explode would push "has spans" below the
    # projection and so detect twice.
    rows = df.select(
        *ids, *([text] if text else []), F.posexplode_outer(spans).alias("span_no", "s")
    ).where("span_no IS NOT NULL")
    piece = [sp.span_text(F.col(text), F.col("s")).alias("span_text")] if text else []
    fields = [
        F.col(f"s.{f}").alias(a)
        for f, a in (
            ("category", "category"), ("start", "span_start"), ("end", "span_end"),
            ("confidence", "confidence"), ("source", "source"), ("priority", "priority"),
        )
    ]
    return rows.select(*ids, "span_no", *fields, *piece)


def tokens(df: DataFrame, ids: list[str], text: str = "text") -> DataFrame:
    """Whitespace tokens, one row each."""
    rows = df.select(*ids, F.posexplode_outer(tx.ws_tokens(F.col(text))).alias("pos", "token"))
    return rows.where("pos IS NOT NULL")


@cache
def _word_array(text: str) -> Column:
    """``array<struct<word,start,end>>``; words come from the matches themselves,
    because cutting each one out of a long text would walk the text every time."""
    return let(
        tx.word_tokens(F.col(text)),
        lambda found: F.transform(
            sp.offsets(F.col(text), catalog.WORD),
            lambda s, i: F.struct(F.get(found, i).alias("word"), s["start"].alias("start"), s["end"].alias("end")),
        ),
    )


def words(df: DataFrame, ids: list[str], text: str = "text") -> DataFrame:
    """Word tokens with exact offsets, one row each."""
    rows = df.select(*ids, F.posexplode_outer(_word_array(text)).alias("pos", "s"))
    return rows.where("pos IS NOT NULL").select(*ids, "pos", "s.word", "s.start", "s.end")


@cache
def _chunk_array(text: str, size: int, context: bool = True, places: bool = True) -> Column:
    """``array<struct<chunk,context,start,end>>`` of one text; context and places are optional.

    A chunk is its words joined by one blank; start and end are the character
    range in the source from its first to its last word. The context is the
    previous and the next chunk, taken from the same array.
    """
    step = size // 5
    word = catalog.Pattern("TOKEN", f"[^{tx.WS[1:-1]}]+")

    def build(tokens: Column) -> Column:
        n = F.size(tokens)
        joined = F.transform(
            indices(n, 0, step), lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(size)), " ")
        )

        def with_context(chunk: Column) -> Column:
            def place(ends: Column | None) -> Column:
                def one(c: Column, i: Column) -> Column:
                    before = F.when(i > 0, F.get(chunk, i - 1)).otherwise("")
                    after = F.get(chunk, i + 1)
                    around = [F.when(after.isNotNull(), F.concat(before, F.lit(" "), after)).otherwise(before).alias("context")]
                    around = around if context else []
                    if ends is None:
                        return F.struct(c.alias("chunk"), *around)
                    last = F.least(i * step + size, n)
                    return F.struct(
                        c.alias("chunk"),
                        *around,
                        F.get(ends, 2 * i * step).alias("start"),
                        F.get(ends, 2 * last - 1).alias("end"),
                    )

                return F.transform(chunk, one)

            if not places:
                return place(None)
            return let(prefix_sums(sp.lengths(F.col(text), word)), place)

        return let(joined, with_context)

    return let(tx.ws_tokens(F.col(text)), build)


def chunks(
    df: DataFrame, ids: list[str], text: str = "text", size: int = CHUNK, context: bool = True, places: bool = True
) -> DataFrame:
    """Overlapping word chunks (step = size // 5), on request with their neighbours as
    context and their places in the text."""
    rows = df.select(*ids, F.posexplode_outer(_chunk_array(text, size, context, places)).alias("chunk_no", "c"))
    columns = ["c.chunk", *(["c.context"] if context else []), *(["c.start", "c.end"] if places else [])]
    return rows.where("chunk_no IS NOT NULL").select(*ids, "chunk_no", *columns)


def _as_spans(hits: Column, category, source: str) -> Column:
    return F.transform(
        hits,
        lambda h: F.struct(
            category(h).alias("category"), h["start"].cast("int").alias("start"), h["end"].cast("int").alias("end"),
            h["p"].alias("confidence"), F.lit(source).alias("source"), F.lit(0).alias("priority"),
        ),
    ).cast(sp.SPANS_TYPE)


def model_chunk_spans(df: DataFrame, model: Model, text: str = "text", out: str = "spans", size: int = CHUNK) -> DataFrame:
    """Chunks that the model calls personal data, with category, merged per document.

    Features of all chunks of a batch come from sums over their words, so no word is read
    more than once for them; only chunks that are not plainly a name are put together and
    go through the patterns.
    """
    found = df.withColumn("_c", kernels.chunk_hits(model.layers, size)(tx.plain_with_cases(F.col(text))))
    words = F.when(F.exists("_c", lambda c: ~c["named"]), tx.ws_tokens(F.col(text)))

    def category(words: Column, c: Column) -> Column:
        chunk = F.array_join(F.slice(words, c["first"] + 1, F.lit(size)), " ")
        return F.when(c["named"], "NAME").otherwise(let(chunk, sp.chunk_category))

    spans = let(words, lambda w: _as_spans(F.col("_c"), lambda c: category(w, c), "model"))
    return found.withColumn(out, sp.merge(spans)).drop("_c")


def model_word_spans(
    df: DataFrame, model: Model, text: str = "text", out: str = "spans",
    position: str = "each", threshold: float = 0.5,
) -> DataFrame:
    """Words that the model calls personal data.

    ``position='each'`` places every occurrence where it stands;
    ``'first'`` places a word at its first occurrence in the text. Features and types are
    those of ``features.word_token`` and ``spans.word_type``, for all words of a batch at once.
    """
    placed = kernels.word_spans(model.layers, threshold, position == "first")
    return df.withColumn(out, placed(F.col(text), tx.plain(F.col(text))))


def detect_hybrid(df: DataFrame, model: Model, text: str = "text", out: str = "spans", merged: bool = True) -> DataFrame:
    """Model spans first, then core spans, one span per exact position.

    ``merged`` also unites overlaps, which redaction needs.
    """
    both = detect_core(model_chunk_spans(df, model, text, "_model"), text, "_regex")
    spans = sp.dedupe(F.concat(F.col("_model"), F.col("_regex")))
    return both.withColumn(out, sp.merge(spans) if merged else spans).drop("_model", "_regex")


def detect_with_policy(df: DataFrame, model: Model | None, text: str = "text", out: str = "spans") -> DataFrame:
    """Word model where it finds anything in the document, fallback patterns elsewhere."""
    if model is None:
        return detect_fallback(df, text, out)
    found = model_word_spans(df, model, text, "_model")
    # The patterns run where they are asked for only.
    return found.withColumn(out, sp.fallback(F.col("_model"), _fallback(text))).drop("_model")
