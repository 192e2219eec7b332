"""Detection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import spans as sp
from veilmark.operators import detect
from veilmark.operators.model import Model
from veilmark.queries.base import (
    CORE_MERGED, extended_spans, filler, q, query, raw_spans, re2, tag_case, tokens_of, widened,
)
from veilmark.sources.tables import texts

# A fixed small network, so that checks can state its parameters.
WORD_MODEL = Model.by_rule([6, 5, 5, 2], 1.9)
CHUNK_MODEL = Model.by_rule([6, 8, 4, 2], 1.8)

_SPAN_COLUMNS = ("doc_id", "category", "span_start", "span_end", "span_text")


@query(
    "spans_core",
    f"WITH {CORE_MERGED} SELECT d.doc_id, category, s AS span_start, e AS span_end, "
    "substring(text, s + 1, e - s) AS span_text FROM merged JOIN documents d USING (doc_id)",
)
def spans_core(spark, sf):
    found = detect.detect_core(texts(spark, sf))
    return detect.to_rows(found, ["doc_id"]).select(*_SPAN_COLUMNS)


@query(
    "spans_core_by_language",
    f"WITH {CORE_MERGED} SELECT lang, category, count(*) AS n_spans, count(DISTINCT doc_id) AS n_docs, "
    "CAST(sum(e - s) AS BIGINT) AS n_chars FROM merged JOIN documents USING (doc_id) GROUP BY lang, category",
)
def spans_core_by_language(spark, sf):
    """Flagship: spans, documents and characters per language and category."""
    found = detect.detect_core(texts(spark, sf)).select("doc_id", "lang", "spans")
    # One row for each of the few categories of a text, so documents are counted without a distinct.
    def of_category(c):
        own = F.filter("spans", lambda s: s["category"] == c)
        chars = F.aggregate(own, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
        return F.struct(c.alias("category"), F.size(own).alias("n"), chars.alias("chars"))

    kinds = F.array_distinct(F.transform("spans", lambda s: s["category"]))
    rows = found.select("lang", F.explode_outer(F.transform(kinds, of_category)).alias("s")).where("s IS NOT NULL")
    return rows.groupBy("lang", F.col("s.category").alias("category")).agg(
        F.sum("s.n").alias("n_spans"), F.count(F.lit(1)).alias("n_docs"), F.sum("s.chars").alias("n_chars")
    )


def _core_sql(table: str, ids: str, text: str) -> str:
    from veilmark.queries.base import merged_spans

    return (
        f"WITH {raw_spans(catalog.CORE, table=table, text=text, ids=ids)}, {merged_spans(ids=ids)} "
        f"SELECT {ids}, category, s AS span_start, e AS span_end FROM merged"
    )


@query("spans_core_pages", _core_sql("pages", "page_id", "html"))
def spans_core_pages(spark, sf):
    found = detect.detect_core(texts(spark, sf, "pages"), "html")
    return detect.to_rows(found, ["page_id"], text=None).select("page_id", "category", "span_start", "span_end")


@query("spans_core_conversations", _core_sql("conversations", "conv_id, turn", "text"))
def spans_core_conversations(spark, sf):
    found = detect.detect_core(texts(spark, sf, "conversations"))
    return detect.to_rows(found, ["conv_id", "turn"], text=None).select(
        "conv_id", "turn", "category", "span_start", "span_end"
    )


_RE2_ABLE = [p for p in catalog.extended() if p.name not in ("FIRSTNAME", "LASTNAME")]


def _pattern_sql() -> str:
    parts = [
        f"SELECT {q(p.name)} AS pattern, count_if(len(m) > 0) AS n_docs, "
        f"CAST(coalesce(sum(len(m)), 0) AS BIGINT) AS n_matches, "
        f"CAST(coalesce(sum(list_sum(list_transform(m, lambda x: length(x)))), 0) AS BIGINT) AS n_chars "
        f"FROM (SELECT regexp_extract_all({widened(filler(p.name))}, {q(re2(p))}) AS m FROM documents)"
        for p in _RE2_ABLE
    ]
    return " UNION ALL ".join(parts)


@query("extended_pattern_matches", _pattern_sql())
def extended_pattern_matches(spark, sf):
    """Every extended pattern on its own, before suppression (two need look-ahead
    and are checked against brute force instead)."""
    docs = texts(spark, sf)
    rows = docs.select(F.explode_outer(sp.lengths_of_all(F.col("text"), _RE2_ABLE)).alias("x")).select("x.*")
    matched = F.filter("lens", lambda _, i: i % 2 == 1)
    return rows.groupBy("pattern").agg(
        F.count_if(F.size("lens") > 1).alias("n_docs"),
        F.sum(F.floor(F.size("lens") / 2)).alias("n_matches"),
        F.sum(F.aggregate(matched, F.lit(0).cast("long"), lambda a, n: a + n)).alias("n_chars"),
    )


_BASIC = "category IN (" + ", ".join(map(q, catalog.BASIC_TYPES)) + ")"


@query(
    "spans_extended",
    f"WITH {extended_spans(True, False)} SELECT doc_id, category, s AS span_start, e AS span_end, {_BASIC} AS is_basic FROM kept",
)
def spans_extended(spark, sf):
    """29 patterns with greedy suppression."""
    found = detect.detect_extended(texts(spark, sf).select("doc_id", "text"))
    return detect.to_rows(found, ["doc_id"], text=None).select(
        "doc_id", "category", "span_start", "span_end", sp.is_basic(F.col("category")).alias("is_basic")
    )


@query(
    "spans_extended_case_sensitive",
    f"WITH {extended_spans(False, True)} SELECT doc_id, category, s AS span_start, e AS span_end FROM kept",
)
def spans_extended_case_sensitive(spark, sf):
    found = detect.detect_extended(texts(spark, sf).select("doc_id", "text"), ignore_case=False, strict=True)
    return detect.to_rows(found, ["doc_id"], text=None).select("doc_id", "category", "span_start", "span_end")


@query(
    "basic_and_other_counts",
    f"WITH {extended_spans(True, False)} SELECT doc_id, CAST(count(*) FILTER ({_BASIC}) AS INTEGER) AS basic, "
    f"CAST(count(category) FILTER (NOT {_BASIC}) AS INTEGER) AS other, CAST(count(category) AS INTEGER) AS total "
    "FROM documents LEFT JOIN kept USING (doc_id) GROUP BY doc_id",
)
def basic_and_other_counts(spark, sf):
    found = detect.detect_extended(texts(spark, sf).select("doc_id", "text"))
    basic = F.size(F.filter("spans", lambda s: sp.is_basic(s["category"])))
    return found.select(
        "doc_id", basic.alias("basic"), (F.size("spans") - basic).alias("other"), F.size("spans").alias("total")
    )


@query(
    "spans_fallback",
    f"WITH {raw_spans(catalog.FALLBACK)} SELECT doc_id, category, count(*) AS n_spans, "
    "CAST(sum(s) AS BIGINT) AS start_sum, CAST(sum(e) AS BIGINT) AS end_sum, 0.7::DOUBLE AS confidence "
    "FROM raw GROUP BY doc_id, category",
)
def spans_fallback(spark, sf):
    """All fallback spans, folded to per-category sums inside each document's row."""
    found = detect.detect_fallback(texts(spark, sf).select("doc_id", "text"))
    def fold(name: str):
        mine = F.filter("spans", lambda s: s["category"] == name)
        zero = F.lit(0).cast("long")
        return F.struct(
            F.lit(name).alias("category"),
            F.size(mine).cast("long").alias("n_spans"),
            F.aggregate(mine, zero, lambda a, s: a + s["start"]).alias("start_sum"),
            F.aggregate(mine, zero, lambda a, s: a + s["end"]).alias("end_sum"),
        )

    folded = F.array(*[fold(p.name) for p in catalog.FALLBACK])
    return (
        found.select("doc_id", F.explode_outer(folded).alias("x"))
        .where("x.n_spans > 0")
        .select("doc_id", "x.*", F.lit(catalog.FALLBACK_CONFIDENCE).alias("confidence"))
    )


@query(
    "spans_truth",
    f"WITH {raw_spans(catalog.TRUTH)} SELECT doc_id, category, s AS span_start, e AS span_end FROM raw",
)
def spans_truth(spark, sf):
    found = detect.detect_truth(texts(spark, sf))
    return detect.to_rows(found, ["doc_id"], text=None).select("doc_id", "category", "span_start", "span_end")


def _chunk_sql(size: int = 50) -> str:
    step = size // 5
    return (
        f"tok AS (SELECT doc_id, {tokens_of('text')} AS t FROM documents), "
        f"ch AS (SELECT doc_id, unnest(range(0, len(t), {step})) AS i, t FROM tok), "
        f"chunk AS (SELECT doc_id, CAST(i / {step} AS INTEGER) AS chunk_no, "
        f"array_to_string(t[CAST(i + 1 AS INTEGER):CAST(i + {size} AS INTEGER)], ' ') AS chunk FROM ch)"
    )


CHUNK_SQL = _chunk_sql()


def _chunk_category_sql() -> str:
    from veilmark.functions import text as tx

    w = lambda p: widened(filler(p.name), "chunk")
    cases = " ".join(f"WHEN regexp_matches({w(p)}, {q(re2(p))}) THEN {q(p.name)}" for p in catalog.CORE)
    last = "list_last(string_split(chunk, '@'))"
    digits = f"(length(chunk) - length(regexp_replace(chunk, {q(tx.DIGIT)}, '', 'g')))"
    return (
        f"CASE {cases} WHEN contains(chunk, '@') AND contains({last}, '.') THEN 'EMAIL' "
        f"WHEN {digits} > 7 THEN 'PHONE' WHEN regexp_matches(chunk, {q(tx.HAS_TITLE_WORD)}) THEN 'NAME' "
        f"WHEN regexp_matches(chunk, {q(tx.has_word(catalog.STREET_WORDS))}) THEN 'ADDRESS' ELSE 'GENERIC_PII' END"
    )


@query(
    "chunk_categories",
    f"WITH {CHUNK_SQL} SELECT doc_id, category, count(*) AS n_chunks FROM "
    f"(SELECT doc_id, {_chunk_category_sql()} AS category FROM chunk) GROUP BY doc_id, category",
)
def chunk_categories(spark, sf):
    rows = detect.chunks(texts(spark, sf).select("doc_id", "text"), ["doc_id"], context=False, places=False)
    labelled = rows.select("doc_id", sp.chunk_category(F.col("chunk")).alias("category"))
    return labelled.groupBy("doc_id", "category").agg(F.count(F.lit(1)).alias("n_chunks"))


def _word_type_sql() -> str:
    from veilmark.functions import text as tx

    digits = f"(length(w) - length(regexp_replace(w, {q(tx.DIGIT)}, '', 'g')))::DOUBLE / greatest(length(w), 1)"
    groups = " ".join(
        f"WHEN word_type IN ({', '.join(q(m) for m in ms)}) THEN {q(g)}" for g, ms in catalog.TYPE_GROUPS.items()
    )
    return (
        "WITH w AS (SELECT unnest(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS w FROM documents), "
        f"f AS (SELECT least(length(w)::DOUBLE / 10, 2.0) AS len, {digits} AS dr, "
        "regexp_matches(w, '^\\p{Lu}') AS up FROM w), "
        "t AS (SELECT CASE WHEN dr > 0.7 AND len > 1.0 THEN CASE WHEN dr > 0.9 THEN 'CREDIT_CARD' ELSE 'PHONE' END "
        "WHEN up AND len > 1.0 THEN CASE WHEN dr < 0.1 THEN 'NAME' ELSE 'ACCOUNT_NUMBER' END "
        "WHEN dr > 0.3 THEN 'NUMERIC_ID' ELSE 'GENERAL_PII' END AS word_type FROM f) "
        f"SELECT word_type, CASE {groups} ELSE 'GENERAL' END AS type_group, count(*) AS n_words "
        "FROM t GROUP BY ALL"
    )


@query("word_types_and_groups", _word_type_sql())
def word_types_and_groups(spark, sf):
    from veilmark.functions import features as ft
    from veilmark.functions import text as tx

    words = texts(spark, sf).select(F.explode_outer(tx.word_tokens(F.col("text"))).alias("word")).where("word IS NOT NULL")
    f = ft.word(F.col("word"))
    kind = sp.word_type(f["length"], f["has_at"], f["has_dot"], f["digit_ratio"], f["first_upper"])
    counted = words.groupBy(kind.alias("word_type")).agg(F.count(F.lit(1)).alias("n_words"))
    return counted.select("word_type", sp.type_group(F.col("word_type")).alias("type_group"), "n_words")


def _mlp_sql(model: Model, x: str) -> str:
    """Nested list expressions for a network with tanh between layers."""
    for k, (w, b) in enumerate(model.layers):
        outs = []
        for j in range(w.shape[1]):
            dot = " + ".join(f"({float(w[i, j])!r})::DOUBLE * ({x})[{i + 1}]" for i in range(w.shape[0]))
            z = f"({dot} + ({float(b[j])!r})::DOUBLE)"
            outs.append(f"tanh{z}" if k < len(model.layers) - 1 else z)
        x = f"h{k}"
        yield x, f"[{', '.join(outs)}]"


def mlp_ctes(model: Model, source: str, keep: str, x: str) -> str:
    """CTEs h0, h1, ... with the layer outputs; the last one holds the logits."""
    ctes, previous = [], source
    for name, expr in _mlp_sql(model, x):
        ctes.append(f"c_{name} AS (SELECT {keep}, {expr} AS {name} FROM {previous})")
        previous = f"c_{name}"
    return ", ".join(ctes)


def _word_model_sql() -> str:
    from veilmark.functions import text as tx

    digits = f"(length(w) - length(regexp_replace(w, {q(tx.DIGIT)}, '', 'g')))::DOUBLE / greatest(length(w), 1)"
    last = f"c_h{len(WORD_MODEL.layers) - 1}"
    out = f"h{len(WORD_MODEL.layers) - 1}"
    return (
        "WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS w FROM documents), "
        f"f AS (SELECT doc_id, length(w) AS n, [least(length(w)::DOUBLE / 10, 2.0::DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE, {digits}, "
        "CASE WHEN regexp_matches(w, '^\\p{Lu}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, 0.1::DOUBLE] AS x FROM w), "
        f"{mlp_ctes(WORD_MODEL, 'f', 'doc_id, n', 'x')}, "
        f"p AS (SELECT doc_id, n, 1 / (1 + exp({out}[1] - {out}[2])) AS p FROM {last}) "
        "SELECT doc_id, count(*) AS n_spans, CAST(sum(n) AS BIGINT) AS n_chars, round(avg(p), 6) AS mean_confidence, "
        "count_if(p >= 0.8) AS high, count_if(p >= 0.6 AND p < 0.8) AS medium, count_if(p < 0.6) AS low "
        "FROM p WHERE p > 0.5 GROUP BY doc_id"
    )


def _scored_words_sql() -> str:
    """CTEs ending in ``scored``: every word with its place, first place in the text, type and probability."""
    from veilmark.functions import text as tx

    digits = f"(length(w) - length(regexp_replace(w, {q(tx.DIGIT)}, '', 'g')))::DOUBLE / greatest(length(w), 1)"
    out = f"h{len(WORD_MODEL.layers) - 1}"
    keep = "doc_id, s, e, w, n, dr, up"
    return (
        "m AS (SELECT doc_id, text, regexp_extract_all(text, '[\\p{L}\\p{N}_]+') AS w, string_split_regex(text, '[\\p{L}\\p{N}_]+') AS g FROM documents), "
        "u AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS w, unnest(list_transform(g[1:len(w)], lambda x: length(x))) AS gl "
        "FROM m WHERE len(w) > 0), "
        "o AS (SELECT doc_id, w, length(w) AS n, sum(gl) OVER z + sum(length(w)) OVER z AS e FROM u WINDOW z AS (PARTITION BY doc_id ORDER BY i)), "
        f"f AS (SELECT doc_id, w, n, CAST(e - n AS INTEGER) AS s, CAST(e AS INTEGER) AS e, {digits} AS dr, regexp_matches(w, '^\\p{{Lu}}') AS up FROM o), "
        "x AS (SELECT *, [least(n::DOUBLE / 10, 2.0::DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE, dr, CASE WHEN up THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, "
        "0.1::DOUBLE] AS x FROM f), "
        f"{mlp_ctes(WORD_MODEL, 'x', keep, 'x')}, "
        f"scored AS (SELECT {keep}, 1 / (1 + exp({out}[1] - {out}[2])) AS p, min(s) OVER (PARTITION BY doc_id, w) AS first, "
        "CASE WHEN dr > 0.7 AND n > 10 THEN CASE WHEN dr > 0.9 THEN 'CREDIT_CARD' ELSE 'PHONE' END "
        "WHEN up AND n > 10 THEN CASE WHEN dr < 0.1 THEN 'NAME' ELSE 'ACCOUNT_NUMBER' END "
        f"WHEN dr > 0.3 THEN 'NUMERIC_ID' ELSE 'GENERAL_PII' END AS category FROM c_{out})"
    )


@query("model_word_spans", _word_model_sql())
def model_word_spans(spark, sf):
    """Words scored by a network; spans folded per document, with confidence bands."""
    found = detect.model_word_spans(texts(spark, sf).select("doc_id", "text"), WORD_MODEL)
    total = F.aggregate("spans", F.lit(0.0), lambda a, s: a + s["confidence"])
    in_band = lambda name: F.size(F.filter("spans", lambda s: sp.band(s["confidence"]) == name)).cast("long")
    return found.where(F.size("spans") > 0).select(
        "doc_id",
        F.size("spans").cast("long").alias("n_spans"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_chars"),
        F.round(total / F.size("spans"), 6).alias("mean_confidence"),
        in_band("HIGH").alias("high"), in_band("MEDIUM").alias("medium"), in_band("LOW").alias("low"),
    )


@query(
    "model_word_spans_first_position",
    f"WITH {_scored_words_sql()} SELECT doc_id, category, first AS span_start, first + n AS span_end, round(p, 6) AS confidence "
    "FROM scored WHERE p > 0.5",
)
def model_word_spans_first_position(spark, sf):
    found = detect.model_word_spans(texts(spark, sf).select("doc_id", "text"), WORD_MODEL, position="first")
    return detect.to_rows(found, ["doc_id"], text=None).select(
        "doc_id", "category", "span_start", "span_end", F.round("confidence", 6).alias("confidence")
    )


@query(
    "fallback_policy",
    f"WITH {_scored_words_sql()}, {raw_spans(catalog.FALLBACK, prefix='r_')}, "
    "a AS (SELECT doc_id, count(*) AS n FROM scored WHERE p > 0.5 GROUP BY doc_id), b AS (SELECT doc_id, count(*) AS n FROM r_raw GROUP BY doc_id) "
    "SELECT doc_id, CASE WHEN a.n > 0 THEN 'model' WHEN b.n > 0 THEN 'fallback' END AS source, coalesce(a.n, b.n, 0) AS n_spans "
    "FROM documents LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)",
)
def fallback_policy(spark, sf):
    """Model spans where a document has any, fallback spans elsewhere."""
    found = detect.detect_with_policy(texts(spark, sf).select("doc_id", "text"), WORD_MODEL)
    return found.select(
        "doc_id", F.get("spans", F.lit(0))["source"].alias("source"), F.size("spans").alias("n_spans")
    )


@query(
    "tagger_counts",
    f"SELECT doc_id, tag, count(*) AS n_tokens FROM (SELECT doc_id, {tag_case('t')} AS tag FROM "
    f"(SELECT doc_id, unnest({tokens_of('text')}) AS t FROM documents)) GROUP BY doc_id, tag",
)
def tagger_counts(spark, sf):
    from veilmark.functions import labels as lb
    from veilmark.functions import text as tx

    tokens = texts(spark, sf).select("doc_id", F.explode_outer(tx.ws_tokens(F.col("text"))).alias("t")).where("t IS NOT NULL")
    return tokens.groupBy("doc_id", lb.tag(F.col("t")).alias("tag")).agg(F.count(F.lit(1)).alias("n_tokens"))
