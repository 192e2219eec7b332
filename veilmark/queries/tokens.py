"""Token, chunk and label-array queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import labels as lb
from veilmark.functions import text as tx
from veilmark.operators import detect, profile
from veilmark.queries.base import DIGITS, TOKENS, WORDS, q, query, tag_case, uniform_sql
from veilmark.queries.detection import CHUNK_SQL
from veilmark.sources.tables import texts

TAGGED = f"tok AS (SELECT doc_id, text, {TOKENS} AS t FROM documents), " \
    f"tagged AS (SELECT doc_id, text, t, list_transform(t, lambda x: {tag_case('x')}) AS tags FROM tok)"

# A second rule set over word tokens stands in for the true labels: numbers, and
# runs of capitalised words. Word tokens are more than whitespace tokens, so
# lengths differ and alignment has work to do.
TRUE_RULE = (
    "CASE WHEN regexp_matches(x, '^[0-9]+$') THEN 'B-NUMBER' "
    "WHEN regexp_matches(x, '^\\p{Lu}') AND length(x) > 3 THEN 'B-NAME' "
    "WHEN regexp_matches(x, '^\\p{Lu}') THEN 'I-NAME' ELSE 'O' END"
)
LABELLED = (
    f"{TAGGED}, labelled AS (SELECT doc_id, text, t, tags, list_transform({WORDS}, lambda x: {TRUE_RULE}) AS labels FROM tagged)"
)


def true_labels(text):
    return F.transform(
        tx.word_tokens(text),
        lambda w: F.when(w.rlike("^[0-9]+$"), "B-NUMBER")
        .when(tx.starts_upper(w) & (F.length(w) > 3), "B-NAME")
        .when(tx.starts_upper(w), "I-NAME")
        .otherwise("O"),
    )


def corpus(spark, sf):
    """doc_id, text, tokens t, predicted tags, true labels."""
    docs = texts(spark, sf).select("doc_id", "text")
    tokens = docs.withColumn("t", tx.ws_tokens(F.col("text")))
    return tokens.withColumn("tags", lb.tags(F.col("t"))).withColumn("labels", true_labels(F.col("text")))


def _digest(arr: str) -> str:
    return f"md5(array_to_string({arr}, ' '))"


@query(
    "whitespace_tokens",
    f"WITH {TAGGED} SELECT doc_id, len(t) AS n_tokens, {_digest('t')} AS digest, t[-1] AS last_token FROM tagged",
)
def whitespace_tokens(spark, sf):
    t = texts(spark, sf).select("doc_id", tx.ws_tokens(F.col("text")).alias("t"))
    return t.select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest"),
        F.get("t", F.size("t") - 1).alias("last_token"),
    )


@query(
    "token_rows",
    f"SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM (SELECT doc_id, unnest({TOKENS}) AS token "
    "FROM documents) GROUP BY token",
)
def token_rows(spark, sf):
    rows = detect.tokens(texts(spark, sf).select("doc_id", "text"), ["doc_id"])
    # Combine per document first; a frequent token reaches its reducer as few rows.
    per_doc = rows.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("c"))
    return per_doc.groupBy("token").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_docs"))


@query(
    "word_tokens",
    f"SELECT doc_id, len(w) AS n_words, {_digest('w')} AS digest, w[-1] AS last_word FROM "
    f"(SELECT doc_id, {WORDS} AS w FROM documents)",
)
def word_tokens(spark, sf):
    w = texts(spark, sf).select("doc_id", tx.word_tokens(F.col("text")).alias("w"))
    return w.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.md5(F.array_join("w", " ")).alias("digest"),
        F.get("w", F.size("w") - 1).alias("last_word"),
    )


@query(
    "word_offsets",
    f"WITH m AS (SELECT doc_id, {WORDS} AS w, string_split_regex(text, '[\\p{{L}}\\p{{N}}_]+') AS g FROM documents), "
    "p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(list_transform(w, lambda x: length(x))) AS wl, "
    "unnest(list_transform(g[1:len(w)], lambda x: length(x))) AS gl FROM m WHERE len(w) > 0), "
    "o AS (SELECT doc_id, i, wl, sum(gl) OVER (PARTITION BY doc_id ORDER BY i) + sum(wl) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM p) "
    "SELECT doc_id, count(*) AS n_words, CAST(sum((e - wl) * i) AS BIGINT) AS start_checksum, CAST(sum(e) AS BIGINT) AS end_sum FROM o GROUP BY doc_id",
)
def word_offsets(spark, sf):
    rows = detect.words(texts(spark, sf).select("doc_id", "text"), ["doc_id"])
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_words"),
        F.sum(F.col("start").cast("long") * (F.col("pos") + 1)).alias("start_checksum"),
        F.sum("end").alias("end_sum"),
    )


@query(
    "punctuation_and_spaces",
    "SELECT doc_id, len(regexp_extract_all(text, '[^\\p{L}\\p{Nd}_\\t-\\r\\x1c-\\x20\\x85\\p{Z}]')) AS punctuation, "
    "len(regexp_extract_all(text, '[\\t-\\r\\x1c-\\x20\\x85\\p{Z}]+')) AS gaps FROM documents",
)
def punctuation_and_spaces(spark, sf):
    return texts(spark, sf).select(
        "doc_id",
        F.size(tx.class_tokens(F.col("text"), catalog.PUNCTUATION)).cast("long").alias("punctuation"),
        F.size(tx.class_tokens(F.col("text"), catalog.WHITESPACE)).cast("long").alias("gaps"),
    )


_CONTEXT = (
    f"{CHUNK_SQL}, ctx AS (SELECT doc_id, chunk_no, chunk, "
    "coalesce(lag(chunk) OVER w, '') || CASE WHEN lead(chunk) OVER w IS NULL THEN '' ELSE ' ' || lead(chunk) OVER w END AS context "
    "FROM chunk WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_no))"
)


@query("word_chunks", f"WITH {CHUNK_SQL} SELECT doc_id, chunk_no, md5(chunk) AS digest FROM chunk")
def word_chunks(spark, sf):
    rows = detect.chunks(texts(spark, sf).select("doc_id", "text"), ["doc_id"])
    return rows.select("doc_id", "chunk_no", F.md5("chunk").alias("digest"))


@query(
    "chunk_context",
    f"WITH {_CONTEXT} SELECT doc_id, chunk_no, md5(context) AS context_digest, "
    "md5(CASE WHEN context <> '' THEN context || ' ' || chunk ELSE chunk END) AS joined_digest FROM ctx",
)
def chunk_context(spark, sf):
    rows = detect.chunks(texts(spark, sf).select("doc_id", "text"), ["doc_id"])
    joined = F.when(F.col("context") != "", F.concat("context", F.lit(" "), "chunk")).otherwise(F.col("chunk"))
    return rows.select("doc_id", "chunk_no", F.md5("context").alias("context_digest"), F.md5(joined).alias("joined_digest"))


@query(
    "template_markers",
    "SELECT doc_id, array_to_string(regexp_extract_all('[' || upper(regexp_replace(source, '[0-9]', '', 'g')) || '_' || "
    "regexp_replace(source, '[^0-9]', '', 'g') || '] [LANG_' || (doc_id % 10) || '] ' || text, '\\[([A-Z]+_\\d+)\\]', 1), ',') AS markers "
    "FROM documents",
)
def template_markers(spark, sf):
    docs = texts(spark, sf)
    source = F.concat(
        F.lit("["), F.upper(F.regexp_replace("source", "[0-9]", "")), F.lit("_"),
        F.regexp_replace("source", "[^0-9]", ""), F.lit("] [LANG_"), (F.col("doc_id") % 10).cast("string"),
        F.lit("] "), F.col("text"),
    )
    return docs.select("doc_id", F.array_join(tx.template_markers(source), ",").alias("markers"))


@query(
    "demo_tags",
    "WITH tok AS (SELECT doc_id, " + TOKENS + " AS t FROM documents) SELECT doc_id, len(t) AS n, "
    "CASE WHEN len(t) < 2 THEN 0 ELSE 2 END AS n_pii, "
    "CASE WHEN len(t) < 2 THEN array_to_string(list_transform(t, lambda x: 'O'), ' ') ELSE 'B-PERSON I-PERSON' END AS start "
    "FROM tok",
)
def demo_tags(spark, sf):
    t = texts(spark, sf).select("doc_id", lb.demo_tags(tx.ws_tokens(F.col("text"))).alias("d"))
    return t.select(
        "doc_id", F.size("d").cast("long").alias("n"), lb.pii_count(F.col("d")).alias("n_pii"),
        F.array_join(F.slice("d", 1, 2), " ").alias("start"),
    )


_ALIGNED = "(tags || list_transform(range(0, greatest(len(labels) - len(tags), 0)), lambda i: 'O'))[1:len(labels)]"


@query(
    "aligned_labels",
    f"WITH {LABELLED} SELECT doc_id, len(tags) AS n_tags, len(labels) AS n_labels, {_digest(_ALIGNED)} AS digest FROM labelled",
)
def aligned_labels(spark, sf):
    c = corpus(spark, sf)
    return c.select(
        "doc_id", F.size("tags").cast("long").alias("n_tags"), F.size("labels").cast("long").alias("n_labels"),
        F.md5(F.array_join(lb.align(F.col("tags"), F.col("labels")), " ")).alias("digest"),
    )


@query(
    "binary_labels",
    f"WITH {LABELLED} SELECT doc_id, md5(array_to_string(list_transform(labels, lambda x: CASE WHEN x = 'O' THEN '0' ELSE '1' END), '')) AS digest FROM labelled",
)
def binary_labels(spark, sf):
    bits = lb.binary(F.col("labels")).cast("array<string>")
    return corpus(spark, sf).select("doc_id", F.md5(F.array_join(bits, "")).alias("digest"))


@query(
    "class_labels",
    f"WITH {LABELLED} SELECT doc_id, array_to_string((list_transform(labels, lambda x: CASE WHEN starts_with(x, 'B-') THEN 1 "
    "WHEN starts_with(x, 'I-') THEN 2 ELSE 0 END) || list_transform(range(0, 512), lambda i: 0))[1:512], '') AS classes FROM labelled",
)
def class_labels(spark, sf):
    ids = lb.classes(F.col("labels"), 512).cast("array<string>")
    return corpus(spark, sf).select("doc_id", F.array_join(ids, "").alias("classes"))


@query(
    "token_ids",
    "WITH tok AS (SELECT doc_id, " + TOKENS + " AS t FROM documents) SELECT doc_id, array_to_string((list_transform(t[1:512], "
    "lambda x: CAST(('0x' || substr(md5(x), 1, 8)) AS BIGINT) % 1000) || list_transform(range(0, 512), lambda i: 0::BIGINT))[1:512], ' ') AS ids, "
    "array_to_string(list_transform(range(0, 512), lambda i: CASE WHEN i < len(t) THEN 1 ELSE 0 END), '') AS mask FROM tok",
)
def token_ids(spark, sf):
    t = tx.ws_tokens(F.col("text"))
    return texts(spark, sf).select(
        "doc_id",
        F.array_join(lb.token_ids(t, 1000, 512).cast("array<string>"), " ").alias("ids"),
        F.array_join(lb.attention_mask(t, 512).cast("array<string>"), "").alias("mask"),
    )


@query(
    "padded_tokens",
    "WITH tok AS (SELECT doc_id, " + TOKENS + " AS t FROM documents) SELECT doc_id, array_to_string((t || "
    "list_transform(range(0, greatest(512 - len(t), 0)), lambda i: '[PAD]'))[1:512], ' ') AS tokens, repeat('1', 512) AS ones FROM tok",
)
def padded_tokens(spark, sf):
    t = tx.ws_tokens(F.col("text"))
    return texts(spark, sf).select(
        "doc_id", F.array_join(lb.padded_tokens(t, 512), " ").alias("tokens"),
        F.array_join(lb.attention_mask(t, 512, all_ones=True).cast("array<string>"), "").alias("ones"),
    )


@query(
    "label_ids",
    f"WITH {LABELLED}, d AS (SELECT DISTINCT unnest(labels) AS label FROM labelled) "
    "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id FROM d",
)
def label_ids(spark, sf):
    return profile.label_ids(corpus(spark, sf))


@query(
    "tokenised_corpus",
    f"WITH {LABELLED}, ids AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS id FROM "
    "(SELECT DISTINCT unnest(labels) AS label FROM labelled)), "
    "m AS (SELECT map(list(label ORDER BY id), list(id ORDER BY id)) AS m FROM ids) "
    "SELECT md5(array_to_string(list_transform(labels, lambda x: m.m[x]), ' ')) AS labels, "
    "md5(array_to_string((list_transform(t[1:512], lambda x: CAST(('0x' || substr(md5(x), 1, 8)) AS BIGINT) % 30000) || "
    "list_transform(range(0, 512), lambda i: 0::BIGINT))[1:512], ' ')) AS input_ids, "
    "array_to_string(list_transform(range(0, 512), lambda i: CASE WHEN i < len(t) THEN 1 ELSE 0 END), '') AS attention_mask FROM labelled, m",
)
def tokenised_corpus(spark, sf):
    from veilmark.sources.files import tokenised

    c = corpus(spark, sf)
    done = tokenised(c, profile.label_ids(c), max_len=512)
    flat = lambda name, sep: F.array_join(F.col(name).cast("array<string>"), sep).alias(name)
    return done.select(
        F.md5(F.array_join(F.col("labels").cast("array<string>"), " ")).alias("labels"),
        F.md5(flat("input_ids", " ")).alias("input_ids"), flat("attention_mask", ""),
    )


@query(
    "entity_types",
    f"WITH {LABELLED} SELECT entity_type, count(*) AS n FROM (SELECT string_split(unnest(labels || tags), '-')[2] AS entity_type "
    "FROM labelled) WHERE entity_type IS NOT NULL GROUP BY entity_type",
)
def entity_types(spark, sf):
    both = corpus(spark, sf).select(F.explode_outer(F.concat("labels", "tags")).alias("label")).where("label IS NOT NULL")
    return (
        both.select(lb.entity_type(F.col("label")).alias("entity_type"))
        .where("entity_type IS NOT NULL")
        .groupBy("entity_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "character_scalars",
    f"SELECT doc_id, {DIGITS} AS digits, regexp_matches(text, {q(tx.HAS_TITLE_WORD)}) AS title_word, "
    f"regexp_matches(text, {q(tx.HAS_LONG_TITLE_WORD)}) AS long_title_word, "
    f"regexp_matches(text, {q(tx.HAS_CAPS_WORD)}) AS caps_word, regexp_matches(text, {q(tx.TITLE_CASE)}) AS is_title, "
    f"regexp_matches(text, {q(tx.ALL_CAPS)}) AS is_caps, regexp_matches(text, '^\\p{{Lu}}') AS starts_upper, "
    "contains(text, '@') AS has_at, md5(list_last(string_split(text, '@'))) AS after_at, md5(lower(text)) AS lowered FROM documents",
)
def character_scalars(spark, sf):
    t = F.col("text")
    return texts(spark, sf).select(
        "doc_id", tx.digit_count(t).alias("digits"), t.rlike(tx.HAS_TITLE_WORD).alias("title_word"),
        t.rlike(tx.HAS_LONG_TITLE_WORD).alias("long_title_word"), t.rlike(tx.HAS_CAPS_WORD).alias("caps_word"),
        tx.is_title(t).alias("is_title"), tx.is_all_caps(t).alias("is_caps"), tx.starts_upper(t).alias("starts_upper"),
        tx.has_at(t).alias("has_at"), F.md5(F.substring_index(t, "@", -1)).alias("after_at"),
        F.md5(F.lower(t)).alias("lowered"),
    )


@query(
    "hash_uniform",
    f"SELECT doc_id, round({uniform_sql('5', 'doc_id')}, 9) AS u FROM documents",
)
def hash_uniform(spark, sf):
    return texts(spark, sf).select("doc_id", F.round(tx.uniform(F.lit(5), F.col("doc_id")), 9).alias("u"))
