"""Corpus preparation and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import labels as lb
from veilmark.functions import text as tx
from veilmark.operators import order, profile
from veilmark.queries.base import TOKENS, q, query
from veilmark.queries.tokens import LABELLED, corpus
from veilmark.sources import files
from veilmark.sources.tables import read, texts


def _rank(table: str, key: str, seed: int = 42, extra: str = "") -> str:
    return (
        f"(SELECT *, row_number() OVER (ORDER BY md5('{seed}|' || {extra}CAST({key} AS VARCHAR))) - 1 AS position, "
        f"count(*) OVER () AS n FROM {table})"
    )


_SPLIT = (
    "CASE WHEN position < floor(n * 0.7::DOUBLE) THEN 'train' "
    "WHEN position < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END"
)


@query(
    "corpus_prepared",
    f"WITH {LABELLED} SELECT md5(regexp_replace(text, {q(f'^{tx.WS}+|{tx.WS}+$')}, '', 'g')) AS text_digest, "
    "len(labels) AS n_labels, md5(array_to_string(labels, ' ')) AS label_digest FROM labelled",
)
def corpus_prepared(spark, sf):
    """Raw columns mapped, text stripped, label literals parsed."""
    raw = corpus(spark, sf).select(
        F.col("text").alias(files.RAW_TEXT), lb.render(F.col("labels")).alias(files.RAW_LABELS), "doc_id"
    )
    done = files.clean_corpus(files.map_corpus(raw))
    return done.select(
        F.md5("text").alias("text_digest"), F.size("labels").cast("long").alias("n_labels"),
        F.md5(F.array_join("labels", " ")).alias("label_digest"),
    )


@query("sample_exact", "SELECT doc_id FROM documents ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)) LIMIT 100")
def sample_exact(spark, sf):
    return order.sample_rows(read(spark, sf, "documents").select("doc_id"), ["doc_id"], 100)


@query("sample_exact_large", f"SELECT o_orderkey, o_totalprice FROM {_rank('orders', 'o_orderkey')} WHERE position < 5000")
def sample_exact_large(spark, sf):
    return order.sample_rows(read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 5000)


@query("split_shuffled", f"SELECT doc_id, position, {_SPLIT} AS split FROM {_rank('documents', 'doc_id')}")
def split_shuffled(spark, sf):
    return order.shuffled_split(read(spark, sf, "documents").select("doc_id"), ["doc_id"])


@query(
    "split_ordered",
    "SELECT o_orderkey, position, CASE WHEN position < floor(n * 0.8::DOUBLE) THEN 'train' "
    "WHEN position < floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM "
    "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position, count(*) OVER () AS n FROM orders)",
)
def split_ordered(spark, sf):
    return order.ordered_split(read(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@query(
    "split_holdout",
    "SELECT split, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM (SELECT o_orderkey, "
    "CASE WHEN row_number() OVER (ORDER BY o_orderkey) - 1 < floor(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'val' END AS split "
    "FROM orders) GROUP BY split",
)
def split_holdout(spark, sf):
    rows = order.ordered_split(read(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], (0.8, 0.2), ("train", "val"))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


_EPS = ", ".join(f"({e}::DOUBLE)" for e in catalog.EPSILONS)


@query(
    "sample_by_budget",
    f"SELECT epsilon, count(*) AS n_train, count_if(position < floor(floor(n * least(1, epsilon / 8)) * 0.2::DOUBLE)) AS n_val, "
    f"CAST(sum(doc_id) AS BIGINT) AS id_sum FROM {_rank('documents', 'doc_id')}, (VALUES {_EPS}) AS b(epsilon) "
    "WHERE position < floor(n * least(1, epsilon / 8)) GROUP BY epsilon",
)
def sample_by_budget(spark, sf):
    """Sample sizes n * min(1, epsilon / 8), validation a fifth of it."""
    docs = read(spark, sf, "documents").select("doc_id")
    placed = order.hashed_position(docs, order.shuffle_key(42, F.col("doc_id")))
    grid = placed.withColumn("epsilon", F.explode(F.array(*[F.lit(e) for e in catalog.EPSILONS])))
    size = F.floor(F.col("n_rows") * F.least(F.lit(1.0), F.col("epsilon") / 8.0))
    return grid.where(F.col("position") < size).groupBy("epsilon").agg(
        F.count(F.lit(1)).alias("n_train"),
        F.count_if(F.col("position") < F.floor(size * 0.2)).alias("n_val"),
        F.sum("doc_id").alias("id_sum"),
    )


@query(
    "mini_batches",
    "SELECT batch_id, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM (SELECT o_orderkey, "
    f"CAST(floor(position / 32) AS BIGINT) AS batch_id FROM {_rank('orders', 'o_orderkey', extra=chr(39) + '3|' + chr(39) + ' || ')}) GROUP BY batch_id",
)
def mini_batches(spark, sf):
    rows = order.batches(read(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 32, epoch=3)
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query(
    "sample_preview",
    "SELECT doc_id, substring(text, 1, 50) || '...' AS preview FROM documents ORDER BY doc_id LIMIT 5",
)
def sample_preview(spark, sf):
    """Display report: first five rows, first fifty characters."""
    return profile.preview(read(spark, sf, "documents").select("doc_id", "text"), ["doc_id"]).drop("text")


# -- profiles -----------------------------------------------------------------------


def _lengths_sql(by: str = "") -> str:
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {head}count(*) AS n_rows, round(avg(length(text)), 6) AS chars_mean, min(length(text)) AS chars_min, "
        "max(length(text)) AS chars_max, median(length(text)) AS chars_median, "
        f"round(stddev_samp(length(text)), 6) AS chars_std, round(avg(len({TOKENS})), 6) AS tokens_mean FROM documents{tail}"
    )


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("text_lengths", _lengths_sql())
def text_lengths(spark, sf):
    return _rounded(profile.lengths(texts(spark, sf).select("text")), "chars_mean", "chars_std", "tokens_mean")


@query("text_lengths_by_language", _lengths_sql("lang"))
def text_lengths_by_language(spark, sf):
    rows = profile.lengths(texts(spark, sf).select("lang", "text"), by=["lang"])
    return _rounded(rows, "chars_mean", "chars_std", "tokens_mean")


_PII_N = "len(list_filter(labels, lambda x: x <> 'O'))"
_PII_COUNTS = (
    f"count(*) AS n_rows, CAST(sum({_PII_N}) AS BIGINT) AS total_pii, count_if({_PII_N} > 0) AS rows_with_pii, "
    f"round(sum({_PII_N})::DOUBLE / count(*), 6) AS pii_per_row, round(count_if({_PII_N} > 0) * 100.0::DOUBLE / count(*), 6) AS pii_row_percent"
)


@query("pii_label_counts", f"WITH {LABELLED} SELECT {_PII_COUNTS} FROM labelled")
def pii_label_counts(spark, sf):
    return _rounded(profile.pii_counts(corpus(spark, sf)), "pii_per_row", "pii_row_percent")


@query(
    "pii_counts_by_split",
    f"WITH {LABELLED}, p AS (SELECT doc_id, {_SPLIT} AS split FROM {_rank('documents', 'doc_id')}) "
    f"SELECT split, {_PII_COUNTS} FROM labelled JOIN p USING (doc_id) GROUP BY split",
)
def pii_counts_by_split(spark, sf):
    counted = corpus(spark, sf).select("doc_id", lb.pii_count(F.col("labels")).alias("n"))
    rows = order.shuffled_split(counted, ["doc_id"])
    return _rounded(profile.pii_counts(rows, by=["split"], count="n"), "pii_per_row", "pii_row_percent")


@query(
    "pii_types",
    f"WITH {LABELLED}, e AS (SELECT unnest(labels) AS x FROM labelled), f AS (SELECT x FROM e WHERE x <> 'O') "
    "SELECT string_split(x, '-')[2] AS pii_type, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM f), 6) AS percent "
    "FROM f WHERE contains(x, '-') GROUP BY 1",
)
def pii_types(spark, sf):
    return _rounded(profile.pii_types(corpus(spark, sf)), "percent")


@query(
    "label_distribution",
    f"WITH {LABELLED} SELECT label, count(*) AS n FROM (SELECT unnest(labels) AS label FROM labelled) GROUP BY label",
)
def label_distribution(spark, sf):
    return profile.label_distribution(corpus(spark, sf))


@query(
    "label_summary",
    f"WITH {LABELLED}, e AS (SELECT unnest(labels) AS x FROM labelled) SELECT "
    "(SELECT count(DISTINCT x) FROM e) AS unique_labels, (SELECT count_if(x <> 'O') FROM e) AS pii_tokens, "
    "(SELECT count_if(x = 'O') FROM e) AS other_tokens, "
    "(SELECT string_agg(DISTINCT string_split(x, '-')[2], ',' ORDER BY string_split(x, '-')[2]) FROM e WHERE x <> 'O') AS entity_types, "
    "(SELECT round(count_if(x <> 'O')::DOUBLE / count(*), 6) FROM e) AS pii_ratio, "
    "round(avg(len(labels)), 6) AS labels_mean, round(stddev_samp(len(labels)), 6) AS labels_std FROM labelled",
)
def label_summary(spark, sf):
    row = _rounded(profile.label_summary(corpus(spark, sf)), "pii_ratio", "labels_mean", "labels_std")
    return row.withColumn("entity_types", F.array_join("entity_types", ","))


def _missing_sql() -> str:
    columns = ("doc_id", "text", "lang", "source", "n_chars")
    types = {"doc_id": "bigint", "n_chars": "bigint"}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{types.get(c, 'string')}' AS dtype, count(*) - count({c}) AS n_missing, "
        f"count(*) = count({c}) AS complete, count({c}) > 0 AS has_values FROM documents"
        for c in columns
    )


@query("missing_values", _missing_sql())
def missing_values(spark, sf):
    return profile.missing(read(spark, sf, "documents"))
