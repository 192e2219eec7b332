"""Detection over texts with planted values, so that every pattern meets data."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import labels as lb
from veilmark.functions import spans as sp
from veilmark.functions import text as tx
from veilmark.operators import detect
from veilmark.queries.base import filler, merged_spans, q, query, raw_spans, re2, tag_case, tokens_of, widened
from veilmark.sources.tables import texts

# One of these lines follows each text, by its id.
LINES = (
    "Ring 555-123-4567 or (555)987.6543, no. 123-45-6789, on 12/31/2020 or 2021-05-06.",
    "Paid with 4111 1111 1111 1111 from 10.1.2.3, receipt to jo.do@example.com",
    "Dr. Ada Novak lives at 12 Canal Street, New York NY 10001-2345",
    "Account 123456789, IBAN DE89370400440532013000, bank DEUTDEFF500",
    "Coins to 1BvBMSEYstWetqTFn5Au4m4GFg7xJaNVN2 or 0x52908400098527886E0F7030069857D2E4169EE7",
    "Hosts 2001:db8:0:0:0:0:2:1 and 00:1A:2B:3C:4D:5E for x@some_user password: hunter2secret",
    "Female Engineer, Downtown, at 12.345678, -98.765432 North of County Kerry",
    "Mozilla/5.0 (X) AppleWebKit/537.36 (K) Chrome/120.0.0.0 at https://www.example.com/a on iPhone 15",
    "",
)
_SQL = (
    f"planted AS (SELECT doc_id, lang, text || chr(10) || ([{', '.join(q(s) for s in LINES)}])[doc_id % {len(LINES)} + 1] AS text FROM documents)"
)


def planted(spark, sf):
    line = F.get(F.array(*[F.lit(s) for s in LINES]), (F.col("doc_id") % len(LINES)).cast("int"))
    return texts(spark, sf).select("doc_id", "lang", F.concat("text", F.lit("\n"), line).alias("text"))


def _spans(patterns) -> str:
    return f"WITH {_SQL}, {raw_spans(patterns, table='planted')}"


_SPANS = "SELECT doc_id, category, s AS span_start, e AS span_end FROM"


@query("planted_spans_core", f"{_spans(catalog.CORE)}, {merged_spans()} {_SPANS} merged")
def planted_spans_core(spark, sf):
    found = detect.detect_core(planted(spark, sf))
    return detect.to_rows(found, ["doc_id"], text=None).select("doc_id", "category", "span_start", "span_end")


@query("planted_spans_truth", f"{_spans(catalog.TRUTH)} {_SPANS} raw")
def planted_spans_truth(spark, sf):
    found = detect.detect_truth(planted(spark, sf))
    return detect.to_rows(found, ["doc_id"], text=None).select("doc_id", "category", "span_start", "span_end")


_ABLE = [p for p in catalog.extended() if p.name not in ("FIRSTNAME", "LASTNAME")]
_PATTERNS = " UNION ALL ".join(
    f"SELECT {q(p.name)} AS pattern, count_if(len(m) > 0) AS n_docs, CAST(coalesce(sum(len(m)), 0) AS BIGINT) AS n_matches, "
    f"CAST(coalesce(sum(list_sum(list_transform(m, lambda x: length(x)))), 0) AS BIGINT) AS n_chars "
    f"FROM (SELECT regexp_extract_all({widened(filler(p.name))}, {q(re2(p))}) AS m FROM planted)"
    for p in _ABLE
)


@query("planted_pattern_matches", f"WITH {_SQL} {_PATTERNS}")
def planted_pattern_matches(spark, sf):
    """Every pattern that needs no look-ahead, each with matches."""
    rows = planted(spark, sf).select(F.explode_outer(sp.lengths_of_all(F.col("text"), _ABLE)).alias("x")).select("x.*")
    chars = F.aggregate(F.filter("lens", lambda _, i: i % 2 == 1), F.lit(0).cast("long"), lambda a, n: a + n)
    return rows.groupBy("pattern").agg(
        F.count_if(F.size("lens") > 1).alias("n_docs"), F.sum(F.floor(F.size("lens") / 2)).alias("n_matches"), F.sum(chars).alias("n_chars")
    )


@query(
    "planted_tags",
    f"WITH {_SQL} SELECT lang, tag, count(*) AS n_tokens FROM (SELECT lang, {tag_case('t')} AS tag FROM "
    f"(SELECT lang, unnest({tokens_of('text')}) AS t FROM planted)) GROUP BY lang, tag",
)
def planted_tags(spark, sf):
    tokens = planted(spark, sf).select("lang", F.explode_outer(tx.ws_tokens(F.col("text"))).alias("t")).where("t IS NOT NULL")
    return tokens.groupBy("lang", lb.tag(F.col("t")).alias("tag")).agg(F.count(F.lit(1)).alias("n_tokens"))
