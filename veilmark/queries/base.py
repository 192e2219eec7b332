"""Query registry and the SQL fragments that several checks share."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from veilmark import catalog
from veilmark.functions import text as tx


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} exists")
        REGISTRY[name] = Query(fn, sql)
        return fn

    return register


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# RE2 knows ASCII word borders only. Replacing accented letters by an ASCII word
# character that a pattern cannot match gives it Unicode borders, and keeps
# every offset: 'x' for patterns of digits, '0' for patterns of letters.
_ACCENTED = "[À-ÖØ-öø-ɏ]"


def widened(filler: str, text: str = "text") -> str:
    return text if not filler else f"regexp_replace({text}, {q(_ACCENTED)}, {q(filler)}, 'g')"


LETTER_PATTERNS = {
    "FULLNAME", "NAME", "CITY", "STATE", "GENDER", "JOB_TITLE", "AREA", "ORDINAL_DIRECTION",
}
RAW_PATTERNS = {"EMAIL", "USERNAME"}
UNDERSCORE_PATTERNS = {
    "STREET_ADDRESS", "BITCOIN_ADDRESS", "ETHEREUM_ADDRESS", "IBAN", "BIC", "IPV6", "MAC_ADDRESS",
    "PASSWORD", "COUNTY", "USER_AGENT", "URL", "DEVICE_INFO",
}


def filler(name: str) -> str:
    if name in RAW_PATTERNS:
        return ""
    if name in LETTER_PATTERNS:
        return "0"
    return "_" if name in UNDERSCORE_PATTERNS else "x"


def re2(p: catalog.Pattern) -> str:
    return ("(?i)" if p.ignore_case else "") + p.regex


def raw_spans(
    patterns: Iterable[catalog.Pattern], prefix: str = "", table: str = "documents", text: str = "text",
    ids: str = "doc_id",
) -> str:
    """CTEs ending in ``{prefix}raw``: ids, priority, category, s, e of all matches."""
    ctes, parts = [], []
    for rank, p in enumerate(patterns):
        if p.name in AHEAD:
            continue
        w = widened(filler(p.name), text)
        parts.append(
            f"SELECT {ids}, {rank} AS priority, {q(p.name)} AS category, "
            f"regexp_extract_all(w, {q(re2(p))}) AS m, string_split_regex(w, {q(re2(p))}) AS g "
            f"FROM (SELECT {ids}, {w} AS w FROM {table})"
        )
    ctes.append(f"{prefix}found AS ({' UNION ALL '.join(parts)})")
    ctes.append(
        f"{prefix}piece AS (SELECT {ids}, priority, category, unnest(range(1, len(m) + 1)) AS i, "
        f"unnest(list_transform(m, lambda x: length(x))) AS ml, "
        f"unnest(list_transform(g[1:len(m)], lambda x: length(x))) AS gl FROM {prefix}found WHERE len(m) > 0)"
    )
    win = f"(PARTITION BY {ids}, priority ORDER BY i)"
    ctes.append(
        f"{prefix}raw AS (SELECT {ids}, priority, category, "
        f"CAST(sum(gl) OVER {win} + sum(ml) OVER {win} - ml AS INTEGER) AS s, "
        f"CAST(sum(gl) OVER {win} + sum(ml) OVER {win} AS INTEGER) AS e FROM {prefix}piece)"
    )
    return ", ".join(ctes)


#: Patterns that look ahead, which RE2 cannot; ``names_ahead`` has their matches.
AHEAD = {"FIRSTNAME", "LASTNAME"}


def names_ahead(patterns: Iterable[catalog.Pattern], prefix: str = "") -> str:
    """CTEs ending in ``{prefix}raw_ahead``: the matches of the patterns that look ahead.

    LASTNAME: the character ahead is matched, too, and then left off; no other match can
    begin with it. FIRSTNAME: matched without a look ahead and tested after; where a street
    follows a title and a name, only the letters of the title match.
    """
    by_name = {p.name: (rank, p) for rank, p in enumerate(patterns)}
    case = "(?i)" if by_name["LASTNAME"][1].ignore_case else ""
    space = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
    last = by_name["LASTNAME"][1].regex.removesuffix(r"(?=\s*(?:,|\.|\s|$))")
    last = f"{case}({last})(?:[,.]|{space}|$)"
    first, _, street = by_name["FIRSTNAME"][1].regex.partition("(?!")
    first, street = f"{case}{first}", f"{case}^{street.removesuffix(')')}"
    win = "(PARTITION BY doc_id, name ORDER BY i)"
    return (
        f"{prefix}ahead AS ("
        f"SELECT doc_id, w, 'LASTNAME' AS name, regexp_extract_all(w, {q(last)}) AS m, regexp_extract_all(w, {q(last)}, 1) AS o, string_split_regex(w, {q(last)}) AS g "
        f"FROM (SELECT doc_id, {widened('0')} AS w FROM documents) UNION ALL "
        f"SELECT doc_id, w, 'FIRSTNAME', regexp_extract_all(w, {q(first)}), regexp_extract_all(w, {q(first)}), string_split_regex(w, {q(first)}) "
        f"FROM (SELECT doc_id, {widened('0')} AS w FROM documents)), "
        f"{prefix}ahead_piece AS (SELECT doc_id, name, unnest(range(1, len(m) + 1)) AS i, unnest(o) AS own, "
        f"unnest(list_transform(m, lambda x: length(x))) AS ml, unnest(list_transform(g[1:len(m)], lambda x: length(x))) AS gl, "
        # what follows: the gap behind a match and the next match
        f"unnest(list_transform(range(1, len(m) + 1), lambda k: g[k + 1] || coalesce(m[k + 1], '') || coalesce(g[k + 2], '')[1:1])) AS behind "
        f"FROM {prefix}ahead WHERE len(m) > 0), "
        f"{prefix}ahead_at AS (SELECT *, CAST(sum(gl) OVER {win} + sum(ml) OVER {win} - ml AS INTEGER) AS s FROM {prefix}ahead_piece), "
        f"{prefix}raw_ahead AS ("
        f"SELECT doc_id, {by_name['LASTNAME'][0]} AS priority, name AS category, s, s + length(own) AS e FROM {prefix}ahead_at WHERE name = 'LASTNAME' UNION ALL "
        f"SELECT doc_id, {by_name['FIRSTNAME'][0]}, name, s, s + length(own) FROM {prefix}ahead_at WHERE name = 'FIRSTNAME' AND NOT regexp_matches(behind, {q(street)}) UNION ALL "
        f"SELECT doc_id, {by_name['FIRSTNAME'][0]}, name, s, s + length(regexp_extract(own, '^[A-Za-z]+')) FROM {prefix}ahead_at "
        f"WHERE name = 'FIRSTNAME' AND regexp_matches(behind, {q(street)}) AND regexp_matches(own, {q(case + '^(?:Mr|Ms|Mrs|Dr|Prof)' + chr(92) + '.')}))"
    )


def suppressed(n: int, strict: bool = False, raw: str = "raw", prefix: str = "") -> str:
    """CTEs ending in ``{prefix}kept``: what greedy suppression leaves of ``raw`` (doc_id,
    priority, category, s, e), a round for each of ``n`` priorities. ``held`` has what is
    kept so far as disjoint intervals, so the nearest one to the left decides."""
    ctes = [f"{prefix}held_0 AS MATERIALIZED (SELECT doc_id, s, e FROM {raw} WHERE false)"]
    for k in range(n):
        held, new = f"{prefix}held_{k}", f"{prefix}new_{k}"
        own = f"SELECT doc_id, category, s, e FROM {raw} WHERE priority = {k}"
        if strict:
            free = f"SELECT r.* FROM ({own}) r ASOF LEFT JOIN {held} h ON r.doc_id = h.doc_id AND r.e > h.s WHERE h.e IS NULL OR h.e <= r.s"
            ctes.append(f"{new} AS MATERIALIZED ({free})")
        else:
            left = f"SELECT r.* FROM ({own}) r ASOF LEFT JOIN {held} h ON r.doc_id = h.doc_id AND r.s >= h.s WHERE h.e IS NULL OR h.e < r.s"
            free = f"SELECT r.* FROM ({left}) r ASOF LEFT JOIN {held} h ON r.doc_id = h.doc_id AND r.e >= h.s WHERE h.e IS NULL OR h.e < r.e"
            ordered = "(PARTITION BY doc_id ORDER BY s)"
            ctes.append(
                f"{new} AS MATERIALIZED (SELECT doc_id, category, s, e FROM ("
                f"SELECT *, row_number() OVER (PARTITION BY doc_id, chain ORDER BY s) AS place FROM ("
                f"SELECT *, sum(CASE WHEN s = before THEN 0 ELSE 1 END) OVER {ordered} AS chain FROM ("
                f"SELECT *, lag(e) OVER {ordered} AS before FROM ({free})))) WHERE place % 2 = 1)"
            )
        ctes.append(
            f"{prefix}held_{k + 1} AS MATERIALIZED (SELECT doc_id, s, e FROM {new} UNION ALL SELECT h.doc_id, h.s, h.e FROM {held} h "
            f"ASOF LEFT JOIN {new} n ON h.doc_id = n.doc_id AND h.s >= n.s WHERE n.e IS NULL OR n.e <= h.s)"
        )
    ctes.append(f"{prefix}kept AS (" + " UNION ALL ".join(f"SELECT * FROM {prefix}new_{k}" for k in range(n)) + ")")
    return ", ".join(ctes)


def extended_spans(ignore_case: bool, strict: bool) -> str:
    """CTEs ending in ``kept``: the spans of the extended catalog after suppression."""
    patterns = catalog.extended(ignore_case)
    both = "x_raw AS MATERIALIZED (SELECT doc_id, priority, category, s, e FROM raw UNION ALL SELECT doc_id, priority, category, s, e FROM raw_ahead)"
    return f"{raw_spans(patterns)}, {names_ahead(patterns)}, {both}, {suppressed(len(patterns), strict, 'x_raw')}"


def merged_spans(prefix: str = "", ids: str = "doc_id") -> str:
    """CTEs ending in ``{prefix}merged`` from ``{prefix}raw``: ids, category, s, e."""
    order = f"PARTITION BY {ids} ORDER BY s, priority, e"
    return (
        f"{prefix}reach AS (SELECT *, max(e) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r "
        f"FROM {prefix}raw), "
        f"{prefix}isle AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r THEN 1 ELSE 0 END) OVER ({order}) AS isl "
        f"FROM {prefix}reach), "
        f"{prefix}merged AS (SELECT {ids}, arg_min(category, s * 100 + priority) AS category, min(s) AS s, max(e) AS e "
        f"FROM {prefix}isle GROUP BY {ids}, isl)"
    )


CORE_MERGED = raw_spans(catalog.CORE) + ", " + merged_spans()

TOKENS = f"list_filter(string_split_regex(text, {q(tx.WS + '+')}), lambda x: x <> '')"
WORDS = r"regexp_extract_all(text, '[\p{L}\p{N}_]+')"
DIGITS = f"(length(text) - length(regexp_replace(text, {q(tx.DIGIT)}, '', 'g')))"


def tokens_of(text: str) -> str:
    return TOKENS.replace("(text,", f"({text},")


def tag_case(t: str) -> str:
    """The token rules as SQL over an expression."""
    return (
        f"CASE WHEN regexp_matches({t}, '^\\p{{Lu}}') AND length({t}) > 1 THEN "
        f"CASE WHEN regexp_matches({t}, {q(tx.ALL_CAPS)}) THEN 'O' ELSE 'B-PERSON' END "
        f"WHEN contains({t}, '@') AND contains({t}, '.') THEN 'B-EMAIL' "
        f"WHEN regexp_matches({t}, {q('^' + catalog.TAGGER_PHONE)}) THEN 'B-PHONE' "
        f"WHEN regexp_matches({t}, {q('^' + catalog.TAGGER_SSN)}) THEN 'B-SSN' ELSE 'O' END"
    )


def uniform_sql(*parts: str) -> str:
    joined = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST(('0x' || substr(md5({joined}), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE)"
