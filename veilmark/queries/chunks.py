"""Chunks scored by a network, alone and together with the core patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark.functions import text as tx
from veilmark.operators import detect
from veilmark.queries.base import CORE_MERGED, q, query
from veilmark.queries.detection import CHUNK_MODEL, _chunk_category_sql, mlp_ctes
from veilmark.queries.features import SQL_SETS, feature_cte
from veilmark.queries.tokens import _CONTEXT
from veilmark.sources.tables import texts

_WS = q(tx.WS + "+")
_OUT = f"h{len(CHUNK_MODEL.layers) - 1}"
_FEATURES = ", ".join(f"({name})::DOUBLE" for name in SQL_SETS["final"])
# Places of the words: what a split leaves, and the gaps between.
_PLACES = (
    f"tk AS (SELECT doc_id, string_split_regex(text, {_WS}) AS t, regexp_extract_all(text, {_WS}) || [''] AS g FROM documents), "
    "tu AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS i, unnest(list_transform(t, lambda x: length(x))) AS tl, "
    "unnest(list_transform(g, lambda x: length(x))) AS gl FROM tk), "
    "ts AS (SELECT doc_id, i, tl, sum(tl + gl) OVER (PARTITION BY doc_id ORDER BY i) - tl - gl AS s FROM tu), "
    "tn AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k, count(*) OVER (PARTITION BY doc_id) AS n, s, s + tl AS e "
    "FROM ts WHERE tl > 0)"
)
_SCORED = (
    f"{_CONTEXT}, src AS (SELECT doc_id, chunk_no, chunk, CASE WHEN context <> '' THEN context || ' ' || chunk ELSE chunk END AS text FROM ctx), "
    f"{feature_cte('final', 'src', 'doc_id, chunk_no, chunk')}, "
    f"x AS (SELECT doc_id, chunk_no, chunk, [{_FEATURES}] AS x FROM feat), {mlp_ctes(CHUNK_MODEL, 'x', 'doc_id, chunk_no, chunk', 'x')}, "
    f"p AS (SELECT doc_id, chunk_no, {_chunk_category_sql()} AS category, 1 / (1 + exp({_OUT}[1] - {_OUT}[2])) AS p FROM c_{_OUT}), "
    f"{_PLACES}, "
    "hit AS (SELECT p.doc_id, category, p, 'model' AS source, a.s, b.e FROM p JOIN tn a ON a.doc_id = p.doc_id AND a.k = chunk_no * 10 "
    "JOIN tn b ON b.doc_id = p.doc_id AND b.k = least(chunk_no * 10 + 50, a.n) - 1 WHERE p > 0.5)"
)


def _united(name: str, source: str) -> str:
    """CTEs: overlapping or touching spans of ``source`` as one, after the most confident."""
    order = "PARTITION BY doc_id ORDER BY s, e"
    return (
        f"{name}_r AS (SELECT *, max(e) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM {source}), "
        f"{name}_i AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r THEN 1 ELSE 0 END) OVER ({order}) AS isl FROM {name}_r), "
        f"{name} AS (SELECT doc_id, list(category ORDER BY p DESC, s, e)[1] AS category, list(source ORDER BY p DESC, s, e)[1] AS source, "
        f"max(p) AS p, min(s) AS s, max(e) AS e FROM {name}_i GROUP BY doc_id, isl)"
    )


_SHOWN = "doc_id, category, CAST(s AS INTEGER) AS span_start, CAST(e AS INTEGER) AS span_end, round(p, 6) AS confidence"
_CHUNKS = f"WITH {_SCORED}, {_united('one', 'hit')}"
_BOTH = (
    f"{_CHUNKS}, {CORE_MERGED}, both_ AS (SELECT doc_id, category, source, p, s, e, 0 AS o FROM one "
    "UNION ALL SELECT doc_id, category, 'regex', 1.0::DOUBLE, s, e, 1 FROM merged), "
    "once AS (SELECT * FROM both_ QUALIFY row_number() OVER (PARTITION BY doc_id, s, e ORDER BY o) = 1)"
)


def _shown(found):
    return detect.to_rows(found, ["doc_id"], text=None).select(
        "doc_id", "category", "span_start", "span_end", "source", F.round("confidence", 6).alias("confidence")
    )


@query("model_chunk_spans", f"{_CHUNKS} SELECT {_SHOWN} FROM one")
def model_chunk_spans(spark, sf):
    return _shown(detect.model_chunk_spans(texts(spark, sf).select("doc_id", "text"), CHUNK_MODEL)).drop("source")


@query("hybrid_spans", f"{_BOTH}, {_united('all_', 'once')} SELECT {_SHOWN}, source FROM all_")
def hybrid_spans(spark, sf):
    return _shown(detect.detect_hybrid(texts(spark, sf).select("doc_id", "text"), CHUNK_MODEL))


@query("hybrid_spans_unmerged", f"{_BOTH} SELECT {_SHOWN}, source FROM once")
def hybrid_spans_unmerged(spark, sf):
    """Model and core spans as found, one for each exact position."""
    return _shown(detect.detect_hybrid(texts(spark, sf).select("doc_id", "text"), CHUNK_MODEL, merged=False))
