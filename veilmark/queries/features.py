"""Feature, weak-label and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import features as ft
from veilmark.functions.arrays import let
from veilmark.functions import text as tx
from veilmark.operators import detect, evaluate
from veilmark.operators.model import Model, score
from veilmark.queries.base import DIGITS, TOKENS, q, query
from veilmark.queries.detection import mlp_ctes
from veilmark.queries.tokens import _CONTEXT
from veilmark.sources.shared import cut
from veilmark.sources.tables import texts

_RATIO = f"({DIGITS}::DOUBLE / greatest(length(text), 1))"
_N = f"len({TOKENS})"


def _flag(test: str) -> str:
    return f"CASE WHEN {test} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def _len(by: int, cap: float | None = None) -> str:
    value = f"length(text)::DOUBLE / {by}"
    return value if cap is None else f"least({value}, {cap}::DOUBLE)"


def _match(pattern: str) -> str:
    return _flag(f"regexp_matches(text, {q(pattern)})")


_AT = _flag("contains(text, '@')")
_DOT_AT = _flag("contains(text, '@') AND contains(text, '.')")
_TITLE = _match(tx.HAS_TITLE_WORD)
_DOT_AFTER = _flag("contains(text, '@') AND contains(list_last(string_split(text, '@')), '.')")
_WEB = _flag("contains(lower(text), '.com') OR contains(lower(text), '.net') OR contains(lower(text), '.org')")

SQL_SETS = {
    "final": {
        "length": _len(50, 2.0), "has_at": _AT, "dot_after_at": _DOT_AFTER, "digit_ratio": _RATIO,
        "has_title": _TITLE, "words": f"{_N}::DOUBLE / 20",
    },
    "simple": {
        "length": _len(100), "has_at": _AT, "has_dot": _DOT_AT, "digit_ratio": _RATIO, "has_title": _TITLE,
        "words": f"{_N}::DOUBLE / 10", "has_hyphen": _flag("contains(text, '-')"),
        "has_parentheses": _flag("contains(text, '(') AND contains(text, ')')"),
    },
    "proper": {
        "length": _len(100, 1.0), "has_at": _AT, "web_domain": _WEB, "digit_ratio": _RATIO,
        "phone_like": _flag(f"{DIGITS} >= 10 AND regexp_matches(text, '[-()+]')"), "has_title": _TITLE,
        "honorific": _match(tx.has_word(catalog.HONORIFICS)), "street": _match(tx.has_word(catalog.STREET_WORDS)),
    },
    "improved": {
        "length": _len(50, 2.0), "has_at": _AT, "is_email": _match(catalog.SEARCH_EMAIL),
        "has_phone": _match(catalog.SEARCH_PHONE), "digit_ratio": _RATIO, "many_digits": _flag(f"{_RATIO} > 0.3"),
        "has_title": _match(tx.HAS_LONG_TITLE_WORD), "honorific": _match(tx.has_word(catalog.HONORIFICS)),
        "street": _match(tx.has_word(catalog.STREET_WORDS_LONG)), "special": _match("[#$%&*]"),
        "words": f"{_N}::DOUBLE / 10", "has_caps": _match(tx.HAS_CAPS_WORD),
    },
    "tiny": {
        "length": _len(100, 1.0), "has_digit": _flag(f"{DIGITS} > 0"), "has_at": _AT, "has_dot": _DOT_AT,
    },
    "check": {
        "length": _len(100, 1.0), "has_at": _AT, "has_dot": _DOT_AT, "digit_ratio": _RATIO, "has_title": _TITLE,
    },
}

SQL_LABELS = {
    "final": "(has_at > 0.5 AND dot_after_at > 0.5) OR digit_ratio > 0.3",
    "simple": "(has_at > 0.5 AND has_dot > 0.5) OR digit_ratio > 0.4 OR (has_title > 0.5 AND digit_ratio > 0.2)",
    "proper": "(has_at > 0.5 AND web_domain > 0.5) OR phone_like > 0.5 OR (has_title > 0.5 AND n_tokens >= 2 AND digit_ratio > 0.3)",
    "improved": "is_email > 0.5 OR has_phone > 0.5 OR (has_title > 0.5 AND many_digits > 0.5) OR (honorific > 0.5 AND has_title > 0.5)",
    "tiny": "has_digit > 0.5 AND has_at > 0.5 AND has_dot > 0.5",
    "check": "(has_at > 0.5 AND has_dot > 0.5) OR digit_ratio > 0.3",
}


def feature_cte(name: str, table: str = "documents", ids: str = "doc_id", out: str = "feat") -> str:
    columns = ", ".join(f"{e} AS {n}" for n, e in SQL_SETS[name].items())
    return f"{out} AS (SELECT {ids}, {columns}, {_N} AS n_tokens FROM {table})"


def _set_query(name: str):
    rounded = ", ".join(f"round({n}, 9) AS {n}" for n in SQL_SETS[name])
    sql = (
        f"WITH {feature_cte(name)} SELECT doc_id, {rounded}, "
        f"CASE WHEN {SQL_LABELS[name]} THEN 1 ELSE 0 END AS label FROM feat"
    )

    @query(f"features_{name}", sql)
    def run(spark, sf):
        wide = ft.featurize(texts(spark, sf).select("doc_id", "text"), "text", name)
        return wide.select("doc_id", *[F.round(n, 9).alias(n) for n in ft.names(name)], "label")

    return run


for _name in SQL_SETS:
    _set_query(_name)

_WORD_DIGITS = f"((length(w) - length(regexp_replace(w, {q(tx.DIGIT)}, '', 'g')))::DOUBLE / length(w))"


@query(
    "features_word",
    "SELECT doc_id, round(avg(least(length(w)::DOUBLE / 10, 2.0::DOUBLE)), 6) AS length, "
    "0.0::DOUBLE AS has_at, 0.0::DOUBLE AS has_dot, "
    f"round(avg({_WORD_DIGITS}), 6) AS digit_ratio, round(avg(CASE WHEN regexp_matches(w, '^\\p{{Lu}}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS first_upper, "
    "round(avg(0.1::DOUBLE), 6) AS words FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS w FROM documents) GROUP BY doc_id",
)
def features_word(spark, sf):
    """Word features, averaged per document."""
    words = texts(spark, sf).select("doc_id", F.explode_outer(tx.word_tokens(F.col("text"))).alias("w")).where("w IS NOT NULL")
    f = ft.word(F.col("w"))
    return words.groupBy("doc_id").agg(*[F.round(F.avg(c), 6).alias(n) for n, c in f.items()])


def _context_sql() -> str:
    joined = "CASE WHEN context <> '' THEN context || ' ' || chunk ELSE chunk END"
    rounded = ", ".join(f"round({n}, 9) AS {n}" for n in SQL_SETS["final"])
    return (
        f"WITH {_CONTEXT}, src AS (SELECT doc_id, chunk_no, {joined} AS text FROM ctx), "
        f"{feature_cte('final', 'src', 'doc_id, chunk_no')} SELECT doc_id, chunk_no, {rounded} FROM feat"
    )


@query("features_in_context", _context_sql())
def features_in_context(spark, sf):
    rows = detect.chunks(texts(spark, sf).select("doc_id", "text"), ["doc_id"], places=False)
    f = ft.in_context(F.col("chunk"), F.col("context"))
    return rows.select("doc_id", "chunk_no", *[F.round(c, 9).alias(n) for n, c in f.items()])


def _scaled_sql() -> str:
    names = list(SQL_SETS["final"])
    stats = ", ".join(
        f"avg({n}) AS {n}_m, CASE WHEN stddev_pop({n}) > 0 THEN stddev_pop({n}) ELSE 1.0 END AS {n}_s" for n in names
    )
    scaled = ", ".join(f"round(({n} - {n}_m) / {n}_s, 6) AS {n}" for n in names)
    return f"WITH {feature_cte('final')}, st AS (SELECT {stats} FROM feat) SELECT doc_id, {scaled} FROM feat, st"


@query("features_standardised", _scaled_sql())
def features_standardised(spark, sf):
    wide = ft.featurize(texts(spark, sf).select("doc_id", "text"))
    names = ft.names("final")
    # Fitting and scaling read the features twice, but the texts once.
    scaled = ft.standardise(cut(wide.select("doc_id", *names), "features"), names)
    return scaled.select("doc_id", *[F.round(n, 6).alias(n) for n in names])


@query(
    "weak_label_weights",
    f"WITH {feature_cte('final')}, l AS (SELECT CASE WHEN {SQL_LABELS['final']} THEN 1 ELSE 0 END AS y FROM feat) "
    "SELECT count_if(y = 0) AS n0, count_if(y = 1) AS n1, 1.0::DOUBLE AS weight0, "
    "round(CASE WHEN count_if(y = 1) > 0 THEN count(*) / (2.0::DOUBLE * count_if(y = 1)) ELSE 0 END, 6) AS weight1 FROM l",
)
def weak_label_weights(spark, sf):
    wide = ft.featurize(texts(spark, sf).select("doc_id", "text"))
    return evaluate.class_weights(wide, "label").withColumn("weight1", F.round("weight1", 6))


SCORER = Model.by_rule([6, 8, 4, 2], 1.8)
_LOGITS = (
    f"{feature_cte('final')}, x AS (SELECT doc_id, CASE WHEN {SQL_LABELS['final']} THEN 1 ELSE 0 END AS y, "
    f"[{', '.join(SQL_SETS['final'])}] AS x FROM feat), {mlp_ctes(SCORER, 'x', 'doc_id, y', 'x')}, "
    "z AS (SELECT doc_id, y, h2 AS z FROM c_h2)"
)


@query(
    "model_scores",
    f"WITH {_LOGITS}, p AS (SELECT doc_id, y, z, 1 / (1 + exp(z[1] - z[2])) AS p FROM z) SELECT doc_id, "
    "CASE WHEN z[2] > z[1] THEN 1 ELSE 0 END AS pred, round(p, 6) AS prob, "
    "CASE WHEN p >= 0.8 THEN 'HIGH' WHEN p >= 0.6 THEN 'MEDIUM' ELSE 'LOW' END AS band FROM p",
)
def model_scores(spark, sf):
    from veilmark.functions.spans import band

    wide = ft.featurize(texts(spark, sf).select("doc_id", "text"))
    scored = score(wide.select("doc_id", ft.vector(ft.names("final")).alias("features")), SCORER)
    return scored.select("doc_id", "pred", F.round("prob", 6).alias("prob"), band(F.col("prob")).alias("band"))


_CE = "(greatest(z[1], z[2]) + ln(exp(z[1] - greatest(z[1], z[2])) + exp(z[2] - greatest(z[1], z[2]))) - CASE WHEN y = 1 THEN z[2] ELSE z[1] END)"


@query(
    "losses",
    f"WITH {_LOGITS} SELECT round(avg({_CE}), 6) AS cross_entropy, "
    f"round(avg({_CE} * CASE WHEN y = 1 THEN 2.5::DOUBLE ELSE 1.0::DOUBLE END), 6) AS weighted, "
    "round(avg((greatest(z[2], 0) - z[2] * y + ln(1 + exp(-abs(z[2])))) * CASE WHEN y = 1 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END), 6) AS sigmoid FROM z",
)
def losses(spark, sf):
    """Mean of three losses; logits come from the same network as SQL-style columns."""
    wide = ft.featurize(texts(spark, sf).select("doc_id", "text"))
    logits = _logit_columns(SCORER, [F.col(n) for n in ft.names("final")])
    z = wide.select("label", F.array(*logits).alias("z"))
    return z.agg(
        F.round(F.avg(evaluate.cross_entropy(F.col("z"), F.col("label"))), 6).alias("cross_entropy"),
        F.round(F.avg(evaluate.weighted_cross_entropy(F.col("z"), F.col("label"), (1.0, 2.5))), 6).alias("weighted"),
        F.round(F.avg(evaluate.weighted_sigmoid(F.col("z"), F.col("label"), 3.0)), 6).alias("sigmoid"),
    )


def _layer_of(layer, k):
    return lambda v: layer(v, k)


def _logit_columns(model: Model, inputs: list) -> list:
    def layer(v, k):
        w, b = model.layers[k]
        outs = []
        for j in range(w.shape[1]):
            z = sum((F.get(v, F.lit(i)) * float(w[i, j]) for i in range(w.shape[0])), F.lit(float(b[j])))
            outs.append(F.tanh(z) if k < len(model.layers) - 1 else z)
        return F.array(*outs)

    x = F.array(*inputs)
    for k in range(len(model.layers)):
        x = let(x, _layer_of(layer, k))
    return [F.get(x, F.lit(0)), F.get(x, F.lit(1))]
