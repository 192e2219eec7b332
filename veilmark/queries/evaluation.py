"""Evaluation queries: weak labels and tags against given labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import features as ft
from veilmark.functions import labels as lb
from veilmark.functions import text as tx
from veilmark.operators import evaluate, order
from veilmark.queries.base import query, uniform_sql
from veilmark.queries.features import SQL_LABELS, SQL_SETS, feature_cte
from veilmark.queries.prep import _SPLIT, _rank, _rounded
from veilmark.queries.tokens import _ALIGNED, LABELLED, corpus
from veilmark.sources.tables import read, texts

_JUDGED = (
    f"{feature_cte('improved', ids='doc_id, lang, source')}, judged AS (SELECT feat.*, l.toxic AS y, "
    f"CASE WHEN {SQL_LABELS['improved']} THEN 1 ELSE 0 END AS p FROM feat JOIN labels l USING (doc_id))"
)
assert "words" in SQL_SETS["improved"]


def judged(spark, sf):
    """doc_id, lang, source, words, y (given), p (weak label): no text in the join."""
    wide = ft.featurize(texts(spark, sf), "text", "improved")
    narrow = wide.select("doc_id", "lang", "source", "words", F.col("label").alias("p"))
    return narrow.join(read(spark, sf, "labels").select("doc_id", F.col("toxic").alias("y")), "doc_id")


def _div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN ({a})::DOUBLE / ({b}) ELSE 0.0::DOUBLE END"


_CELLS = (
    "count_if(y = 0 AND p = 0) AS tn, count_if(y = 0 AND p = 1) AS fp, count_if(y = 1 AND p = 0) AS fn, "
    "count_if(y = 1 AND p = 1) AS tp, count(*) AS n"
)
_PREC, _REC = _div("tp", "tp + fp"), _div("tp", "tp + fn")
_F1 = _div("2.0::DOUBLE * tp", "2 * tp + fp + fn")
_METRICS = (
    f"round({_div('tp + tn', 'n')}, 6) AS accuracy, round({_PREC}, 6) AS precision, round({_REC}, 6) AS recall, "
    f"round({_F1}, 6) AS f1_score, round(1 - {_div('tp + fn', 'n')}, 6) AS baseline_accuracy, "
    f"round({_div('tp + tn', 'n')} - (1 - {_div('tp + fn', 'n')}), 6) AS improvement, tp + fn AS pii_count, "
    f"round({_div('tp + fn', 'n')}, 6) AS pii_share"
)
_NAMES = ("accuracy", "precision", "recall", "f1_score", "baseline_accuracy", "improvement", "pii_share")


@query("binary_metrics", f"WITH {_JUDGED}, c AS (SELECT {_CELLS} FROM judged) SELECT *, {_METRICS} FROM c")
def binary_metrics(spark, sf):
    return _rounded(evaluate.metrics(evaluate.confusion(judged(spark, sf), "y", "p")), *_NAMES)


@query(
    "binary_metrics_by_language",
    f"WITH {_JUDGED}, c AS (SELECT lang, {_CELLS} FROM judged GROUP BY lang) SELECT *, {_METRICS} FROM c",
)
def binary_metrics_by_language(spark, sf):
    return _rounded(evaluate.metrics(evaluate.confusion(judged(spark, sf), "y", "p", by=["lang"])), *_NAMES)


@query(
    "class_report",
    f"WITH {_JUDGED}, k AS (SELECT DISTINCT y AS k FROM judged UNION SELECT DISTINCT p FROM judged), "
    "c AS (SELECT CAST(k AS VARCHAR) AS class, count_if(y = k AND p = k) AS hit, count_if(p = k) AS said, count_if(y = k) AS support "
    "FROM judged, k GROUP BY k), "
    f"m AS (SELECT class, {_div('hit', 'said')} AS precision, {_div('hit', 'support')} AS recall, "
    f"{_div('2.0::DOUBLE * hit', 'said + support')} AS f1_score, support FROM c), "
    "u AS (SELECT * FROM m UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM m "
    "UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
    "sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM m) "
    "SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support FROM u",
)
def class_report(spark, sf):
    return _rounded(evaluate.class_report(judged(spark, sf), "y", "p"), "precision", "recall", "f1_score")


_CURVE = (
    f"{_JUDGED}, g AS (SELECT words AS threshold, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM judged GROUP BY words), "
    "r AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all "
    "FROM g WINDOW w AS (ORDER BY threshold DESC))"
)


@query(
    "roc_points",
    f"WITH {_CURVE} SELECT round(threshold, 6) AS threshold, round({_div('fp', 'n_all')}, 6) AS fpr, round({_div('tp', 'p_all')}, 6) AS tpr FROM r",
)
def roc_points(spark, sf):
    return _rounded(evaluate.roc_curve(judged(spark, sf), "y", "words"), "threshold", "fpr", "tpr")


@query(
    "roc_auc",
    f"WITH {_CURVE} SELECT round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(p_all) * max(n_all)), 6) AS auc FROM r",
)
def roc_auc(spark, sf):
    return _rounded(evaluate.auc(judged(spark, sf), "y", "words"), "auc")


@query(
    "precision_recall_points",
    f"WITH {_CURVE} SELECT round(threshold, 6) AS threshold, round({_div('tp', 'tp + fp')}, 6) AS precision, round({_div('tp', 'p_all')}, 6) AS recall FROM r",
)
def precision_recall_points(spark, sf):
    rows = evaluate.precision_recall_curve(judged(spark, sf), "y", "words")
    return _rounded(rows, "threshold", "precision", "recall")


@query(
    "class_distribution",
    "SELECT toxic AS class, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM labels), 6) AS share FROM labels GROUP BY toxic",
)
def class_distribution(spark, sf):
    return _rounded(evaluate.class_distribution(read(spark, sf, "labels"), "toxic"), "share")


# -- token level ----------------------------------------------------------------------

_PAIRS = (
    f"{LABELLED}, al AS (SELECT doc_id, labels, {_ALIGNED} AS tags FROM labelled), "
    "tc AS (SELECT doc_id, len(labels) AS n, "
    "len(list_filter(list_zip(labels, tags), lambda x: x[1] <> 'O' AND x[2] <> 'O')) AS tp, "
    "len(list_filter(list_zip(labels, tags), lambda x: x[1] = 'O' AND x[2] <> 'O')) AS fp, "
    "len(list_filter(list_zip(labels, tags), lambda x: x[1] <> 'O' AND x[2] = 'O')) AS fn, "
    "len(list_filter(list_zip(labels, tags), lambda x: x[1] = 'O' AND x[2] = 'O')) AS tn FROM al)"
)
_TOKEN_SUMS = (
    "count(*) AS samples, CAST(sum(n) AS BIGINT) AS n, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, "
    "CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(tn) AS BIGINT) AS tn"
)
_TOKEN_METRICS = (
    "samples, n AS total_tokens, tp + fn AS true_pii_tokens, tp + fp AS pred_pii_tokens, "
    f"round({_PREC}, 6) AS precision, round({_REC}, 6) AS recall, round({_F1}, 6) AS f1_score"
)


def counted(spark, sf):
    """doc_id and token counts of aligned tags: arrays never leave their row."""
    c = corpus(spark, sf)
    aligned = lb.align(F.col("tags"), F.col("labels"))
    return c.withColumn("a", aligned).select("doc_id", "text", lb.counts(F.col("labels"), F.col("a")).alias("counts"))


@query("token_metrics", f"WITH {_PAIRS}, s AS (SELECT {_TOKEN_SUMS} FROM tc) SELECT {_TOKEN_METRICS} FROM s")
def token_metrics(spark, sf):
    return _rounded(evaluate.token_metrics(counted(spark, sf)), "precision", "recall", "f1_score")


@query(
    "token_metrics_by_split",
    f"WITH {_PAIRS}, p AS (SELECT doc_id, {_SPLIT} AS split FROM {_rank('documents', 'doc_id')}), "
    f"s AS (SELECT split, {_TOKEN_SUMS} FROM tc JOIN p USING (doc_id) GROUP BY split) SELECT split, {_TOKEN_METRICS} FROM s",
)
def token_metrics_by_split(spark, sf):
    rows = order.shuffled_split(counted(spark, sf).drop("text"), ["doc_id"])
    return _rounded(evaluate.token_metrics(rows, by=["split"]), "precision", "recall", "f1_score")


@query(
    "sample_metrics",
    f"WITH {_PAIRS} SELECT doc_id, substring(text, 1, 50) || '...' AS start, tp + fn AS true_pii, tp + fp AS pred_pii, "
    f"round({_PREC}, 6) AS precision, round({_REC}, 6) AS recall, round({_F1}, 6) AS f1 FROM tc JOIN documents USING (doc_id)",
)
def sample_metrics(spark, sf):
    rows = counted(spark, sf)
    shown = F.concat(F.substring("text", 1, 50), F.lit("...")).alias("start")
    return _rounded(
        rows.select("doc_id", shown, *evaluate.sample_metrics(F.col("counts"))), "precision", "recall", "f1"
    )


_CLS = (
    "list_transform({0}, lambda x: CASE WHEN starts_with(x, 'B-') THEN 1 WHEN starts_with(x, 'I-') THEN 2 ELSE 0 END)"
)


@query(
    "any_pii_metrics",
    f"WITH {LABELLED}, c AS (SELECT coalesce(y, 0) AS y, coalesce(p, 0) AS p FROM (SELECT unnest({_CLS.format('labels')}) AS y, unnest({_CLS.format('tags')}) AS p FROM labelled)), "
    "s AS (SELECT count_if(y = p)::DOUBLE / count(*) AS accuracy, count_if(y <> 0 AND p <> 0) AS tp, count_if(y = 0 AND p <> 0) AS fp, "
    "count_if(y <> 0 AND p = 0) AS fn FROM c) "
    f"SELECT round(accuracy, 6) AS accuracy, round({_PREC}, 6) AS precision, round({_REC}, 6) AS recall, round({_F1}, 6) AS f1_score FROM s",
)
def any_pii_metrics(spark, sf):
    """Three classes over all labels of all texts; a hit is any PII where there is any."""
    c = corpus(spark, sf)
    pairs = c.select(
        F.explode_outer(F.arrays_zip(F.transform("labels", lb.class_of).alias("y"), F.transform("tags", lb.class_of).alias("p"))).alias("x")
    ).where("x IS NOT NULL").select(F.coalesce("x.y", F.lit(0)).alias("y"), F.coalesce("x.p", F.lit(0)).alias("p"))
    exact = evaluate.confusion(pairs, "y", "p", extra={"exact": F.avg((F.col("y") == F.col("p")).cast("double"))})
    rows = evaluate.metrics(exact)
    return _rounded(
        rows.select(F.col("exact").alias("accuracy"), "precision", "recall", "f1_score"),
        "accuracy", "precision", "recall", "f1_score",
    )


@query(
    "error_analysis",
    f"WITH {_PAIRS}, s AS (SELECT CAST(sum(tp + tn) AS BIGINT) AS c, CAST(sum(fp) AS BIGINT) AS f, CAST(sum(fn) AS BIGINT) AS m FROM tc), "
    "u AS (SELECT 'correct' AS outcome, c AS tokens, c + f + m AS t FROM s UNION ALL SELECT 'false_positives', f, c + f + m FROM s "
    "UNION ALL SELECT 'false_negatives', m, c + f + m FROM s) "
    f"SELECT outcome, tokens, round({_div('tokens * 100.0::DOUBLE', 't')}, 6) AS percent FROM u",
)
def error_analysis(spark, sf):
    return _rounded(evaluate.error_analysis(counted(spark, sf)), "percent")


# -- comparisons ----------------------------------------------------------------------

_EPS_VALUES = ", ".join(f"({e}::DOUBLE, '{c}')" for e, _, _, c in catalog.PRIVACY_LEVELS)
_NOISY = (
    f"noisy AS (SELECT epsilon, report_level, y, CASE WHEN words / 100 + ({uniform_sql('9', 'doc_id')} - 0.5::DOUBLE) / epsilon "
    f"> 0.5 THEN 1 ELSE 0 END AS p FROM judged, (VALUES {_EPS_VALUES}) AS b(epsilon, report_level))"
)


def by_epsilon(spark, sf):
    """Metrics of a noisy length rule per budget: less budget, more noise."""
    grid = judged(spark, sf).withColumn("epsilon", F.explode(F.array(*[F.lit(e) for e in catalog.EPSILONS])))
    noisy = F.col("words") / 100.0 + (tx.uniform(F.lit(9), F.col("doc_id")) - 0.5) / F.col("epsilon")
    cells = evaluate.confusion(grid.withColumn("p", (noisy > 0.5).cast("int")), "y", "p", by=["epsilon"])
    return evaluate.metrics(cells)


@query(
    "metrics_by_epsilon",
    f"WITH {_JUDGED}, {_NOISY}, c AS (SELECT epsilon, report_level, {_CELLS} FROM noisy GROUP BY ALL), "
    f"m AS (SELECT epsilon, report_level, {_METRICS} FROM c) SELECT epsilon, report_level, accuracy, precision, recall, f1_score, "
    "baseline_accuracy, improvement, row_number() OVER (ORDER BY accuracy DESC, epsilon DESC) = 1 AS is_best FROM m",
)
def metrics_by_epsilon(spark, sf):
    rows = evaluate.compare_budgets(_rounded(by_epsilon(spark, sf), *_NAMES))
    return evaluate.privacy_levels(rows).select(
        "epsilon", "report_level", "accuracy", "precision", "recall", "f1_score", "baseline_accuracy", "improvement", "is_best"
    )


@query(
    "comparison_report",
    f"WITH {_JUDGED}, {_NOISY}, c AS (SELECT epsilon, report_level, {_CELLS} FROM noisy GROUP BY ALL), "
    f"m AS (SELECT epsilon, report_level, {_METRICS} FROM c) "
    "SELECT printf('| %.1f | %.4f | %.4f | %+.4f | %s |', epsilon, accuracy, f1_score, improvement, report_level) AS value FROM m",
)
def comparison_report(spark, sf):
    from veilmark.sources.files import markdown_rows

    return markdown_rows(evaluate.privacy_levels(_rounded(by_epsilon(spark, sf), *_NAMES)))


_RUNS = (
    f"{_JUDGED}, c AS (SELECT source AS run, lang AS epoch, {_CELLS} FROM judged GROUP BY ALL), "
    f"h AS (SELECT run, epoch, round({_div('tp + tn', 'n')}, 6) AS accuracy, round({_F1}, 6) AS f1_score FROM c)"
)


def run_history(spark, sf):
    cells = evaluate.confusion(judged(spark, sf), "y", "p", by=["source", "lang"])
    rows = evaluate.metrics(cells).select(F.col("source").alias("run"), F.col("lang").alias("epoch"), "accuracy", "f1_score")
    return _rounded(rows, "accuracy", "f1_score")


@query(
    "run_ranking",
    f"WITH {_RUNS}, b AS (SELECT run, max(accuracy) AS best FROM h GROUP BY run) SELECT run, best, rank() OVER (ORDER BY best DESC) AS rank FROM b",
)
def run_ranking(spark, sf):
    return evaluate.rank_runs(run_history(spark, sf), "run", "accuracy")


@query(
    "metric_history",
    f"WITH {_RUNS} SELECT run, epoch, 'accuracy' AS metric, accuracy AS value FROM h UNION ALL SELECT run, epoch, 'f1_score', f1_score FROM h",
)
def metric_history(spark, sf):
    rows = run_history(spark, sf).unpivot(["run", "epoch"], ["accuracy", "f1_score"], "metric", "value")
    return rows.sortWithinPartitions("run", "epoch", "metric")


# -- run histories over the events table: run = user, epoch = event, metric = value ------


@query(
    "best_epoch",
    "SELECT user_id, arg_min(event_id, event_id) FILTER (WHERE value = best) AS best_epoch, any_value(best) AS best, count(*) AS epochs "
    "FROM (SELECT *, max(value) OVER (PARTITION BY user_id) AS best FROM events) GROUP BY user_id",
)
def best_epoch(spark, sf):
    return evaluate.best_epoch(read(spark, sf, "events"), ["user_id"], "event_id", "value")


@query(
    "early_stop",
    "WITH b AS (SELECT user_id, event_id, value, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev, "
    "row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM events), "
    "l AS (SELECT *, max(CASE WHEN prev IS NULL OR value > prev THEN pos END) OVER (PARTITION BY user_id ORDER BY event_id) AS last FROM b) "
    "SELECT user_id, min(CASE WHEN pos - last >= 5 THEN event_id END) AS stop_epoch, count(*) AS epochs FROM l GROUP BY user_id",
)
def early_stop(spark, sf):
    history = read(spark, sf, "events").select("user_id", "event_id", "value")
    return evaluate.early_stop(history, ["user_id"], "event_id", "value", patience=5)


@query(
    "loss_alarms",
    "SELECT user_id, arg_min(value, event_id) AS first_loss, arg_max(value, event_id) AS last_loss, "
    "arg_max(value, event_id) > 5 * arg_min(value, event_id) AS exploded, max(value) > 10 AS diverged, min(value) < 0.1 AS converged "
    "FROM events GROUP BY user_id",
)
def loss_alarms(spark, sf):
    return evaluate.loss_alarms(read(spark, sf, "events"), ["user_id"], "event_id", "value")
