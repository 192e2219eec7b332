"""Evaluation of binary predictions: everything starts from one grouped count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.operators.order import running, slice_bounds
from veilmark.sources.shared import cut


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b != 0, a / b).otherwise(0.0)


def f1(precision: Column, recall: Column) -> Column:
    return ratio(2.0 * precision * recall, precision + recall)


def confusion(df: DataFrame, y: str, p: str, by: Sequence[str] = (), extra: dict[str, Column] | None = None) -> DataFrame:
    """tn, fp, fn, tp and n per group."""
    t, q = F.col(y) != 0, F.col(p) != 0
    return df.groupBy(*by).agg(
        F.count_if(~t & ~q).alias("tn"),
        F.count_if(~t & q).alias("fp"),
        F.count_if(t & ~q).alias("fn"),
        F.count_if(t & q).alias("tp"),
        F.count(F.lit(1)).alias("n"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )


def metrics(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, F1, majority baseline and improvement from counts."""
    tn, fp, fn, tp, n = (F.col(c) for c in ("tn", "fp", "fn", "tp", "n"))
    accuracy, precision, recall = ratio(tp + tn, n), ratio(tp, tp + fp), ratio(tp, tp + fn)
    baseline = 1.0 - ratio(tp + fn, n)
    return counts.select(
        "*",
        accuracy.alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1(precision, recall).alias("f1_score"),
        baseline.alias("baseline_accuracy"),
        (accuracy - baseline).alias("improvement"),
        (tp + fn).alias("pii_count"),
        ratio(tp + fn, n).alias("pii_share"),
    )


def class_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted averages."""
    cells = cut(df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("c")), "cells")
    roles = cells.select(
        F.explode(
            F.when(
                F.col("y") == F.col("p"),
                F.array(F.struct(F.col("y").alias("k"), F.col("c").alias("hit"), F.col("c").alias("said"), F.col("c").alias("is"))),
            ).otherwise(
                F.array(
                    F.struct(F.col("y").alias("k"), F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("said"), F.col("c").alias("is")),
                    F.struct(F.col("p").alias("k"), F.lit(0).cast("long").alias("hit"), F.col("c").alias("said"), F.lit(0).cast("long").alias("is")),
                )
            )
        ).alias("r")
    ).select("r.*")
    sums = roles.groupBy("k").agg(F.sum("hit").alias("hit"), F.sum("said").alias("said"), F.sum("is").alias("support"))
    precision, recall = ratio(F.col("hit"), F.col("said")), ratio(F.col("hit"), F.col("support"))
    per_class = sums.select(
        F.col("k").cast("string").alias("class"), precision.alias("precision"), recall.alias("recall"),
        f1(precision, recall).alias("f1_score"), F.col("support"),
    )
    values = ("precision", "recall", "f1_score")
    macro = per_class.agg(
        F.lit("macro avg").alias("class"), *[F.avg(v).alias(v) for v in values], F.sum("support").alias("support")
    )
    weighted = per_class.agg(
        F.lit("weighted avg").alias("class"),
        *[ratio(F.sum(F.col(v) * F.col("support")), F.sum("support")).alias(v) for v in values],
        F.sum("support").alias("support"),
    )
    return per_class.unionByName(macro).unionByName(weighted)


def _by_score(df: DataFrame, y: str, score: str) -> tuple[DataFrame, Column, Column]:
    """Positives and negatives at or above each distinct score, and their totals.

    Equal scores are combined first; everything after works on that table.
    """
    grouped = cut(
        df.groupBy(F.col(score).alias("threshold")).agg(
            F.count_if(F.col(y) != 0).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
        ),
        "scores",
    )
    down = grouped.withColumn("_down", -F.col("threshold"))
    summed = running(down, [], ["_down"], {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}).drop("_down")
    return summed, grouped.agg(F.sum("pos")).scalar(), grouped.agg(F.sum("neg")).scalar()


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """One point per distinct score, from the highest threshold down."""
    points, pos, neg = _by_score(df, y, score)
    return points.select(
        "threshold", ratio(F.col("fp"), neg).alias("fpr"), ratio(F.col("tp"), pos).alias("tpr")
    )


def auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Area under the ROC curve: each score adds a trapezoid known from its own row."""
    points, pos, neg = _by_score(df, y, score)
    area = points.agg(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)).alias("a"))
    return area.select(ratio(F.col("a"), pos * neg).alias("auc"))


def precision_recall_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    points, pos, _ = _by_score(df, y, score)
    return points.select(
        "threshold", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), pos).alias("recall")
    )


def class_distribution(df: DataFrame, y: str) -> DataFrame:
    counts = df.groupBy(F.col(y).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per class
    return counts.withColumn("share", F.col("n") / total)


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """One row: class counts and weights 1 and total / (2 * positives)."""
    row = df.agg(F.count_if(F.col(y) == 0).alias("n0"), F.count_if(F.col(y) != 0).alias("n1"))
    return row.select(
        "n0", "n1", F.lit(1.0).alias("weight0"), ratio((F.col("n0") + F.col("n1")), 2.0 * F.col("n1")).alias("weight1")
    )


def token_metrics(counted: DataFrame, by: Sequence[str] = (), counts: str = "counts") -> DataFrame:
    """Micro metrics over all tokens from per-row count structs."""
    sums = counted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("samples"),
        *[F.sum(f"{counts}.{c}").alias(c) for c in ("n", "tp", "fp", "fn", "tn")],
    )
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return sums.select(
        *by, "samples", F.col("n").alias("total_tokens"),
        (F.col("tp") + F.col("fn")).alias("true_pii_tokens"), (F.col("tp") + F.col("fp")).alias("pred_pii_tokens"),
        precision.alias("precision"), recall.alias("recall"), f1(precision, recall).alias("f1_score"),
    )


def sample_metrics(counts: Column) -> list[Column]:
    """true_pii, pred_pii, precision, recall and F1 of one row's counts."""
    tp, fp, fn = counts["tp"], counts["fp"], counts["fn"]
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return [
        (tp + fn).alias("true_pii"), (tp + fp).alias("pred_pii"), precision.alias("precision"),
        recall.alias("recall"), f1(precision, recall).alias("f1"),
    ]


def error_analysis(counted: DataFrame, counts: str = "counts") -> DataFrame:
    """Correct, false-positive and false-negative tokens with their share in percent."""
    c = counted.agg(
        F.sum(F.col(f"{counts}.tp") + F.col(f"{counts}.tn")).alias("correct"),
        F.sum(f"{counts}.fp").alias("false_positives"),
        F.sum(f"{counts}.fn").alias("false_negatives"),
        F.sum(f"{counts}.n").alias("_all"),
    )
    long = c.unpivot(["_all"], ["correct", "false_positives", "false_negatives"], "outcome", "tokens")
    return long.select("outcome", "tokens", ratio(F.col("tokens") * 100.0, F.col("_all")).alias("percent"))


# -- losses -----------------------------------------------------------------------


def cross_entropy(logits: Column, y: Column) -> Column:
    """Softmax cross-entropy of a two-element logit array."""
    a, b = F.get(logits, F.lit(0)), F.get(logits, F.lit(1))
    top = F.greatest(a, b)
    return top + F.log(F.exp(a - top) + F.exp(b - top)) - F.when(y != 0, b).otherwise(a)


def weighted_cross_entropy(logits: Column, y: Column, weights: tuple[float, float]) -> Column:
    return cross_entropy(logits, y) * F.when(y != 0, F.lit(weights[1])).otherwise(weights[0])


def weighted_sigmoid(logits: Column, y: Column, pos_weight: float) -> Column:
    """Binary cross-entropy on the second logit; positives count ``pos_weight`` times."""
    z = F.get(logits, F.lit(1))
    target = F.when(y != 0, F.lit(1.0)).otherwise(0.0)
    loss = F.greatest(z, F.lit(0.0)) - z * target + F.log1p(F.exp(-F.abs(z)))
    return loss * F.when(y != 0, F.lit(float(pos_weight))).otherwise(1.0)


# -- run histories: (run, epoch, metric) tables ------------------------------------


def best_epoch(history: DataFrame, keys: Sequence[str], epoch: str, metric: str, smaller: bool = False) -> DataFrame:
    """First epoch with the best metric, as a plain grouped maximum."""
    value = -F.col(metric) if smaller else F.col(metric)
    return history.groupBy(*keys).agg(
        F.max_by(epoch, F.struct(value, -F.col(epoch))).alias("best_epoch"),
        (F.min(metric) if smaller else F.max(metric)).alias("best"),
        F.count(F.lit(1)).alias("epochs"),
    )


def early_stop(history: DataFrame, keys: Sequence[str], epoch: str, metric: str, patience: int) -> DataFrame:
    """First epoch at which ``patience`` epochs in a row brought no improvement.

    Where the count since the last strict improvement reaches the patience;
    NULL if training would have run to the end.
    """
    keys, bounds = list(keys), slice_bounds(history, [epoch], 64)
    seen = running(
        history, keys, [epoch], {"_best": ("max", F.col(metric)), "_at": ("sum", F.lit(1).cast("long"))},
        bounds, before=["_best"],
    )
    better = F.col("_best").isNull() | (F.col(metric) > F.col("_best"))
    last = running(seen, keys, [epoch], {"_last": ("max", F.when(better, F.col("_at")))}, bounds)
    stop = F.min(F.when(F.col("_at") - F.col("_last") >= patience, F.col(epoch)))
    return last.groupBy(*keys).agg(stop.alias("stop_epoch"), F.count(F.lit(1)).alias("epochs"))


def loss_alarms(history: DataFrame, keys: Sequence[str], epoch: str, loss: str) -> DataFrame:
    """exploded: last > 5 * first; diverged: any > 10; converged: any < 0.1."""
    return history.groupBy(*keys).agg(
        F.min_by(loss, epoch).alias("first_loss"),
        F.max_by(loss, epoch).alias("last_loss"),
        (F.max_by(loss, epoch) > 5.0 * F.min_by(loss, epoch)).alias("exploded"),
        (F.max(loss) > 10.0).alias("diverged"),
        (F.min(loss) < 0.1).alias("converged"),
    )


def compare_budgets(results: DataFrame) -> DataFrame:
    """Metric rows by budget, each marked if it has the best accuracy.

    ``results`` has one row per budget (at most a few dozen).
    """
    best = F.max(F.struct("accuracy", "epsilon")).over(Window.partitionBy())
    return results.withColumn("is_best", F.col("epsilon") == best["epsilon"]).orderBy("epsilon")


def rank_runs(history: DataFrame, run: str, metric: str, min_runs: int = 2) -> DataFrame:
    """Best metric per run with its rank, without runs that have no metric; empty unless at
    least ``min_runs`` runs remain."""
    best = history.groupBy(run).agg(F.max(metric).alias("best")).where("best IS NOT NULL")
    runs = best.agg(F.count(F.lit(1))).scalar()
    down = best.where(runs >= min_runs).withColumn("_down", -F.col("best"))
    ahead = running(
        down.groupBy("_down").agg(F.count(F.lit(1)).alias("_same")), [], ["_down"],
        {"_ahead": ("sum", F.col("_same"))}, before=["_ahead"],
    )
    return down.join(ahead.select("_down", "_ahead"), "_down").select(
        run, "best", (F.col("_ahead") + 1).alias("rank")
    )


def privacy_levels(df: DataFrame, epsilon: str = "epsilon") -> DataFrame:
    """Adds the wording of each privacy level; unknown budgets get NULL."""
    spark = df.sparkSession
    levels = spark.createDataFrame(
        list(catalog.PRIVACY_LEVELS), f"{epsilon} double, privacy_level string, redaction_level string, report_level string"
    )
    return df.join(F.broadcast(levels), epsilon, "left")  # six rows
