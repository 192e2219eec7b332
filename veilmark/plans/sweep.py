"""Train, evaluate and compare models over privacy budgets."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.functions import kernels
from veilmark.operators import evaluate, model as md


def score_all(data: DataFrame, models: dict[float, md.Model]) -> DataFrame:
    """(epsilon, label, pred): every model on every row, in one pass."""
    scored = data.select(
        "label", *[kernels.mlp(m.layers)(F.col("features")).alias(f"m{i}") for i, m in enumerate(models.values())]
    )
    pairs = [
        F.struct(F.lit(e).alias("epsilon"), F.col(f"m{i}.pred").alias("pred")) for i, e in enumerate(models)
    ]
    return scored.select("label", F.explode(F.array(*pairs)).alias("x")).select("label", "x.*")


def sweep(
    data: DataFrame, ids: list[str], budgets: list[float], test: DataFrame | None = None, **options
) -> DataFrame:
    """One row per budget: best epoch and F1 in training, metrics on the test rows,
    time of the whole sweep, and which budget is best."""
    started = time.monotonic()
    trained = md.train(data, ids, budgets, **options)
    seconds = time.monotonic() - started
    spark = data.sparkSession
    history = md.history_table(spark, trained)
    best = evaluate.best_epoch(history, ["epsilon"], "epoch", "val_f1").withColumnRenamed("best", "best_f1")
    scored = score_all(test if test is not None else data, {e: t.best for e, t in trained.items()})
    results = evaluate.metrics(evaluate.confusion(scored, "label", "pred", by=["epsilon"]))
    joined = results.join(F.broadcast(best), "epsilon", "left")  # one row per budget
    return evaluate.compare_budgets(joined.withColumn("sweep_seconds", F.lit(seconds)))
