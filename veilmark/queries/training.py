"""Training queries: rows only, because noise and sampling are random by design."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import features as ft
from veilmark.operators import model as md
from veilmark.queries.base import query
from veilmark.sources.shared import cut
from veilmark.sources.tables import texts

EPOCHS = 10
STEPS = 4096


def training_rows(spark, sf, feature_set: str = "final"):
    """(doc_id, features, label) of all documents, standardised and written once."""
    wide = ft.featurize(texts(spark, sf).select("doc_id", "text"), "text", feature_set)
    names = ft.names(feature_set)
    narrow = cut(wide.select("doc_id", *names, "label"), "features")
    scaled = ft.standardise(narrow, names)
    return scaled.select("doc_id", ft.vector(names).alias("features"), "label")


def _batch(rows) -> int:
    # Batches of 32; of more rows where an epoch would have more than STEPS steps, which
    # run one after the other.
    return max(32, math.ceil(rows.count() / STEPS))


@query("train_private_model")
def train_private_model(spark, sf):
    """Two budgets trained side by side; one row per budget and epoch."""
    rows = training_rows(spark, sf)
    done = md.train(rows, ["doc_id"], [8.0, 1.0], "final", lr=0.005, batch_size=_batch(rows), epochs=EPOCHS, seed=42)
    return md.history_table(spark, done)


@query("train_strategies")
def train_strategies(spark, sf):
    """Every clipping and noise strategy, with gradient norms, over the same rows."""
    rows = cut(training_rows(spark, sf, "final"), "training-rows")
    names = list(md.STRATEGIES)
    done = md.train_runs(rows, ["doc_id"], [(8.0, s) for s in names], lr=0.005, batch_size=_batch(rows), epochs=EPOCHS, seed=42)
    out = None
    for name, trained in zip(names, done):
        table = md.history_table(spark, {8.0: trained}).withColumn("strategy", F.lit(name))
        out = table if out is None else out.unionByName(table)
    return out


@query("budget_sweep")
def budget_sweep(spark, sf):
    """All six budgets in one pass over shared draws, evaluated and compared."""
    from veilmark.plans.sweep import sweep

    rows = training_rows(spark, sf)
    return sweep(rows, ["doc_id"], list(catalog.EPSILONS), lr=0.005, batch_size=_batch(rows), epochs=EPOCHS, seed=42)
