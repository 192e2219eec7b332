"""Corpus job: read, clean, sample, split, profile, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilmark.operators import order, profile
from veilmark.sources import files
from veilmark.sources.shared import cut


def prepare(raw: DataFrame, n_samples: int | None = None, seed: int = 42) -> DataFrame:
    """(text, labels, split) of a raw corpus table."""
    rows = files.clean_corpus(files.map_corpus(raw))
    ids = ["text", "labels"]
    keyed = rows.withColumn("_labels", files.lb.render(rows["labels"]))
    if n_samples is not None:
        keyed = order.sample_rows(keyed, ["text", "_labels"], n_samples, seed)
    split = order.shuffled_split(keyed, ["text", "_labels"], seed=seed)
    return split.select(*ids, "split", "position")


def run(spark: SparkSession, path: str, columns: list[str], out: str, n_samples: int | None = None) -> dict[str, DataFrame]:
    """Prepare a CSV corpus and write splits, split statistics and the profile."""
    rows = cut(prepare(files.read_raw_corpus(spark, path, columns), n_samples), "corpus")
    files.write_splits(rows.drop("position"), f"{out}/splits")
    reports = {
        "split_statistics": profile.pii_counts(rows, by=["split"]),
        "lengths": profile.lengths(rows),
        "pii": profile.pii_counts(rows),
        "pii_types": profile.pii_types(rows),
        "label_summary": profile.label_summary(rows),
    }
    for name, report in reports.items():
        files.write_json(report, f"{out}/{name}")
    return reports
