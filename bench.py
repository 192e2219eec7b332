"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs into a no-op sink, so all of its rows and columns are computed
and none are collected. The value of a query is the median of $BENCH_RUNS runs (one run if it
takes over five seconds) after a warm-up run on the smallest tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from veilmark.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "spans_core", "spans_core_by_language", "spans_extended", "spans_fallback", "spans_merged_as_rows",
    "redact_category_labels", "redact_blocks", "features_final", "model_scores", "model_word_spans",
    "hybrid_spans", "tagger_counts", "pii_types", "token_metrics", "split_shuffled", "roc_auc",
    "privacy_spent_so_far", "early_stop", "detected_against_truth", "synthetic_documents", "corpus_prepared", "train_private_model",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="veilmark-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")

    def once(name: str, where: str) -> float:
        started = time.perf_counter()
        REGISTRY[name].run(spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    timings = {}
    for name in names:
        once(name, small if os.path.isdir(small) else folder)
        took = [once(name, folder)]
        if took[0] <= 5:
            took += [once(name, folder) for _ in range(runs - 1)]
        timings[name] = round(statistics.median(took), 3)
    size = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "count(*) AS docs", "sum(octet_length(text)) / 1e6 AS mb"
    ).first()
    rates = {
        n: {"docs_per_sec": round(size["docs"] / t), "mb_per_sec": round(float(size["mb"]) / t, 2)}
        for n, t in timings.items()
        if n in ("spans_core", "spans_extended", "spans_merged_as_rows", "redact_category_labels", "model_scores", "pii_types")
    }
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries", "value": round(sum(timings.values()), 3), "unit": "sec",
                "queries": timings, "sf": os.path.basename(folder.rstrip("/")), "rates": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
