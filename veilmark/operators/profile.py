"""Corpus profiles: single-pass aggregates over text and label columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilmark.functions import labels as lb
from veilmark.functions import text as tx
from veilmark.operators.evaluate import ratio
from veilmark.operators.order import ordered_position
from veilmark.sources.shared import cut


def lengths(df: DataFrame, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Length statistics in characters and the mean token count."""
    n = F.length(text)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(n).alias("chars_mean"),
        F.min(n).alias("chars_min"),
        F.max(n).alias("chars_max"),
        F.median(n).alias("chars_median"),
        F.stddev_samp(n).alias("chars_std"),
        F.avg(tx.n_tokens(F.col(text))).alias("tokens_mean"),
    )


def pii_counts(df: DataFrame, labels: str = "labels", by: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """Non-O labels: total, per row, rows that have any. ``count`` names a column
    that already holds the number per row (so arrays need not be shuffled)."""
    n = lb.pii_count(F.col(labels)) if count is None else F.col(count)
    sums = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(n).alias("total_pii"), F.count_if(n > 0).alias("rows_with_pii")
    )
    return sums.select(
        "*",
        ratio(F.col("total_pii"), F.col("n_rows")).alias("pii_per_row"),
        ratio(F.col("rows_with_pii") * 100.0, F.col("n_rows")).alias("pii_row_percent"),
    )


def _exploded(df: DataFrame, labels: str) -> DataFrame:
    return df.select(F.explode_outer(labels).alias("label")).where("label IS NOT NULL")


def pii_types(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Entity types with count and share of all non-O labels, most frequent first."""
    pii = _exploded(df, labels).where(lb.is_pii(F.col("label")))
    by_type = pii.groupBy(lb.entity_type(F.col("label")).alias("pii_type")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per type
    shares = by_type.withColumn("percent", ratio(F.col("n") * 100.0, total))
    return shares.where("pii_type IS NOT NULL").orderBy(F.desc("n"), "pii_type")


def label_distribution(df: DataFrame, labels: str = "labels") -> DataFrame:
    return _exploded(df, labels).groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label")


def label_summary(df: DataFrame, labels: str = "labels") -> DataFrame:
    """One row: distinct labels, labels per row, PII and other tokens, entity types."""
    # The first label of a row also carries the row's size, so one pass counts both.
    size = F.size(labels).cast("long")
    rows = df.select(size.alias("_size"), F.posexplode_outer(labels).alias("_at", "label"))
    of_row = F.when(F.coalesce(F.col("_at"), F.lit(0)) == 0, F.col("_size"))
    counted = rows.groupBy("label").agg(
        F.count("label").alias("n"), F.count(of_row).alias("_rows"), F.sum(of_row).alias("_sum"), F.sum(of_row * of_row).alias("_squares")
    )
    n, total, squares = F.sum("_rows"), F.sum("_sum"), F.sum("_squares")
    mean = total / n
    over = counted.agg(
        mean.alias("labels_mean"),
        F.when(n > 1, F.sqrt((squares - total * mean) / (n - 1))).alias("labels_std"),
        F.count("label").alias("unique_labels"),
        F.sum(F.when(lb.is_pii(F.col("label")), F.col("n")).otherwise(0)).alias("pii_tokens"),
        F.sum(F.when(lb.is_pii(F.col("label")), 0).otherwise(F.col("n"))).alias("other_tokens"),
        F.array_sort(F.collect_set(lb.entity_type(F.col("label")))).alias("entity_types"),
    )
    return over.select(
        "unique_labels", "pii_tokens", "other_tokens", "entity_types",
        ratio(F.col("pii_tokens"), F.col("pii_tokens") + F.col("other_tokens")).alias("pii_ratio"),
        "labels_mean", "labels_std",
    )


def label_ids(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Ids 0, 1, ... of the distinct labels in sorted order."""
    distinct = cut(_exploded(df, labels).distinct(), "labels")
    placed = ordered_position(distinct, ["label"], "label_id")
    return placed.select("label", F.col("label_id").cast("int").alias("label_id"))


def missing(df: DataFrame) -> DataFrame:
    """One row per column: dtype, missing values, complete or not."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    dtypes = dict(df.dtypes)
    return counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"), F.lit(dtypes[c]).alias("dtype"),
                        F.col(c).alias("n_missing"), (F.col(c) == 0).alias("complete"),
                        (F.col(c) < F.col("_n")).alias("has_values"),
                    )
                    for c in df.columns
                ]
            )
        ).alias("r")
    ).select("r.*")


def preview(df: DataFrame, order: Sequence[str], text: str = "text", rows: int = 5, chars: int = 50) -> DataFrame:
    """First rows in a fixed order with the start of their text (a display report)."""
    shown = F.concat(F.substring(text, 1, chars), F.lit("..."))
    return df.orderBy(*order).limit(rows).withColumn("preview", shown)


def batch_summary(df: DataFrame, entity_count: Column, error: Column) -> DataFrame:
    """One row: files in total, processed, failed, and entities found."""
    failed = error.isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(~failed).alias("processed_files"),
        F.count_if(failed).alias("failed_files"),
        F.sum(F.when(failed, 0).otherwise(entity_count)).alias("entities"),
    )
