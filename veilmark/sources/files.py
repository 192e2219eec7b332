"""Text, CSV and JSON sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from veilmark.functions import labels as lb
from veilmark.functions import text as tx

RAW_TEXT, RAW_LABELS = "Filled Template", "Tokens"  # fixed column names of the raw corpus
SPLIT_SCHEMA = "text string, labels string"
HISTORY_METRICS = ("train_loss", "val_loss", "val_acc", "val_precision", "val_recall", "val_f1")


def literal(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id string, text string")


def decode(df: DataFrame, content: str = "content") -> DataFrame:
    """Bytes to ``text``; bytes that are not UTF-8 give an ``error`` and an empty text."""
    valid = F.is_valid_utf8(F.col(content).cast("string"))
    return df.withColumn("error", F.when(~valid, F.lit("not valid UTF-8"))).withColumn(
        "text", F.when(valid, F.col(content).cast("string")).otherwise("")
    )


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One file, one document: (doc_id, path, text, error)."""
    return _read(spark, path, None)


def read_folder(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """Every matching file of a folder, one row each.

    Spark's file sources leave out files of zero length: there is nothing to
    redact in them and they are not counted.
    """
    return _read(spark, folder, glob)


def _read(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = decode(reader.load(path).select("path", "content"))
    return found.select(
        F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("doc_id"), "path", "text", "error"
    )


def redacted_name(path: Column) -> Column:
    """dir/name.ext -> dir/name_redacted.ext"""
    return F.regexp_replace(path, r"^(.*?)(\.[^./]*)?$", "$1_redacted$2")


def details_name(path: Column) -> Column:
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit("_redaction_details.json"))


def write_text(df: DataFrame, out: str, text: str = "redacted_text") -> None:
    df.select(F.col(text).alias("value")).write.mode("overwrite").text(out)


def write_json(df: DataFrame, out: str) -> None:
    df.write.mode("overwrite").json(out)


# -- labelled corpora ---------------------------------------------------------------


def read_raw_corpus(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Raw CSV with a header; rows with too many fields are skipped, short ones padded.

    Permissive parsing keeps both kinds as corrupt records; a short one has too few
    commas outside its quoted fields.
    """
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _bad string"
    rows = spark.read.csv(
        path, schema=schema, header=True, multiLine=True, escape='"', mode="PERMISSIVE",
        columnNameOfCorruptRecord="_bad",
    )
    unquoted = F.regexp_replace("_bad", r'"(?:[^"]|"")*"', "")
    n_fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
    return rows.where(F.col("_bad").isNull() | (n_fields < len(columns))).drop("_bad")


def map_corpus(df: DataFrame) -> DataFrame:
    """(text, labels) from the raw column names; both are required."""
    for name in (RAW_TEXT, RAW_LABELS):
        if name not in df.columns:
            raise ValueError(f"'{name}' column not found")
    return df.select(F.col(f"`{RAW_TEXT}`").alias("text"), F.col(f"`{RAW_LABELS}`").alias("labels"))


def clean_corpus(df: DataFrame) -> DataFrame:
    """Stripped text, label lists parsed."""
    return df.withColumn("text", tx.clean(F.col("text"))).withColumn("labels", lb.parse(F.col("labels")))


def read_split(spark: SparkSession, path: str, max_rows: int | None = None, seed: int = 42) -> DataFrame:
    """A split written as CSV; an empty frame if there is none."""
    try:
        rows = spark.read.csv(path, schema=SPLIT_SCHEMA, header=True, multiLine=True, escape='"')
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SPLIT_SCHEMA)
    if max_rows is None:
        return rows
    from veilmark.operators.order import sample_rows

    return sample_rows(rows, ["text", "labels"], max_rows, seed)


def read_labelled_split(spark: SparkSession, path: str) -> DataFrame:
    return read_split(spark, path).withColumn("labels", lb.parse(F.col("labels")))


def write_splits(df: DataFrame, out: str, as_csv: bool = False) -> None:
    """One folder per split: Parquet with label arrays, or CSV with label literals."""
    if as_csv:
        flat = df.withColumn("labels", lb.render(F.col("labels")))
        flat.write.mode("overwrite").partitionBy("split").csv(out, header=True, escape='"', quoteAll=True)
    else:
        df.write.mode("overwrite").partitionBy("split").parquet(out)


def tokenised(df: DataFrame, label_ids: DataFrame, buckets: int = 30000, max_len: int = 512) -> DataFrame:
    """(labels array<bigint>, input_ids array<int>, attention_mask array<tinyint>).

    The label map is a lookup of distinct labels and joins as one map value.
    """
    mapping = label_ids.agg(F.map_from_entries(F.collect_list(F.struct("label", F.col("label_id").cast("long"))))).scalar()
    tokens = tx.ws_tokens(F.col("text"))
    return df.withColumn("_ids", mapping).select(
        F.transform("labels", lambda x: F.element_at(F.col("_ids"), x)).alias("labels"),
        F.transform(lb.token_ids(tokens, buckets, max_len), lambda x: x.cast("int")).alias("input_ids"),
        lb.attention_mask(tokens, max_len).cast("array<tinyint>").alias("attention_mask"),
    )


# -- JSON results -------------------------------------------------------------------


def read_record(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON document per file: results, configurations, sidecars."""
    return spark.read.json(path, schema=schema, multiLine=True)


def read_history(spark: SparkSession, path: str, metrics: tuple[str, ...] = HISTORY_METRICS) -> DataFrame:
    """Dict of equal-length lists to (path, epoch, metric columns)."""
    schema = ", ".join(f"{m} array<double>" for m in metrics)
    rows = spark.read.json(path, schema=schema, multiLine=True).select(
        F.col("_metadata.file_path").alias("path"), F.posexplode(F.arrays_zip(*metrics)).alias("epoch", "m")
    )
    return rows.select("path", "epoch", "m.*")


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Truth spans of generated documents, one row per entity."""
    schema = (
        "id string, type string, pii_count int, "
        "pii_entities array<struct<entity:string,value:string,start:int,end:int>>"
    )
    rows = spark.read.json(path, schema=schema, multiLine=True)
    return rows.select("id", "type", F.explode_outer("pii_entities").alias("e")).select("id", "type", "e.*")


# -- reports ------------------------------------------------------------------------


def markdown_rows(results: DataFrame) -> DataFrame:
    """Comparison rows as lines of a Markdown table, best budget first."""
    line = F.format_string(
        "| %.1f | %.4f | %.4f | %+.4f | %s |",
        "epsilon", "accuracy", "f1_score", "improvement", F.coalesce(F.col("report_level"), F.lit("N/A")),
    )
    return results.orderBy(F.desc("epsilon")).select(line.alias("value"))
