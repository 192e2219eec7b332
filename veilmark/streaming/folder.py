"""Incremental redaction of a folder: new files in, redacted rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veilmark.plans.redact import redact_documents
from veilmark.sources import files

_BINARY = "path string, modificationTime timestamp, length long, content binary"


def read_stream(spark: SparkSession, folder: str, glob: str = "*.txt", max_files: int | None = None) -> DataFrame:
    """(doc_id, path, text, error) of files as they arrive, one row per file."""
    reader = spark.readStream.format("binaryFile").schema(_BINARY).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    found = files.decode(reader.load(folder).select("path", "content"))
    return found.select(
        F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("doc_id"), "path", "text", "error"
    )


def redact_stream(
    spark: SparkSession, folder: str, out: str, checkpoint: str, style: str = "mask",
    categories: list[str] | None = None, max_files: int | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Stateless and exactly once: the same projection as the batch job, a
    checkpointed file sink, and only files not seen before."""
    done = redact_documents(read_stream(spark, folder, max_files=max_files), style=style, categories=categories)
    rows = done.select(
        "doc_id", "path", "error", files.redacted_name(F.col("path")).alias("output_file"), "result"
    )
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def redact_table_stream(table: DataFrame, out: str, checkpoint: str, text: str = "text", style: str = "mask") -> StreamingQuery:
    """Same for a stream of rows that already hold a text column."""
    done = redact_documents(table, text, style)
    rows = done.select(*[c for c in table.columns if c != text], "result")
    return (
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
