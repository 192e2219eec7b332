"""Reading the Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: A table of at most this many bytes may be one row group that holds all its rows.
ONE_GROUP = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for CPU-heavy work on a small file.

    A small file may hold all rows in one row group, which one task reads. Tables of more
    than ``ONE_GROUP`` bytes are read as they are: their rows never move.
    """
    session = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > ONE_GROUP:
        return df
    return df.repartition(max(1, min(session.sparkContext.defaultParallelism, size >> 16)))


def texts(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    """A text table, spread over the cores."""
    return spread(read(spark, folder, name))
