"""Fixtures that several tests share."""

from __future__ import annotations

import os

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
HAS_DATA = os.path.isdir(SF)

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


def documents(spark, rows, lang="en"):
    """A documents table of (doc_id, text), with columns whose names clash with results."""
    table = spark.createDataFrame([(i, t, lang, None, None if t is None else len(t)) for i, t in rows], DOCUMENTS)
    return table.selectExpr("*", "1 AS score", "'x' AS n", "2 AS rep", "'y' AS component_id", "0 AS length", "array(1) AS w")
