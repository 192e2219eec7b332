"""A corpus of texts to packed training sequences.

Each stage takes (spark, documents, folder), works on all rows that the one before it
kept, and is written as Parquet and read again for the next one. All but the last return
the columns of ``documents``; the last returns the pieces and their places. Tables of the
folder other than ``documents`` are read where a stage needs them.

NULL and empty texts have no letter, so the language stage takes them out; before it they
count as texts without words. Of documents that are copies the one with the least doc_id
stays, of rows that repeat its id and text one; rows without an id all stay. Texts of any
length are read whole. A folder whose ``documents`` are empty gives no pieces; without ``labels`` or
``benchmark`` rows nothing is toxic or contaminated. Further columns of ``documents`` pass
through all stages but the last, under any name.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from veilmark.llm import decontaminate, jaccard, language, packing, toxicity
from veilmark.sources.shared import cut
from veilmark.sources.tables import read


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that are scored as toxic."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter or no language with half of the likelihood."""
    return language.keep_known(docs, public_tokenizers.path("piece_bpe_32k.model"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return jaccard.keep_first(docs, width=5, num=80, den=100)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("toxicity", not_toxic),
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: The stages learn models and name sets by hashes that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
