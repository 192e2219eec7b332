"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.sources.shared import cut


def components(links: DataFrame) -> DataFrame:
    """id, component: the smallest id that ``links`` (a, b) lead to, for every id that
    has a link to another one.

    Large-star and small-star steps: all neighbours above an id, then all below it, are
    tied to its smallest neighbour until nothing changes. Every step is an aggregation
    and a join by id; it is written to the shared folder before the next.
    """
    edges = cut(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state["n"] == 0 or state == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.union(lower.select("u", F.col("m").alias("v"))).distinct(), "edges")
