"""Groups of any size as tasks of bounded size, and joins with few ids.

A group is dealt out over blocks; every pair of blocks is a task, so that each pair of
members meets in exactly one task that holds at most two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Most ids that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def small(ids: DataFrame) -> DataFrame:
    """``ids`` (a written table of narrow rows), to be broadcast if it is small enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def only(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is in ``ids`` (doc_id, distinct), with the columns of ``documents``."""
    return documents.join(small(ids), "doc_id", "left_semi").select(*documents.columns)


def tasks(members: DataFrame, group: str, member: str, n_blocks: Column) -> DataFrame:
    """``members`` with the columns task, block, block_i and block_j: a row for each task
    the member is in. ``n_blocks`` is the same for all rows of a group."""
    own = F.pmod(F.xxhash64(member, F.lit(3)), F.col("__blocks")).cast("int")
    spread = members.withColumn("__blocks", n_blocks.cast("int")).withColumn("block", own).withColumn(
        "__other", F.explode(F.expr("sequence(0, __blocks - 1)"))
    )
    return (
        spread.withColumn("block_i", F.least("block", "__other"))
        .withColumn("block_j", F.greatest("block", "__other"))
        .withColumn("task", F.xxhash64(group, "block_i", "block_j"))
        .drop("__blocks", "__other")
    )


def together(rows: DataFrame, *key: str) -> DataFrame:
    """Rows of a key next to each other in one partition."""
    return rows.repartition(*key).sortWithinPartitions(*key)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The tables of consecutive rows with the same ``key`` (not NULL)."""
    held: list[pa.RecordBatch] = []
    for part in batches:
        if not part.num_rows:
            continue
        values = part[key].to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), part.num_rows]
        if held and held[-1][key][0].as_py() != values[0]:
            yield pa.Table.from_batches(held)
            held = []
        for lo, hi in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield pa.Table.from_batches([*held, part.slice(lo, hi - lo)])
            held = []
        held.append(part.slice(cuts[-2]))
    if held:
        yield pa.Table.from_batches(held)
