"""Near-duplicate embeddings by lattice hashing.

Unit vectors are projected at random to a few blocks of eight dimensions, and each block
is decoded to its E8 lattice point; the points of a table form a cell. Every vector goes
to its own cell and, block by block, to the ``PROBES`` lattice cells next nearest to it,
in each of several tables. Vectors that share a cell are verified by cosine in double
precision, and links give components. The number of links of a vector is then counted
exactly over all members of its component, block by block, without writing pairs.

Vectors link only with equal labels that are not NULL and equal dimensions. NULL or zero
vectors, and those with NULL or non-finite components, link with nothing. Equal vectors
of a label are one class with a multiplicity. Every row gets one row, also one whose id
repeats (it is then a vector of its own under the same id); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.llm import blocks, graph
from veilmark.llm.arrow import batch
from veilmark.sources.shared import cut

TABLES = 4
BLOCKS = 2
PROBES = 3
SCALE = 2.2
#: Vectors in one block of a task.
BLOCK_ROWS = 1024


@cache
def projection(table: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions of a table, scaled so that cells do not depend on ``dims``."""
    rng = np.random.default_rng([table, dims])
    q, _ = np.linalg.qr(rng.standard_normal((dims, min(dims, 8 * BLOCKS))))
    out = np.zeros((dims, 8 * BLOCKS))
    out[:, : q.shape[1]] = q
    return out * (SCALE * np.sqrt(max(dims, 8 * BLOCKS) / 8.0)), rng.random(8 * BLOCKS)


@cache
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of 1 or -1, or all of a half with an
    even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1.0, -1.0):
                for b in (1.0, -1.0):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for signs in range(256):
        v = np.array([0.5 if signs >> k & 1 else -0.5 for k in range(8)])
        if (v < 0).sum() % 2 == 0:
            out.append(v)
    return np.array(out)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum."""
    y = np.rint(x)
    odd = np.flatnonzero(y.sum(axis=1) % 2)
    if len(odd):
        gap = x[odd] - y[odd]
        k = np.argmax(np.abs(gap), axis=1)
        y[odd, k] += np.where(gap[np.arange(len(odd)), k] >= 0, 1, -1)
    return y


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(nearer[:, None], half, whole)


def _mix(cells: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of doubled lattice coordinates."""
    h = np.full(len(cells), 0x9E3779B97F4A7C15, np.uint64)
    for column in np.rint(2 * cells).astype(np.int64).T.astype(np.uint64):
        h = (h ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def cells(vectors: np.ndarray, table: int) -> np.ndarray:
    """Hashes of the cells each unit vector goes to: its own first, then the probed ones."""
    directions, shift = projection(table, vectors.shape[1])
    x = vectors @ directions + shift
    own = [decode(x[:, 8 * b : 8 * b + 8]) for b in range(BLOCKS)]
    out = [_mix(np.hstack(own))]
    for b in range(BLOCKS):
        toward = (x[:, 8 * b : 8 * b + 8] - own[b]) @ shortest().T
        best = np.argpartition(-toward, PROBES, axis=1)[:, :PROBES]
        for k in range(PROBES):
            moved = [*own]
            moved[b] = own[b] + shortest()[best[:, k]]
            out.append(_mix(np.hstack(moved)))
    return np.stack(out, axis=1)


def _unit(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _keys(classes: DataFrame) -> DataFrame:
    """cell, rep: the cells of each class, over all tables."""
    schema = pa.schema([("cell", pa.int64()), ("rep", pa.int64())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            dims, labels = part["dims"].to_numpy(), part["label"].to_numpy()
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                x = _unit(part["embedding"].take(pa.array(own)), int(d))
                rep = part["rep"].to_numpy()[own]
                for table in range(TABLES):
                    salt = _mix(np.stack([labels[own], dims[own], np.full(len(own), table)], axis=1).astype(float))
                    key = cells(x, table) ^ salt[:, None]
                    yield batch(schema, key.ravel().view(np.int64), np.repeat(rep, key.shape[1]))

    return classes.select("rep", F.col("label").cast("long").alias("label"), "dims", "embedding").mapInArrow(hashed, "cell long, rep long")


def _forest(near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that join what ``near`` (a matrix) joins, one less than members."""
    fresh = np.ones(len(near), bool)
    for start in range(len(near)):
        if not fresh[start]:
            continue
        fresh[start] = False
        queue = [start]
        while queue:
            a = queue.pop()
            for b in np.flatnonzero(near[a] & fresh).tolist():
                fresh[b] = False
                yield a, b
                queue.append(b)


def _links(rows: DataFrame, threshold: float) -> DataFrame:
    """a, b: links that join what is linked within each task."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in blocks.groups(batches, "task"):
            if group.num_rows > 1:
                rep = group["rep"].to_numpy()
                x = _unit(group["embedding"], int(group["dims"][0].as_py()))
                found += [(rep[a], rep[b]) for a, b in _forest(x @ x.T >= threshold)]
            if len(found) > 10_000:
                yield batch(schema, *zip(*found, strict=True))
                found = []
        if found:
            yield batch(schema, *zip(*found, strict=True))

    return blocks.together(rows.select("task", "rep", "dims", "embedding"), "task").mapInArrow(verify, "a long, b long")


def _counts(rows: DataFrame, threshold: float) -> DataFrame:
    """rep, n: per task, how many vectors of other classes a class links with."""
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in blocks.groups(batches, "task"):
            rep, mult, block = (group[c].to_numpy() for c in ("rep", "mult", "block"))
            x = _unit(group["embedding"], int(group["dims"][0].as_py()))
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            if group["block_i"][0] != group["block_j"][0]:
                near &= block[:, None] != block[None, :]  # pairs of one block have a task of their own
            yield batch(schema, rep, near.astype(np.int64) @ mult)

    columns = ("task", "rep", "dims", "embedding", "mult", "block", "block_i", "block_j")
    return blocks.together(rows.select(*columns), "task").mapInArrow(count, "rep long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    sound = (
        "label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) "
        "AND abs(x) < double('infinity')) AND exists(embedding, x -> x != 0)"
    )
    marked = vectors.select("vec_id", "label", "embedding").withColumn("sound", F.coalesce(F.expr(sound), F.lit(False)))
    same = {"h1": F.xxhash64("embedding"), "h2": F.xxhash64("embedding", F.lit(1))}
    good = marked.where("sound").withColumns(same)
    keys = ["label", "h1", "h2"]
    classes = cut(
        good.groupBy(*keys).agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"), F.first("embedding").alias("embedding"))
        .withColumn("dims", F.size("embedding")),
        "classes",
    )
    placed = cut(_keys(classes).distinct(), "cells")
    shared = placed.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    members = placed.join(shared, "cell")
    tasks = blocks.tasks(members, "cell", "rep", F.ceil(F.col("n") / BLOCK_ROWS))
    found = _links(tasks.join(classes, "rep"), threshold)
    joined = cut(graph.components(found).withColumnRenamed("id", "rep"), "components")
    sizes = joined.groupBy("component").agg(F.count("*").alias("n"))
    grouped = joined.join(sizes, "component").join(classes, "rep")
    counted = _counts(blocks.tasks(grouped, "component", "rep", F.ceil(F.col("n") / BLOCK_ROWS)), threshold)
    n_links = counted.groupBy("rep").agg(F.sum("n").alias("others"))
    of_class = (
        classes.select(*keys, "rep", "mult").join(joined, "rep", "left").join(n_links, "rep", "left")
        .select(*keys, (F.col("mult") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    alone = marked.where(~F.col("sound")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    rows = good.select("vec_id", *keys).join(of_class, keys).select("vec_id", "n_links", "component_id").unionByName(alone)
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
