"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become integers x = floor(1024 c) + 100000, so sums and deviations are exact.
Tasks sum the centred scatter in blocks; the d x d result is factored by a Cholesky
decomposition that takes the largest remaining variance first, and plane rotations make
the columns of the triangular factor orthogonal: the squared norms of the rotated columns
are the eigenvalues of the covariance, the columns divided by their norms its components.
Only sums of d or d x d numbers come to the driver. How far the whitened rows' covariance
is from the identity is measured in another pass over all of them.

Left out are vectors that are NULL, empty, hold NULL or non-finite entries, or are not as
long as most of the others (of equally frequent lengths the larger one counts). Entries
beyond 2**40 / 1024 in size count as that bound. Components without variance (less than
1e-12 of the largest) have no rows, so equal vectors or a single one give none, like an
empty table. Repeated rows and ids count as often as they occur; a NULL vec_id stays one.
A deviation of more than 63 bits is NULL. Components of equal eigenvalues are any basis
of their space. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.llm.arrow import batch
from veilmark.sources.shared import cut

SCALE, SHIFT = 1024, 100_000
#: Largest size of a scaled entry.
MOST = float(1 << 40)
#: Rows in one block of a matrix product.
BLOCK = 4096
#: Least share of the largest variance that a component has.
RANK = 1e-12


def vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and integer vectors of the rows that have ``dim`` finite entries."""
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    rows = np.flatnonzero(length == dim)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # NULL entries are NaN
    entries = flat[(np.cumsum(length) - length)[rows][:, None] + np.arange(dim)]
    finite = np.isfinite(entries).all(axis=1)
    scaled = np.floor(np.clip(entries[finite] * SCALE, -MOST, MOST))
    return rows[finite], scaled.astype(np.int64) + SHIFT


def sums(embeddings: DataFrame) -> tuple[int, list[int]]:
    """How many vectors are fitted, and their sums per dimension (none without vectors)."""
    schema = pa.schema([(c, pa.int64()) for c in ("dim", "at", "n", "high", "low")])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            lengths = pc.unique(pc.list_value_length(part["embedding"])).to_pylist()
            for dim in (d for d in lengths if d):
                x = vectors(part["embedding"], dim)[1]
                if len(x):  # in two halves, so that no sum passes 64 bits
                    yield batch(schema, [dim] * dim, range(dim), [len(x)] * dim, (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0))

    rows = embeddings.select("embedding").mapInArrow(add, "dim long, at long, n long, high long, low long")
    added = cut(rows.groupBy("dim", "at").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low"))), "sums")
    most = added.where("at = 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return 0, []
    found = added.where(F.col("dim") == most["dim"]).orderBy("at").collect()  # a row per dimension
    return most["n"], [(r["high"] << 20) + r["low"] for r in found]


class Centre:
    """Differences from the mean, n x - S, without overflow."""

    def __init__(self, n: int, total: list[int]):
        self.n, self.floor = n, np.array([s // n for s in total], np.int64)
        self.rest = [s % n for s in total]

    def doubles(self, x: np.ndarray) -> np.ndarray:
        """x - S / n."""
        return (x - self.floor).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)**2, exactly."""
        off, size = x - self.floor, self.n * np.abs(self.doubles(x)).max(initial=0) + self.n
        if size < 2.0**31 and size * size * x.shape[1] < 2.0**62:
            d = off * self.n - np.array(self.rest, np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((o * self.n - r) ** 2 for o, r in zip(row, self.rest, strict=True)) for row in off.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def _gram(embeddings: DataFrame, dim: int, of) -> np.ndarray:
    """The sum of y^T y over the rows y = of(x) of all vectors, and a last row of the sums of y."""
    schema = pa.schema([("at", pa.int32()), ("row", pa.list_(pa.float64()))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for part in batches:
            x = vectors(part["embedding"], dim)[1]
            for lo in range(0, len(x), BLOCK):
                y = of(x[lo : lo + BLOCK])
                total = total + np.vstack([y.T @ y, y.sum(axis=0)])
        if not np.isscalar(total):
            yield batch(schema, range(len(total)), list(total))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for some in batches:
            rows = some["row"].flatten().to_numpy().reshape(some.num_rows, -1)
            for at, row in zip(some["at"].to_pylist(), rows, strict=True):
                held[at] = held.get(at, 0) + row
        if held:
            yield batch(schema, list(held), list(held.values()))

    kinds = "at int, row array<double>"
    added = embeddings.select("embedding").mapInArrow(partial, kinds).repartition("at").mapInArrow(add, kinds)
    return np.array([r["row"] for r in sorted(added.collect(), key=lambda r: r["at"])])  # one row per dimension


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (rows in the order of ``a``) with a = L L^T, and the pivots; it has as many columns as ``a`` has rank."""
    d = len(a)
    left, order = a.diagonal().copy(), np.arange(d)
    lower = np.zeros((d, d))
    least = d * np.finfo(float).eps * left.max(initial=0)
    for k in range(d):
        p = k + int(np.argmax(left[order[k:]]))
        order[[k, p]] = order[[p, k]]
        own, rest = order[k], order[k + 1 :]
        if left[own] <= least:
            return lower[:, :k], order[:k]
        lower[own, k] = np.sqrt(left[own])
        lower[rest, k] = (a[rest, own] - lower[rest, :k] @ lower[own, :k]) / lower[own, k]
        left[rest] -= lower[rest, k] ** 2
    return lower, order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Disjoint pairs of columns, a round at a time; every pair is in one round."""
    ring = np.arange(n + n % 2)
    half = len(ring) // 2
    for _ in range(len(ring) - 1):
        p, q = ring[:half], ring[: half - 1 : -1]
        fit = (p < n) & (q < n)
        yield p[fit], q[fit]
        ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])


def orthogonal(lower: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``lower`` rotated in pairs until all are orthogonal."""
    w = lower.T.copy()
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(len(w)):
            a, b = w[p], w[q]
            aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            turn = np.abs(ab) > 1e-15 * np.sqrt(aa * bb)
            if not turn.any():
                continue
            turned = True
            zeta = (bb - aa)[turn] / (2 * ab[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = (1 / np.hypot(1, t))[:, None]
            s, a, b = c * t[:, None], a[turn], b[turn]
            w[p[turn]], w[q[turn]] = c * a - s * b, s * a + c * b
        if not turned:
            break
    return w.T


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns."""
    turned = orthogonal(pivoted_cholesky(covariance)[0])
    values = (turned * turned).sum(axis=0)
    first = np.argsort(-values, kind="stable")[:most]
    first = first[values[first] > RANK * values.max(initial=0)]
    return values[first], turned[:, first] / np.sqrt(values[first])


def whiten(embeddings: DataFrame, most: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each
    fitted vector and each of the first ``most`` components."""
    kinds = f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = embeddings.select("vec_id", "embedding")
    n, total = sums(rows)
    if not n:
        return embeddings.sparkSession.createDataFrame([], kinds)
    dim, centre = len(total), Centre(n, total)
    covariance = _gram(rows, dim, centre.doubles)[:dim] / n
    values, vector = components(covariance, most)
    if not len(values):
        return embeddings.sparkSession.createDataFrame([], kinds)
    axes, explained = vector / np.sqrt(values), values / covariance.trace()
    measured = _gram(rows, dim, lambda x: centre.doubles(x) @ axes) / n
    mean = measured[len(values)]
    error = float(np.abs(measured[: len(values)] - np.outer(mean, mean) - np.eye(len(values))).max())
    k = len(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            at, x = vectors(part["embedding"], dim)
            for lo in range(0, len(x), BLOCK):
                own, some = at[lo : lo + BLOCK], x[lo : lo + BLOCK]
                ids = part["vec_id"].take(pa.array(np.repeat(own, k)))
                deviation = pa.array(centre.deviations(some), pa.int64()).take(pa.array(np.repeat(np.arange(len(own)), k)))
                white = centre.doubles(some) @ axes
                m = len(own)
                columns = [
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)), deviation,
                    pa.array(white.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, kinds)
