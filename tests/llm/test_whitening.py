import math

import numpy as np
import pytest

from tests.llm.helpers import HAS_DATA, SF
from veilmark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], SCHEMA)


def wanted(vectors):
    """n, exact deviations, whitened values up to sign and shares, by a plain eigen decomposition."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, total = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, total)) for row in x]
    y = np.array([[(n * c - s) / n for c, s in zip(row, total)] for row in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    return n, deviation, np.abs(y @ u / np.sqrt(e)), e / (y * y).sum() * n


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    for d, rank in ((1, 1), (5, 5), (12, 4), (65, 65), (30, 29)):
        y = rng.normal(size=(200, rank)) @ rng.normal(size=(rank, d)) * 10.0 ** rng.integers(-3, 3, d)
        v = y.T @ y / 200
        lower, order = whitening.pivoted_cholesky(v)
        assert lower.shape[1] == rank and np.allclose(lower @ lower.T, v, rtol=1e-9, atol=1e-12 * v.max())
        assert np.allclose(np.triu(lower[order], 1), 0) and (np.diff(np.diag(lower[order])) <= 1e-12 * v.max()).all()
        e, u = whitening.components(v, 8)
        want = np.linalg.eigvalsh(v)[::-1][: len(e)]
        assert np.allclose(e, want, rtol=1e-9, atol=1e-13 * want[0]) and np.allclose(u.T @ u, np.eye(len(e)), atol=1e-9)
        assert np.allclose(v @ u, u * e, atol=1e-10 * want[0])
    for n in (1, 2, 5, 8):
        pairs = [tuple(sorted(x)) for p, q in whitening._rounds(n) for x in zip(p.tolist(), q.tolist())]
        assert sorted(pairs) == [(i, j) for i in range(n) for j in range(i + 1, n)]


def check(rows, vectors, ids):
    n, deviation, white, share = wanted(vectors)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    k = max(c for _, c in by)
    assert len(by) == len(rows) == len(ids) * k and k == min(8, len(vectors[0]))
    for i, d, w in zip(ids, deviation, white):
        for c in range(k):
            r = by[i, c + 1]
            assert r["n"] == n and r["deviation"] == d and abs(r["explained"] - share[c]) <= 1e-9 and r["identity_error"] < 1e-9
            assert abs(abs(r["whitened"]) - w[c]) < 1e-7 * max(1, w[c])
    signs = np.array([[by[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    assert np.abs(signs.T @ signs / n - np.eye(k)).max() < 1e-9


def test_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    for d in (3, 20):
        vectors = (rng.normal(size=(300, d)) * rng.uniform(0.05, 1, d)).astype(np.float32).tolist()
        vectors += vectors[:7]  # repeated
        odd = [None, [], [1.0] * (d + 1), [math.nan] * d, [None] + [0.1] * (d - 1), [math.inf] + [0.0] * (d - 1)]
        rows = whitening.whiten(table(spark, odd[:3] + vectors + odd[3:]).repartition(5)).collect()
        check(rows, vectors, range(3, 3 + len(vectors)))


@pytest.mark.skipif(not HAS_DATA, reason="no tables")
def test_given_table(spark):
    embeddings = spark.read.parquet(f"{SF}/embeddings.parquet")
    held = [(r["vec_id"], r["embedding"]) for r in embeddings.collect() if r["embedding"] and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    check(whitening.whiten(embeddings).collect(), [v for _, v in held], [i for i, _ in held])


def test_without_variance_or_rows(spark):
    for vectors in ([], [None, []], [[0.5, 0.25]], [[0.5, 0.25]] * 4):
        assert whitening.whiten(table(spark, vectors)).count() == 0
    rows = whitening.whiten(table(spark, [[0.5, 0.0, 0.1], [0.5, 1.0, 0.1], [0.5, 0.5, 0.1]])).collect()
    assert {r["component"] for r in rows} == {1} and len(rows) == 3 and all(abs(r["explained"] - 1) < 1e-9 for r in rows)


def test_large_values_are_exact(spark):
    centre = whitening.Centre(3, [6, 3 << 50])
    x = np.array([[1, 1 << 50], [5, (1 << 50) + 7], [0, (1 << 50) + (1 << 34)]])
    assert centre.deviations(x) == [9, 81 + 441, None if 9 << 68 >= 1 << 63 else 0]
    rows = whitening.whiten(table(spark, [[1e30, 0.0], [-1e30, 0.5], [0.0, 1.0]])).collect()
    assert len(rows) == 6 or len(rows) == 3
    assert all(math.isfinite(r["whitened"]) for r in rows)


def test_clashing_columns_and_null_ids(spark):
    rows = [(None, [0.5, 1.0], 1, 2, 3.0), (4, [1.0, 0.5], 1, 2, 3.0), (4, [0.0, 0.25], None, None, None)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int, n int, whitened double")).collect()
    assert sorted((r["vec_id"] or -1, r["component"]) for r in out) == [(-1, 1), (-1, 2), (4, 1), (4, 1), (4, 2), (4, 2)]
