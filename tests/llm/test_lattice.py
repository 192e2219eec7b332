import numpy as np
from pyspark.sql import functions as F

from veilmark.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, threshold=0.98):
    out = {}
    good = [(i, np.array(v, float), y) for i, v, y in rows if v and y is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i, *_ in rows}
    for a, (i, v, y) in enumerate(good):
        for j, u, z in good[:a]:
            if y == z and len(u) == len(v) and (v @ u) / np.sqrt((v @ v) * (u @ u)) >= threshold:
                near[i].add(j)
                near[j].add(i)
    for i in near:
        seen, queue = {i}, [i]
        while queue:
            for j in near[queue.pop()] - seen:
                seen.add(j)
                queue.append(j)
        out[i] = (len(near[i]), min(seen), i == min(seen))
    return out


def test_decoding_gives_the_nearest_point():
    x = np.random.default_rng(1).uniform(-2, 2, (300, 8))
    points = lattice.decode(x)
    doubled = np.rint(2 * points)
    assert (doubled == 2 * points).all() and ((doubled % 2 == 0).all(axis=1) | (doubled % 2 == 1).all(axis=1)).all()
    assert (points.sum(axis=1) % 2 == 0).all()
    own = ((x - points) ** 2).sum(axis=1)
    around = ((x[:, None] - points[:, None] - lattice.shortest()[None]) ** 2).sum(axis=2).min(axis=1)
    assert len(lattice.shortest()) == 240 and (own <= around + 1e-9).all()


def test_recall_of_the_cells():
    rng = np.random.default_rng(2)
    for dims in (8, 64, 300):
        x = rng.standard_normal((2000, dims))
        x /= np.linalg.norm(x, axis=1)[:, None]
        other = rng.standard_normal(x.shape)
        other -= (other * x).sum(axis=1)[:, None] * x
        y = 0.98 * x + np.sqrt(1 - 0.98**2) * other / np.linalg.norm(other, axis=1)[:, None]
        met = np.zeros(len(x), bool)
        for table in range(lattice.TABLES):
            a, b = lattice.cells(x, table), lattice.cells(y, table)
            met |= (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
        assert met.mean() >= 0.99


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    rows = []
    for k in range(6):
        base = rng.standard_normal(16)
        for _ in range(25):
            rows.append((len(rows), (base + 0.12 * rng.standard_normal(16)).tolist(), k % 2))
    rows = [(i, np.array(v, np.float32).astype(float).tolist(), y) for i, v, y in rows]
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(30)] + [(1100, [2 * x for x in rows[3][1]], rows[3][2]), (1101, rows[3][1], 5), (1102, rows[3][1], None)]
    bad = [1.0] * 15
    rows += [(1200, None, 0), (1201, [0.0] * 16, 0), (1202, [None, *bad], 0), (1203, [float("nan"), *bad], 0), (1204, [float("inf"), *bad], 0), (1205, [], 0)]
    rows += [(1300, [1.0, 0.0], 0), (1301, [1.0, 0.01], 0), (1302, [-1.0, 0.0], 0), (1303, [3.0], 0), (1304, [4.0], 0)]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "rep": F.lit("x"), "component": F.lit(0)})
    got = {r["vec_id"]: tuple(r)[1:] for r in lattice.near_duplicates(table).collect()}
    assert got == brute_force(rows)
    assert lattice.near_duplicates(table.limit(0)).count() == 0


def test_repeated_ids(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (None, [1.0, 0.0], 0)], SCHEMA)
    got = sorted(map(str, (tuple(r) for r in lattice.near_duplicates(table).collect())))
    assert got == sorted(map(str, [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (None, 0, None, True)]))
