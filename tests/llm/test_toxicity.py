import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import HAS_DATA, documents
from veilmark.llm import toxicity


def test_risk_corrects_for_the_prior():
    """The unlabelled rows hold as many positives as the prior says: the classifier must
    find them, and must leave the others alone."""
    rng = np.random.default_rng(0)

    def row(toxic):
        return np.array(sorted({*rng.integers(100, 400, 20).tolist(), *([int(rng.integers(0, 10))] if toxic else [])}))

    positive = [row(True) for _ in range(600)]
    hidden = [row(True) for _ in range(240)]
    clean = [row(False) for _ in range(2160)]
    c = toxicity._fit(positive, hidden + clean, 0.1, 200, 0.1, 2e-4, 8, 5.0)

    def found(rows):
        return np.mean([c.bias + sum(c.weights.get(f, 0.0) for f in r.tolist()) >= 0 for r in rows])

    assert found(hidden) > 0.9 and found(clean) < 0.02


@pytest.mark.skipif(not HAS_DATA, reason="no test tables")
def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    table, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    classifier = toxicity.train(table, labels, ~held_out)
    got = toxicity.score(table.where(held_out), classifier).join(labels, "doc_id")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] > 0.85 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) < 0.03 * (n[0, 0] + n.get((0, 1), 0))


def test_cases(spark):
    rows = [(i, f"a quiet {'fool' if i % 4 == 0 else 'word'} number {i}") for i in range(2000)]
    rows += [(3000, None), (3001, ""), (3002, "fool " * 20_000), (3003, "x"), (3003, "x"), (None, "fool")]
    table = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 2000, 3)] + [(None, 1, 1), (5, None, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    classifier = toxicity.train(table, labels, F.lit(True))
    got = {(r["doc_id"]): r for r in toxicity.score(table, classifier).collect()}
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[3002]["predicted"] == got[None]["predicted"] == got[4]["predicted"] == 1
    assert got[3000]["score"] == got[3001]["score"] < 0.5 and not got[1]["predicted"]
    kept = toxicity.keep_clean(table, labels)
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["predicted"]}
    assert toxicity.train(table, labels.where("toxic = 0"), F.lit(True)) is None
    assert {r["score"] for r in toxicity.score(table, None).collect()} == {0.0}
    assert toxicity.keep_clean(table.limit(0), labels.limit(0)).count() == 0


def test_the_prior_is_the_measured_share(spark, monkeypatch):
    given = []
    monkeypatch.setattr(toxicity, "_fit", lambda p, u, prior, *_: given.append(prior) or toxicity.Classifier({}, 0.0))
    table = documents(spark, [(i, f"bad words {i}") for i in range(1000)])
    for n in (1, 700):
        labels = spark.range(1000).selectExpr("id AS doc_id", f"CAST(id < {n} AS INT) AS toxic")
        monkeypatch.setattr(toxicity, "LEAST", 1)
        toxicity.train(table, labels, F.lit(True), members=1)
    assert given == [0.001, 0.7]


def sparse(rows):
    """``_risk``'s form of lists of features."""
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([f for r in rows for f in r], int), len(rows)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(1)
    data = {k: sparse([rng.choice(8, 3, replace=False).tolist() for _ in range(n)]) for k, n in (("p", 20), ("u", 45))}
    w = rng.normal(0, 1, 9)
    parts = toxicity._risk(w, data, 0.3)
    for part in (0, 1):
        for i in range(9):
            d = np.zeros(9)
            d[i] = 1e-6
            slope = (toxicity._risk(w + d, data, 0.3)[part] - toxicity._risk(w - d, data, 0.3)[part]) / 2e-6
            assert parts[2 + part][i] == pytest.approx(slope, abs=1e-7)


def test_scores_equal_a_plain_fit(spark):
    """The same risk over dense rows, a row at a time, from the texts themselves."""
    rng = np.random.default_rng(2)
    common, bad = [f"w{c}" for c in "abcdefghij"], ["vile", "nasty"]
    texts = [" ".join(rng.choice(common, 6)) + (f" {rng.choice(bad)}" if i % 5 == 0 else "") for i in range(300)]
    texts = [re.sub(r"w(\w)", r"\1\1", t) for t in texts]
    table = documents(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 300, 2)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(table, toxicity.train(table, labels, F.lit(True), members=1)).collect()}

    def features(text):
        words = re.findall("[a-z]+", text)
        return {zlib.crc32(f.encode()) for w in words for f in (w, *("^" + w[:k] for k in toxicity.PREFIXES if len(w) >= k))}

    rows = [features(t) for t in texts]
    positive, prior = [rows[i] for i in range(0, 300, 10)], 0.2
    names = sorted(set().union(*rows))
    seen = np.array([sum(f in r for r in positive) for f in names]) + 0.5
    other = np.array([sum(f in r for r in rows) for f in names]) + 0.5
    sure = np.abs(np.log(seen / 30) - np.log(other / 300)) >= 5 * np.sqrt(1 / seen + 1 / other)
    names = [f for f, s, n in zip(names, sure, seen, strict=True) if s and n >= toxicity.LEAST]
    p, u = (np.array([[*(f in r for f in names), 1.0] for r in of], float) for of in (positive, rows))
    w, m, v = np.append(np.zeros(len(names)), np.log(prior / (1 - prior))), 0, 0
    for step in range(1, 201):
        zp, zu = p @ w, u @ w
        rest = np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean()
        g_rest = (u / (1 + np.exp(-zu))[:, None]).mean(axis=0) - prior * (p / (1 + np.exp(-zp))[:, None]).mean(axis=0)
        g = -g_rest if rest < 0 else g_rest - prior * (p / (1 + np.exp(zp))[:, None]).mean(axis=0)
        g[:-1] += 2e-4 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    want = 1 / (1 + np.exp(-(u @ w)))
    assert len(names) > 1 and [got[i] for i in range(300)] == pytest.approx(want.tolist(), rel=1e-6)


def test_few_rows_and_clashing_columns(spark):
    table = documents(spark, [(0, "bad"), (1, "good"), (None, "bad")]).selectExpr("*", "1 AS score", "2 AS predicted", "3 AS toxic")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    classifier = toxicity.train(table, labels, F.lit(True))
    got = toxicity.score(table, classifier)
    assert got.columns == ["doc_id", "score", "predicted"] and got.count() == 3
    assert toxicity.train(table.limit(0), labels, F.lit(True)) is None and toxicity.score(table.limit(0), None).count() == 0
