import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import HAS_DATA, documents
from veilmark.llm import language

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    table, size = language.vocabulary(MODEL)
    p = np.random.default_rng(1).random((size, 2))
    p /= p.sum(axis=0)

    def total(word, i=0):
        """The sum over segmentations by recursion, and expected uses by enumeration."""
        if i == len(word):
            return np.ones(2)
        out = np.zeros(2)
        known = [j for j in range(i + 1, len(word) + 1) if table.get(word[i:j], -1) >= 0]
        for j in known:
            out += p[table[word[i:j]]] * total(word, j)
        if i + 1 not in known:
            out += p[size - 1] * total(word, i + 1)
        return out

    words = ["▁the", "▁therein", "▁日本a", "▁x", "▁"]
    lattice = language.Lattice(words, MODEL)
    assert np.allclose(np.exp(lattice.log_probabilities(p)), [total(w) for w in words])
    uses = lattice.expected(p, np.ones((len(words), 2)))
    letters = sum(len(w) for w in words)
    assert 0 < uses.sum() / 2 <= letters


def test_lattice_equals_a_plain_one():
    """Edges, sums and expected uses, short words as they are and long ones as logarithms."""
    table, size = language.vocabulary(MODEL)
    rng = np.random.default_rng(2)
    p = rng.dirichlet(np.ones(size), 3).T
    words = ["▁" + "".join(rng.choice(list("etaoinshrd日本жé"), n)) for n in (*range(1, 24), 60, 200)] + ["▁the", "▁the"]

    def plain(word):
        """Forward and backward sums by position as logarithms, and expected uses."""
        edges = [(i, j, q) for i in range(len(word)) for j in range(i + 1, len(word) + 1) if (q := table.get(word[i:j], -1)) >= 0]
        edges += [(i, i + 1, size - 1) for i in range(len(word)) if table.get(word[i], -1) < 0]
        a, b = np.full((len(word) + 1, 3), -np.inf), np.full((len(word) + 1, 3), -np.inf)
        a[0] = b[-1] = 0
        for i, j, q in sorted(edges, key=lambda e: e[1]):
            a[j] = np.logaddexp(a[j], a[i] + np.log(p[q]))
        for i, j, q in sorted(edges, key=lambda e: -e[0]):
            b[i] = np.logaddexp(b[i], b[j] + np.log(p[q]))
        uses = np.zeros((size, 3))
        for i, j, q in edges:
            uses[q] += np.exp(a[i] + np.log(p[q]) + b[j] - a[-1])
        return a[-1], uses

    want = [plain(w) for w in words]
    got, uses, one = np.zeros((len(words), 3)), np.zeros((size, 3)), np.zeros((size, 3))
    lots = list(language.lots(words))
    assert sorted(np.concatenate(lots).tolist()) == list(range(len(words)))
    own, n = np.arange(len(words)) % 3, rng.integers(1, 9, len(words))
    for some in (np.arange(23), np.arange(23, 25), np.array([25, 26, 3])):
        lattice = language.Lattice([words[i] for i in some], MODEL)
        assert lattice.log == bool(23 in some)
        got[some] = lattice.log_probabilities(p)
        if 25 not in some:
            uses += lattice.expected(p, np.ones((len(some), 3)))
            one += lattice.expected_in(p, own[some], n[some])
    assert np.allclose(got, [a for a, _ in want], rtol=1e-9)
    assert np.allclose(uses, sum(u for _, u in want[:25]), rtol=1e-9)
    wanted = np.zeros((size, 3))
    for i, (_, u) in enumerate(want[:25]):
        wanted[:, own[i]] += u[:, own[i]] * n[i]
    assert np.allclose(one, wanted, rtol=1e-9)


def test_long_runs_are_scored_whole():
    p = np.random.default_rng(1).dirichlet(np.ones(language.vocabulary(MODEL)[1]), 2).T
    scorer = language._Scorer(MODEL, p)
    logs = scorer.score(["the" * 100_000, "the" * 20, "x²" * 30, "²"])
    assert np.isfinite(logs[:3]).all() and np.isnan(logs[3]).all()
    assert np.allclose(logs[1], language.Lattice(["▁" + "the" * 20], MODEL).log_probabilities(p)[0])
    assert np.allclose(logs[2], language.Lattice(["▁" + "x" * 30], MODEL).log_probabilities(p)[0])


@pytest.mark.skipif(not HAS_DATA, reason="no test tables")
def test_held_out_accuracy(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    got = language.identify(table, training, MODEL).where("held_out").join(table, "doc_id")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()


def test_cases(spark):
    known = [(i, "the and of this with that") for i in range(3)]
    table = documents(spark, known).unionByName(documents(spark, [(10 + i, "der die das und nicht") for i in range(3)], "de"))
    odd = documents(spark, [(20, None), (21, ""), (22, "12 ²½ ..."), (23, "der " * 5000), (23, "the"), (None, "日本語"), (25, "x" * 500)], None)
    table = table.unionByName(odd)
    got = {(r["doc_id"], r["lang_pred"]): r for r in language.identify(table, F.col("doc_id") < 20, MODEL).collect()}
    assert {i for i, lang in got if lang == "und"} == {20, 21, 22}
    assert (23, "de") in got and (23, "en") in got and got[20, "und"]["score"] == 0
    assert got[23, "de"]["held_out"] and not got[0, "en"]["held_out"] and len(got) == 13
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in language.identify(table, F.lit(False), MODEL).collect()} == {"und"}
    assert language.identify(table.limit(0), F.lit(True), MODEL).count() == 0
    kept = language.keep_known(table, MODEL)
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} >= {0, 10, 23}
