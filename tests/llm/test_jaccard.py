import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import HAS_DATA, SF, documents
from veilmark.llm import graph, jaccard, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, width):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[k:] for k in range(width))))


def brute_force(rows, width, num, den):
    """(doc_id, set size, smallest id reachable), by an inverted index over all shingles."""
    sets = {i: shingle_set(t, width) for i, t in rows}
    holders, root = defaultdict(list), {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, own in sets.items():
        for j, common in Counter(j for s in own for j in holders[s]).items():
            if den * common >= num * (len(own) + len(sets[j]) - common):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(i)
    return sorted((i, len(s), top(i)) for i, s in sets.items())


def found(table, width, num, den):
    return sorted(tuple(r) for r in jaccard.join(table, width, num, den).collect())


def test_sets_are_those_of_the_words():
    texts = ["A b\tc\x0bd é", None, "", " ", "one", "One tWo", "x  y z x y z x", "ẞ Ä a", "w" * 3_000_000 + " a b c", "a\x85b c d\u3000e"]
    got = shingles.sets(pa.array(texts), 3)
    assert [len(g) for g in got] == [len(shingle_set(t, 3)) for t in texts]
    a, b, c = shingles.sets(pa.array(["one two three", "ONE two\nthree", "one two  four"]), 3)
    assert (a == b).all() and a[0] != c[0]


def test_trie_equals_brute_force():
    rng = random.Random(4)
    base = [rng.sample(range(60), 25) for _ in range(4)]
    sets = [np.array(sorted({*rng.sample(rng.choice(base), 20), *rng.sample(range(60), rng.randint(0, 3))}), np.uint64) for _ in range(60)]
    sets += [np.array([3], np.uint64), np.array([3], np.uint64), sets[0]]
    for num, den in ((90, 100), (80, 100), (50, 100), (1, 1)):
        got = {(int(q), row) for row, hits in jaccard.Trie(sets).run(sets, num, den) for q in hits}
        want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if den * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b))}
        assert got == want


def test_bitmaps_never_differ_more_than_sets():
    rng = np.random.default_rng(5)
    for n in (3, 900, 2500, 5000):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: int(n * 0.8)], rng.integers(0, 1 << 63, n // 3).astype(np.uint64)]))
        a, b = sorted((m.view(np.uint64) for m in jaccard.bitmaps([x, y])), key=len)
        if len(b) == 2 * len(a):
            b = b[: len(a)] ^ b[len(a) :]
        assert len(a) == len(b) and np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))
    assert [len(m) * 64 for m in jaccard.bitmaps([x[:0], x[:1024], x[:1026], x[:4096]])] == [512, 512, 1024, 2048]


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7)]
    root = list(range(1000))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: top(x) for a, b in pairs if a != b for x in (a, b)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.skipif(not HAS_DATA, reason="no test tables")
def test_tables(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    for width, num in ((3, 90), (5, 80)):
        assert found(table, width, num, 100) == brute_force(rows, width, num, 100)


@pytest.mark.parametrize("few, rows_of_block, grams", [(8, 2048, 1 << 18), (2, 8, 300)])
def test_hard_groups(spark, monkeypatch, few, rows_of_block, grams):
    """Chains, near copies around the threshold, a passage in all texts; many blocks."""
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", rows_of_block)
    monkeypatch.setattr(jaccard, "TRIE_GRAMS", grams)
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(25)]
    rows, words = [], [f"w{i}" for i in range(40)]
    for i in range(60):  # a chain: each differs a little from the one before
        words = [*words]
        words[rng.randrange(40)] = f"c{i}"
        rows.append((i, " ".join(words)))
    base = [f"b{i}" for i in range(60)]
    for i in range(100, 160):
        copy = [*base]
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(60)] = f"e{rng.randrange(30)}"
        rows.append((i, " ".join(copy)))
    rows += [(200 + i, " ".join([*passage, *(f"u{i}_{k}" for k in range(rng.randint(0, 12)))])) for i in range(60)]
    rows += [(300 + i, "same text again") for i in range(20)] + [(400, None), (401, ""), (402, "one"), (403, "ONE"), (404, "a b"), (405, "long " * 30_000)]
    words = [f"v{k}" for k in range(3000)]
    rows += [(500 + i, " ".join(words[: 3000 - 90 * i] + [f"t{i}_{k}" for k in range(5)])) for i in range(8)]
    rng.shuffle(rows)
    table = documents(spark, rows)
    for width, num in ((3, 90), (5, 80), (3, 60)):
        assert found(table, width, num, 100) == brute_force(rows, width, num, 100)


def test_repeated_and_missing_ids(spark):
    table = documents(spark, [(1, "a b c d"), (1, "a b c d"), (1, "x y z"), (2, "x y z"), (None, "a b c d"), (3, None)])
    assert sorted(map(str, found(table.limit(0), 3, 90, 100))) == []
    got = sorted((tuple(r) for r in jaccard.join(table).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (1, 1, 1), (2, 1, 1), (None, 2, None), (3, 0, 3)], key=str)
    kept = jaccard.keep_first(table, 3, 90, 100)
    assert kept.columns == table.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, "a b c d"), (1, "x y z"), (None, "a b c d"), (3, None)], key=str)
