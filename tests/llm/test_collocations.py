import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import HAS_DATA, SF
from veilmark.llm import collocations as co

SCHEMA = "text string, lang string"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute_force(rows, least=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(zip(*(w[i:] for i in range(k))))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = defaultdict(int)
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        kept = []
        for p, a in found.items():
            if 100 * longer[p] >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def mined(spark, rows, schema=SCHEMA, **kw):
    table = spark.createDataFrame(rows, schema).repartition(4)
    return sorted(tuple(r[c] for c in COLUMNS) for r in co.mine(table, **kw).collect())


def texts(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "é", "Das", "new", "York", "x\x85y", "語"]
    fixed = ["new York city", "NEW york", "a b a b a b a b", "one two three four five", "two three four"]
    out = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(rng.randint(0, 12))]
        out.append(("".join(p + rng.choice([" ", "\t ", ". ", ",", "\n", "!", "\x0b", " ; "]) for p in parts), rng.choice(["en", "en", "en", "de", None])))
    return out


def test_trie_equals_a_dictionary():
    rng = np.random.default_rng(5)
    for length, top, n in ((2, 40, 300), (3, 300, 2000), (4, 70_000, 3000), (2, 1, 1), (2, 2000, 60_000)):
        phrases = np.unique(rng.integers(0, top, (n, length)), axis=0)
        ids = rng.integers(-1, top + 600, 20_000).astype(np.int32)
        for p in phrases[rng.integers(0, len(phrases), 500)]:
            i = int(rng.integers(0, len(ids) - length))
            ids[i : i + length] = p
        trie = co.Trie(phrases)
        number = {tuple(p): i for i, p in enumerate(phrases.tolist())}
        want = [(i, number[t]) for i in range(len(ids) - length + 1) if (t := tuple(ids[i : i + length].tolist())) in number]
        assert list(zip(*(x.tolist() for x in trie.run(ids)))) == want and len(want) > 0
        assert trie.run(ids[: length - 1])[0].size == 0 and trie.run(ids[:0])[0].size == 0


@pytest.mark.parametrize("limits", [{}, {"words": 12, "phrases": 40}])
def test_equals_brute_force(spark, monkeypatch, limits):
    if limits:
        monkeypatch.setattr(co, "HELD", 10)
    rows = texts(3)
    got = mined(spark, rows, least=8, **limits)
    assert got == brute_force(rows, least=8) and len({r[0] for r in got}) == 3 and max(len(r[2].split()) for r in got) == 4
    assert not limits or mined(spark, rows, least=8, top=5, **limits) == brute_force(rows, least=8, top=5)


@pytest.mark.parametrize(("limits", "tries"), [({}, 1), ({"phrases": 40}, 2)])
def test_one_pass_over_the_streams_a_level(spark, monkeypatch, limits, tries):
    """Counts of a level and phrases of the next come from one run of its tries."""
    written, levels = [], []
    monkeypatch.setattr(co, "cut", lambda df, name, cut=co.cut: written.append(name) or cut(df, name))
    monkeypatch.setattr(co, "_tries", lambda *a, own=co._tries: levels.append(own(*a)) or levels[-1])
    rows = texts(4)
    assert mined(spark, rows, least=8, **limits) == brute_force(rows, least=8)
    assert [written.count(x) for x in ("words", "vocabulary", "streams", "counts")] == [1] * 4
    assert len(written) - 4 == 1 + sum(len(x) for x, _ in levels) and len(levels) == co.LONGEST - 1
    assert max(len(x) for x, _ in levels) >= tries and (limits or len(written) - 4 == co.LONGEST)
    assert all((ends is not None) == (len(x) > 1 and length < co.LONGEST) for length, (x, ends) in enumerate(levels, 2))


def test_four_passes_for_phrases_of_four_words(spark, monkeypatch):
    written = []
    monkeypatch.setattr(co, "cut", lambda df, name, cut=co.cut: written.append(name) or cut(df, name))
    mined(spark, texts(5), least=8)
    assert len([x for x in written if x not in ("words", "vocabulary", "streams", "counts")]) == 4


def test_tries_of_a_large_level(spark):
    n = 300_000
    pairs = np.column_stack([np.arange(n) % 700, np.arange(n) // 7 * 31 % 90_000]).astype(np.int32)
    pairs = np.unique(pairs, axis=0)
    n, known = len(pairs), set(map(tuple, pairs.tolist()))
    candidates = spark.createDataFrame(pa.table({"w": pa.FixedSizeListArray.from_arrays(pairs.ravel(), 2).cast(pa.list_(pa.int32()))}))
    one, ends = co._tries(spark, candidates, 2, co.PHRASES)
    assert [k for _, k in one] == [n] and ends is None
    trie = one[0][0].value
    assert trie.base.nbytes + trie.check.nbytes < 64 * n
    several, ends = co._tries(spark, candidates, 2, n)
    assert len(several) == 2 and sum(k for _, k in several) == n and max(k for _, k in several) < 0.7 * n
    ids = np.random.default_rng(2).permutation(np.append(pairs[:50_000].ravel(), -np.ones(5000, np.int32)))
    want = {i for i, p in enumerate(zip(ids[:-1].tolist(), ids[1:].tolist(), strict=True)) if p in known}
    found = [set(t.value.run(ids)[0].tolist()) for t, _ in several]
    assert found[0] | found[1] == want == set(trie.run(ids)[0].tolist()) and not found[0] & found[1]
    assert ends.value.has(pairs.ravel(), np.arange(0, 2 * n, 2), 2).all()
    other = np.arange(200_000, 400_000, dtype=np.int32)
    assert ends.value.has(other, np.arange(len(other) - 1), 2).mean() < 0.1


def test_filter_leaves_out_what_follows_no_phrase(spark):
    """Of several tries, none knows all phrases; yet rare words after a frequent pair make no candidates."""
    ids = [x for i in range(2000) for x in (-1, 1, 2, 100 + i)] + [-1, 1, 2, 6, -1, 4, 1, 2] * 50
    found = spark.createDataFrame([(ids,)], "ids array<int>")
    pairs = spark.createDataFrame([([1, 2],), ([2, 6],), ([4, 1],)], "w array<int>")
    tries, ends = co._tries(spark, pairs, 2, 3)
    got = {}
    for trie, heads in tries:
        for r in co._level(found, trie, heads, ends, 2, 1, 3000).collect():
            got[tuple(r["w"])] = got.get(tuple(r["w"]), 0) + r["a"]
    assert len(tries) > 1 and {w: got.pop(w, None) for w in ((1, 2), (2, 6), (4, 1), (1, 2, 6), (4, 1, 2))} == {(1, 2): 2100, (2, 6): 50, (4, 1): 50, (1, 2, 6): 50, (4, 1, 2): 50}
    assert len(got) < 200 and all(w[:2] == (1, 2) and a == 1 for w, a in got.items())


@pytest.mark.parametrize("size", [3, 1 << 20, (1 << 45) + 12345, 1 << 63])
def test_keys_are_dealt_out_and_back(size):
    rng = np.random.default_rng(size % 97)
    own = np.unique(np.append(rng.integers(0, size, 40_000, np.uint64), np.array([0, size - 1], np.uint64)))
    keys = rng.permutation(np.concatenate([own, own[: len(own) // 2], np.repeat(own[:1], 300)]))
    numbers, got, parts = co.Keys(size), Counter(), Counter()
    for r in numbers.rows(keys).to_pylist():
        rest = np.frombuffer(r["keys"], numbers.kind)
        got.update(dict(zip(numbers.plain(r["part"], rest).tolist(), co._numbers(r["n"], len(rest)).tolist(), strict=True)))
        parts[r["part"]] += len(rest)
    assert got == Counter(keys.tolist()) and max(parts) < 1 << co.PART_BITS
    assert size < 1000 or len(parts) == 1 << co.PART_BITS and max(parts.values()) < 120


@pytest.mark.parametrize("n", [1, 2, 1000, 70_000])
def test_words_are_found_by_digests(n):
    rng = np.random.default_rng(n)
    top = ~np.uint64(0)
    own = np.unique(np.append(rng.integers(1, top, n - 1, np.uint64), top if n > 2 else np.uint64(9)))
    numbers = rng.permutation(len(own)).astype(np.int32)
    asked = np.concatenate([own, own + np.uint64(1), rng.integers(0, top, 5000, np.uint64), np.array([0, 1, top], np.uint64)])
    hit, found = co.Vocabulary(own[::-1], numbers[::-1]).find(asked)
    number = dict(zip(own.tolist(), numbers.tolist(), strict=True))
    assert dict(zip(hit.tolist(), found.tolist(), strict=True)) == {i: number[x] for i, x in enumerate(asked.tolist()) if x in number}


def test_odd_texts(spark):
    rows = [(None, "en"), ("", "en"), (" .,;\n", None), ("a b", None)] * 40 + [("x " * 100_000 + "y" * 2_000_000 + " x x", "en"), ("A\tb", "de")]
    rows += [("a b.c d", "fr")] * 30 + [("a b", "")] * 31
    assert mined(spark, rows) == brute_force(rows)
    assert mined(spark, []) == [] == mined(spark, [("a b c", "en")] * 29) == mined(spark, [("a.b", "en")] * 50)


def test_other_columns_and_ties(spark):
    rows = [(f"{a} {b}", "en", 1, 2, "x") for a, b in (("q", "z"), ("q", "é"), ("p", "z"), ("p", "é")) for _ in range(40)]
    got = mined(spark, rows, SCHEMA + ", n int, rank int, phrase string")
    assert got == brute_force([r[:2] for r in rows]) and [r[2] for r in got] == ["p z", "p é", "q z", "q é"]


def test_products_beyond_64_bits(spark):
    big = 1 << 60
    counted = spark.createDataFrame([([1], big), ([2], big), ([3], big), ([1, 2], big - 3), ([2, 3], big - 5), ([1, 2, 3], big - 7)], "w array<int>, a long")
    got = {tuple(r["w"]): r for r in co.scored(counted, 80).collect()}
    assert set(got) == {(1, 2, 3)}
    r = got[1, 2, 3]
    assert r["score"] == 2_000_000 * (big - 7) // (2 * big - 3) == 2_000_000 * (big - 7) // (2 * big - 5) and r["l"] == big


@pytest.mark.skipif(not HAS_DATA, reason="no tables")
def test_given_table(spark):
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert mined(spark, rows, least=6) == brute_force(rows, least=6)
