"""Prefix sums, merging and splicing of the many spans that a text can have."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from veilmark.functions import spans as sp
from veilmark.functions.arrays import prefix_sums

SIZES = (0, 1, 2, 31, 32, 33, 63, 64, 65, 1023, 1024, 1025, 5000)


def test_prefix_sums_around_the_borders_of_runs(spark):
    rng = random.Random(3)
    data = [[rng.randint(0, 9) for _ in range(n)] for n in SIZES]
    df = spark.createDataFrame([(i, d) for i, d in enumerate([*data, None])], "i int, v array<int>")
    got = {r["i"]: r["s"] for r in df.select("i", prefix_sums(F.col("v")).alias("s")).collect()}
    assert got == {**{i: list(itertools.accumulate(d)) for i, d in enumerate(data)}, len(data): None}


def test_a_prefix_sum_takes_few_steps_an_element(spark):
    """Measured by a plain sum; doubling took 20 rounds over a million elements."""
    df = spark.range(1).select(F.sequence(F.lit(1), (F.col("id") + (1 << 20)).cast("int")).alias("v"))
    ones = df.select(F.transform("v", lambda x: x % 3).alias("v")).localCheckpoint()

    def least(c):
        took = []
        for _ in range(4):
            started = time.perf_counter()
            ones.select(c.alias("x")).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - started)
        return min(took)

    plain = F.aggregate("v", F.lit(0), lambda a, x: a + x)
    scan = least(prefix_sums(F.col("v"))) / least(plain)
    print("prefix sum / plain sum:", scan)
    assert scan < 14


def union(spans):
    out = []
    for c, s, e, p, source, rank in sorted(spans, key=lambda x: x[1]):
        if out and s <= out[-1][2]:
            best = out[-1] if p <= out[-1][3] else (c, s, e, p, source, rank)
            out[-1] = (best[0], out[-1][1], max(out[-1][2], e), *best[3:])
        else:
            out.append((c, s, e, p, source, rank))
    return out


@pytest.mark.parametrize("longest", [0, 3, 40])
def test_merge_against_a_plain_union(spark, longest):
    """Nested, touching, equal and empty spans in any order; ties go to the earliest."""
    rng = random.Random(longest)
    data = []
    for n in (0, 1, 2, 7, 40, 300):
        starts = [rng.randint(0, 4 * n) for _ in range(n)]
        data += [[(f"C{i}", s, s + rng.randint(0, longest), rng.choice([0.5, 0.7, 1.0]), "t", i) for i, s in enumerate(starts)]]
    df = spark.createDataFrame(list(enumerate(data)), f"i int, spans {sp.SPANS_TYPE}")
    rows = df.select("i", sp.merge(F.col("spans")).alias("m"), *[sp.in_order(F.col("spans"), d).alias(f"o{d}") for d in (False, True)]).collect()
    for r in rows:
        spans = data[r["i"]]
        assert [tuple(s) for s in r["m"]] == union(spans)
        assert [tuple(s) for s in r["oFalse"]] == sorted(spans, key=lambda s: s[1])
        assert [tuple(s) for s in r["oTrue"]] == sorted(spans, key=lambda s: -s[1])


@pytest.mark.parametrize("n", [1, 511, 512, 513, 32768, 32769, 70000])
def test_splice_of_texts_of_any_length(spark, n):
    rng = random.Random(n)
    text = "".join(rng.choice("ab é█😀") for _ in range(n))
    edges = sorted({0, n, *(x for x in (512, 1024, 32767, 32768, 65536) if x < n), *(rng.randint(0, n) for _ in range(n // 50))})
    cuts = [c for i, c in enumerate(itertools.pairwise(edges)) if i % 3]
    df = spark.createDataFrame([(text, [("X", s, e, 1.0, "t", 0) for s, e in cuts])], f"text string, spans {sp.SPANS_TYPE}")
    got = df.select(sp.splice(F.col("text"), F.col("spans"), lambda s, t: F.concat(F.lit("<"), t, F.lit(">"))).alias("r")).first()["r"]
    for s, e in reversed(cuts):
        text = text[:s] + "<" + text[s:e] + ">" + text[e:]
    assert got == text
