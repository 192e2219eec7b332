"""The expressions that are run find what the plain patterns find, in linear time."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import kernels, matching
from veilmark.functions import spans as sp
from veilmark.operators import detect, suppress

CATALOGS = {
    "core": catalog.CORE, "fallback": catalog.FALLBACK, "truth": catalog.TRUTH, "extended": catalog.extended(True),
    "extended_case": catalog.extended(False), "word": (catalog.WORD,),
}


def texts(n, seed=7):
    rng = random.Random(seed)
    parts = [
        "@", ".", "-", "_", "%", "+", "|", " ", "  ", "\t", "\n", "a", "b1", "é", "K", "ſ", "ı", "İ", "com", ".co", "x.y", "@a.bc", "42", "7", "12345", "555-123-4567",
        "(555)", "+1-", "1234 5678 9012 3456", "1.2.3.4", "1/2/2020", "New York", "new", "york", "CA", "in", "Mr.", "Ann", "Lee", "Ann-Lee", "Street", "St.", "password:", "pass=", "secret99",
        "Non-binary", "male", "M", "CEO", "urban", "N", "NE", "County", " Kent ", "Pixel", " 7a", "https://", "www.", "a.io/x", "ABCDEF12", "AB12CD34567890", "1a2b", ":", "aa:", "0x", "ⅷ", "²", "̈", "ſt", "paſs:", "Linuxı",
    ]
    return ["".join(rng.choice(parts) + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 14))) for _ in range(n)]


@pytest.mark.parametrize("name", CATALOGS)
def test_same_matches_as_the_plain_patterns(spark, name):
    rows = spark.createDataFrame([(t,) for t in texts(3000)], "text string").repartition(8).cache()
    for p in CATALOGS[name]:
        marked = F.split(F.regexp_replace("text", p.java, "\ue000$0\ue000"), "\ue000", -1)
        plain = F.transform(marked, lambda x: F.length(x))
        run = sp.lengths(F.col("text"), p)
        differs = rows.select("text", plain.alias("plain"), run.alias("run")).where("size(plain) > 1 OR size(run) > 1").where("NOT plain <=> run")
        assert differs.take(3) == [], p.name
    rows.unpersist()


def test_listed_words():
    by_name = {p.name: matching.words_of(p) for p in catalog.extended()}
    assert by_name["CITY"] >= {"new", "los", "chicago", "fort"} and by_name["GENDER"] == {"male", "female", "non", "m", "f", "nb"}
    assert by_name["COUNTY"] == {"county", "parish", "borough"} and by_name["PASSWORD"] == {"password", "pwd", "pass"}
    assert len(by_name["STATE"]) == 50 and "iphone" in by_name["DEVICE_INFO"]
    assert not any(by_name[n] for n in ("FULLNAME", "FIRSTNAME", "LASTNAME", "EMAIL", "URL", "STREET_ADDRESS", "USER_AGENT"))


MB = 1 << 20
RUNS = {
    "borders": "a." * (MB // 2) + "@", "letters": "a" * MB + "@", "signs": "." * MB + "@b", "many": "a.b@" * (MB // 4), "domain": "a@" + "b." * (MB // 2),
    "bars": "a@b." + "|" * MB, "pairs": "a.a@b-c." * (MB // 8), "dots": "x@" + "." * MB,
}


@pytest.mark.parametrize("kind", RUNS)
def test_a_megabyte_without_an_address(spark, kind):
    email = next(p for p in catalog.CORE if p.name == "EMAIL")
    rows = spark.createDataFrame([(RUNS[kind],)], "text string").cache()
    rows.count()
    query = rows.select(F.size(sp.lengths(F.col("text"), email)).alias("n"))
    query.collect()
    began = time.time()
    assert query.first()["n"] == 1
    assert time.time() - began < 3


def test_addresses_in_long_runs(spark):
    text = "a." * 50_000 + "@x " + "b." * 50_000 + "c@d.org," + "é.q@r.com" + "@" + "z" * 50_000 + "@y.net"
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = [text[s["start"] : s["end"]] for s in detect.detect_truth(rows).first()["spans"] if s["category"] == "EMAIL"]
    assert found == ["b." * 50_000 + "c@d.org", ".q@r.com", "z" * 50_000 + "@y.net"]
    assert [s["category"] for s in suppress.detect_extended(rows.withColumn("text", F.lit("nothing here 12"))).first()["spans"]]


def greedy(spans, strict):
    kept = []
    for i, (s, e) in enumerate(spans):
        if strict:
            clash = any(s < b and a < e for a, b in (spans[j] for j in kept))
        else:
            clash = any(a <= s <= b or a <= e <= b for a, b in (spans[j] for j in kept))
        if not clash:
            kept.append(i)
    return kept


@pytest.mark.parametrize("strict", [False, True])
def test_suppression_by_intervals(strict):
    """In any order, and by ranks of spans that do not overlap each other."""
    rng = random.Random(11)
    for n in (0, 1, 5, 40, 120):
        for _ in range(30):
            spans = [(s := rng.randrange(80), s + rng.randint(1, 12)) for _ in range(n)]
            assert kernels.accept(*(zip(*spans) if spans else ([], [])), strict) == greedy(spans, strict)
            ranked = []
            for rank in range(rng.randint(1, 6)):
                at = rng.randrange(4)
                while at < 70:
                    end = at + rng.randint(1, 9)
                    ranked.append((rank, at, end))
                    at = end + rng.choice([0, 0, 1, 3, 15])
            # two texts, far apart
            rows = [(r, s + 1000 * t, e + 1000 * t) for r in range(6) for t in (0, 1) for rr, s, e in ranked if rr == r and (t == 0 or s % 3)]
            columns = [np.array(c, np.int64) for c in zip(*rows)]
            got = np.flatnonzero(kernels.accepted_by_rank(*columns, strict)).tolist()
            assert got == greedy([r[1:] for r in rows], strict)
