"""Word classes and borders are those of the patterns' own language, on all characters."""

import re
import sys
import unicodedata

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.operators import detect


def test_classes_on_all_characters(spark):
    known = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    rows = spark.createDataFrame([(c, chr(c)) for c in known], "c int, s string")
    flags = [F.col("s").rlike(f"^{catalog.spelled_out(p)}$").alias(n) for n, p in (("w", r"\w"), ("d", r"\d"), ("t", r"\s"), ("n", r"[^\w\s]"))]
    age = F.col("s").rlike(r"^\P{Cn}$")  # assigned in both libraries
    got = rows.where(age).select("c", *flags).toPandas()
    for name, pattern in (("w", r"\w"), ("d", r"\d"), ("t", r"\s"), ("n", r"[^\w\s]")):
        own = re.compile(pattern)
        assert [int(c) for c, g in zip(got["c"], got[name]) if g != bool(own.fullmatch(chr(c)))] == []


TEXTS = (
    "cafébob@x.com", "²123-45-6789", "x² y", "‍192.168.0.1‍", "١192.168.0.1", "áb-c d_e", "1/2/2020½",
    "Ⅰ 4111 1111 1111 1111", "ü123-45-6789", "_123-45-6789", "(123)456-7890̀", "x@y.zz¹", "कि 10.0.0.1",
)


def test_spans_equal_the_patterns(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    found = {r["doc_id"]: {(s["start"], s["end"]) for s in r["spans"]} for r in detect.detect_core(rows).collect()}
    flags = {True: re.IGNORECASE, False: 0}
    for i, text in enumerate(TEXTS):
        reached, want = 0, set()
        for start, end in sorted(m.span() for p in catalog.CORE for m in re.finditer(p.regex, text, flags[p.ignore_case])):
            if want and start <= reached:
                last = max(want)
                want = (want - {last}) | {(last[0], max(last[1], end))}
            else:
                want.add((start, end))
            reached = max(reached, end)
        assert found[i] == want, text
    words = rows.select("doc_id", F.regexp_extract_all("text", F.lit(catalog.WORD.java), F.lit(0)).alias("w")).collect()
    assert {r["doc_id"]: r["w"] for r in words} == {i: re.findall(r"\b\w+\b", t) for i, t in enumerate(TEXTS)}
