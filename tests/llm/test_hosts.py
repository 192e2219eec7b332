import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import HAS_DATA, SF
from veilmark.llm import hosts, sql

SCHEMA = "doc_id long, text string, source string"


def measure(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = list(zip(words, words[1:], words[2:]))
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def measured(spark, texts):
    table = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], SCHEMA)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return [tuple(r[c] for c in names) for r in hosts.measures(table).orderBy("doc_id").collect()]


def test_measures_equal_brute_force(spark):
    texts = [
        None, "", " \t\n", "one", "a b c", "a a a a", "a b c a b c", "a b c d\na b c d\n\n \na b c d", "x|y <&> # 50% * $", "é　ü \x0b\x0cß 𝔘𝔫",
        "a b c a b d a b c", "w " * 5000, "line\n" * 300, " ".join(f"w{i % 977}" for i in range(60_000)), "\n".join(f"v{i} u" for i in range(20_000)),
    ]
    assert measured(spark, texts) == [measure(t) for t in texts]


def long_text(i):
    return " ".join(f"word{(i * 31 + k * 7) % 997}" for k in range(60))


def bad_text(i):
    return long_text(i) + " #" * 20


def test_rates_are_drawn_to_the_others(spark):
    # 40 hosts of 50 documents at about a tenth, one of 3 with 2 failures, one of 3 without any.
    rows = [(f"h{h}", k < 5 + h % 3 - 1) for h in range(40) for k in range(50)] + [("few", k < 2) for k in range(3)] + [("none", False)] * 3
    table = spark.createDataFrame(rows, "source string, symbols boolean").select("source", *(F.col("symbols").alias(r) for r in hosts.RULES))
    got = {r["source"]: r["symbols"] for r in hosts.rates(table).collect()}
    assert 0.08 < got["h1"] < 0.12 and got["few"] < 0.25 and 0 < got["none"] < 0.11
    assert got["few"] > got["h1"] > got["none"]
    # Hosts that differ a lot keep their own rates.
    rows = [(f"h{h}", k < (45 if h % 2 else 2)) for h in range(20) for k in range(50)]
    table = spark.createDataFrame(rows, "source string, symbols boolean").select("source", *(F.col("symbols").alias(r) for r in hosts.RULES))
    got = {r["source"]: r["symbols"] for r in hosts.rates(table).collect()}
    assert got["h1"] > 0.85 and got["h0"] < 0.08


def judged(spark, rows, schema=SCHEMA):
    return {r["doc_id"]: r for r in hosts.judge(spark.createDataFrame(rows, schema)).collect()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_host_verdicts_reach_documents(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(hosts, "BROADCAST_ROWS", 0)
    rows = [(i, bad_text(i) if i < 90 else long_text(i), "spam") for i in range(100)]  # clean ones go, too
    rows += [(100 + i, bad_text(i) if i < 40 else long_text(i), "mixed") for i in range(100)]  # those that fail go
    rows += [(200 + 100 * h + i, bad_text(i) if i < 2 else long_text(i), f"fine{h}") for h in range(8) for i in range(100)]
    rows += [(5000, "too short", "fine0"), (5001, None, None), (5002, long_text(1), None)]
    got = judged(spark, rows)
    assert len(got) == len(rows)
    assert {got[i]["host_verdict"] for i in range(100)} == {"bad"} and not any(got[i]["kept"] for i in range(100))
    assert {got[i]["host_verdict"] for i in range(100, 200)} == {"doubtful"}
    assert [got[i]["kept"] for i in range(100, 200)] == [False] * 40 + [True] * 60
    assert all(got[i]["kept"] and got[i]["host_verdict"] == "good" for i in range(200, 1000))
    assert got[5000]["base_failed"] and not got[5000]["kept"] and got[5001]["n_words"] == 0 and got[5002]["kept"]


def test_empty_repeated_and_clashing(spark):
    assert hosts.judge(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, long_text(1), "a", True, 9, "x")] * 3 + [(None, long_text(2), "b", False, 9, "y")]
    out = hosts.judge(spark.createDataFrame(rows, SCHEMA + ", kept boolean, n_words int, host string")).collect()
    assert len(out) == 4 and all(r["n_words"] == 60 and r["kept"] for r in out)


@pytest.mark.skipif(not HAS_DATA, reason="no tables")
def test_sql_gives_the_same(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "src1"), (-2, "a b c a b c\n\nx\nx", None), *((-10 - i, bad_text(i), "spam") for i in range(30))], SCHEMA)
    table = base.select("doc_id", "text", "source").unionByName(odd)
    got = hosts.judge(table).toPandas()
    con = duckdb.connect()
    con.register("documents", table.toPandas())
    want = con.sql(sql.HOSTS).df()[list(got.columns)]
    assert got.sort_values("doc_id").astype(str).values.tolist() == want.sort_values("doc_id").astype(str).values.tolist()
