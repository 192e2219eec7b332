import hashlib
import math
import zlib
from collections import Counter

from veilmark.llm import urls
from veilmark.llm.queries import RULES


def split(spark, values):
    table = spark.createDataFrame([(u,) for u in values], "url string")
    return [tuple(r) for r in table.select(*urls.split_url()).collect()]


def test_split(spark):
    given = ["http://A.Ex.COM/En/x?q=1#f", "https://a.com", "ftp://a.com?x/y", "a.com/x", None, "x://#f", "http://é.com/p#a?b", "s://u://v"]
    assert split(spark, given) == [("a.ex.com", "/En/x"), ("a.com", ""), ("a.com", ""), ("", ""), ("", ""), ("", ""), ("é.com", "/p"), ("u:", "//v")]


def table(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS rule", "2 AS text", "3 AS n")


def test_rules(spark):
    given = {
        "http://a.com/": ("com/", "allow"), "http://example.com/en/1": ("example.com/en/", "block"), "http://www.example.com/en/1": ("www.example.com/en/", "allow"),
        "http://x.www.example.com/en/1": ("www.example.com/en/", "allow"), "http://notexample.com/en/": ("com/", "allow"), "http://net/es/": ("net/es/", "block"),
        "http://a.net/fr/x": ("net/fr/", "block"), "http://a.net/en/": (None, None), "http://a.com": (None, None), "http://com/": ("com/", "allow"),
    }
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.filter_urls(table(spark, list(given)), RULES).collect()}
    for (rule, verdict), own in zip(given.values(), (got[i] for i in range(len(given)))):
        assert own[0] == rule and (verdict is None or own[1] == verdict)


def test_difference_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(urls, "CELLS", 1 << 18)
    given = [f"http://good{i}.com/a{i}" for i in range(40)] + [f"http://bad{i}.net/es/{i}" for i in range(40)] * 2
    given += ["http://x.org/q", "http://good.org/a", "http://bad.org/es/", None, "", "http://" + "y" * 5000 + ".org/"]
    rows = urls.filter_urls(table(spark, given), RULES).collect()
    grams = {"allow": Counter(), "block": Counter()}
    for r in rows:
        text = (r["host"] + r["path"]).lower()
        if r["rule"] and zlib.crc32(text.encode()) % 5:
            marked = "^" * urls.ORDER + text + "$"
            for i in range(urls.ORDER, len(marked)):
                for k in range(urls.ORDER + 1):
                    grams[r["verdict"]][marked[i - k : i + 1]] += 1
                    grams[r["verdict"]]["of", marked[i - k : i], k] += 1

    def log_p(kind, marked, i):
        p = 1 / urls.ALPHABET
        for k in range(urls.ORDER + 1):
            p = (grams[kind][marked[i - k : i + 1]] + urls.WEIGHT * p) / (grams[kind]["of", marked[i - k : i], k] + urls.WEIGHT)
        return math.log(p)

    off = []
    for r in rows:
        text = (r["host"] + r["path"]).lower()
        marked = "^" * urls.ORDER + text + "$"
        want = sum(log_p("allow", marked, i) - log_p("block", marked, i) for i in range(urls.ORDER, len(marked))) / (len(text) + 1) if text else 0.0
        off.append(abs(r["difference"] - want))
    assert max(off) < 1e-9
    judged = {given[r["page_id"]]: r["verdict"] for r in rows}
    assert judged["http://good.org/a"] == "allow" and judged["http://bad.org/es/"] == "block"


def test_without_training_rows(spark):
    got = urls.filter_urls(table(spark, ["http://x.org/", None]), RULES).collect()
    assert [r["verdict"] for r in got] == ["allow", "allow"]
    assert urls.filter_urls(table(spark, ["http://x.org/"]).limit(0), RULES).count() == 0


def exact(rows):
    """Differences of the rows (host, path, rule, verdict) from exact counts."""
    grams = {"allow": Counter(), "block": Counter()}
    for r in rows:
        text = (r["host"] + r["path"]).lower()
        if r["rule"] and zlib.crc32(text.encode()) % 5:
            marked = "^" * urls.ORDER + text + "$"
            for i in range(urls.ORDER, len(marked)):
                for k in range(urls.ORDER + 1):
                    grams[r["verdict"]][marked[i - k : i + 1]] += 1
                    grams[r["verdict"]]["of", marked[i - k : i], k] += 1

    def log_p(kind, marked, i):
        p = 1 / urls.ALPHABET
        for k in range(urls.ORDER + 1):
            p = (grams[kind][marked[i - k : i + 1]] + urls.WEIGHT * p) / (grams[kind]["of", marked[i - k : i], k] + urls.WEIGHT)
        return math.log(p)

    for r in rows:
        text = (r["host"] + r["path"]).lower()
        marked = "^" * urls.ORDER + text + "$"
        yield sum(log_p("allow", marked, i) - log_p("block", marked, i) for i in range(urls.ORDER, len(marked))) / (len(text) + 1) if text else 0.0


def test_counts_are_exact_for_many_grams(spark, monkeypatch):
    """With the module's own parameters, and both kinds of join: no two grams share a count."""
    words = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(400)]
    given = [f"http://{w[:20]}.{('com/a', 'net/es')[i % 2]}/{w[20:50]}é😀" for i, w in enumerate(words)]
    given += [f"http://{w[::-1]}.org/" for w in words[:50]] + [None]
    for cells in (urls.CELLS, 0):
        monkeypatch.setattr(urls, "CELLS", cells)
        rows = urls.filter_urls(table(spark, given), RULES).collect()
        assert len(rows) == len(given)
        assert max(abs(r["difference"] - want) for r, want in zip(rows, exact(rows), strict=True)) < 1e-9
