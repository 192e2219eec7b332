import time

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents
from veilmark.llm import decontaminate, sql

ITEM = "If the train with Alice leaves at 5 and drives 120 km, then how far does Alice get in 3 hours on that road?"


def hits(table, items):
    return sorted(tuple(r) for r in decontaminate.find(table, items).collect())


def test_template(spark):
    text = "When Bob Lee met Ann. Then he ran 3.5 km and 12% more, 7 times in Á1."
    row = spark.createDataFrame([(text,)], "text string").select(decontaminate.template("text").alias("w")).first()
    assert row["w"] == ["when", "ʘname", "met", "ʘname", "then", "he", "ran", "ʘnum", "ʘunit", "and", "ʘnum", "ʘunit", "more", "ʘnum", "times", "in", "á", "ʘnum"]


def test_finds_items_with_other_numbers_and_names(spark):
    items = spark.createDataFrame([(1, ITEM), (2, "A short one"), (3, None), (4, ""), (5, ITEM)], "item_id long, text string").selectExpr("*", "1 AS at")
    other = ITEM.replace("Alice", "Carlos").replace("120 km", "75 miles").replace(" 5 ", " 7 ").replace("3 hours", "9 hours")
    rows = [
        (10, "Before it. " + ITEM + " After it."), (11, "some words " + other), (12, "A short one"), (13, None), (14, ""), (15, "clean text " * 20_000),
        (16, ITEM.upper().replace("ALICE", "Alice")), (17, "of the train with Alice"), (18, "the train with Alice leaves at 5 and"), (19, "1 2 3 4 5 6 7 8 9 10 11 12"),
        (10, "again"), (None, other),
    ]
    got = hits(documents(spark, [r for r in rows if r[0] is not None]), items)
    assert {(d, i) for d, i, *_ in got} == {(d, i) for d in (10, 11, 16) for i in (1, 5)}
    assert all(n >= 4 and agree == n for _, _, _, _, n, agree in got)  # a name, numbers and units
    table = documents(spark, rows)
    kept = decontaminate.keep_clean(table, items)
    assert kept.columns == table.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["12", "13", "14", "15", "17", "18", "19"]


def test_slots_must_agree(spark):
    """Ann is one person in the item, so one person must stand for her."""
    item = "so Ann met Bob and then Ann saw Bob while Ann told Bob that Ann likes Bob"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = item.replace("Ann", "Eve").replace("Bob", "Max")
    mixed = "so Eve met Max and then Jim saw Tom while Kim told Ben that Ida likes Leo"
    got = hits(documents(spark, [(1, same), (2, mixed), (3, item)]), items)
    assert [(d, n, agree) for d, _, _, _, n, agree in got] == [(1, 2, 2), (3, 2, 2)]


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    table = documents(spark, [(1, ITEM)])
    assert hits(table.limit(0), items) == [] and hits(table, items.limit(0)) == []
    assert decontaminate.keep_clean(table, items.limit(0)).count() == 1


def test_equals_brute_force(spark):
    """Items in parts: found exactly from four fifths of their windows on."""
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(10)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    rows = [(n, "x y z " + " ".join(words[:n]) + " q r s") for n in range(3, 51)]
    want = [n for n in range(5, 51) if n - 4 >= 0.8 * 46]
    assert [r[0] for r in hits(documents(spark, rows), items)] == want


def test_finds_an_item_after_a_variant_of_its_template(spark):
    """Each occurrence is aligned by itself, not with the first places of its windows."""
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    before = "A bus leaves at 9 and drives 80 km, then stops. "
    mixed = "so Eve met Max and then Jim saw Tom while Kim told Ben that Ida likes Leo. "
    rows = [(1, before + ITEM), (2, before * 3 + "words " * 50 + "end. " + ITEM + " " + before), (3, before + "of the train with Alice"), (4, mixed + ITEM)]
    table = documents(spark, rows)
    assert [tuple(r) for r in hits(table, items)] == [(d, 1, 20, 20, 6, 6) for d in (1, 2, 4)]
    assert [r["doc_id"] for r in decontaminate.keep_clean(table, items).collect()] == [3]
    met = "so Ann met Bob and then Ann saw Bob while Ann told Bob that Ann likes Bob"
    items = spark.createDataFrame([(1, met)], "item_id long, text string")
    assert hits(documents(spark, [(1, mixed), (2, mixed + mixed), (3, mixed + "and " + met)]), items) == [(3, 1, 13, 13, 2, 2)]


LONG = {
    "numbers": "1," * 200_000 + "1", "dots": "7.25 " * 100_000, "names": "so " + "Ab " * 200_000, "units": "5 km " * 100_000,
    "run with a unit": "1." * 200_000 + "5 km", "letters": "a" * 400_000, "spaces": "a" + " " * 300_000 + "B", "digits": "3" * 400_000 + "kg",
}


@pytest.mark.parametrize("kind", LONG)
def test_long_runs(spark, kind):
    """No recursion and no quadratic search, alone and around an item."""
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    table = documents(spark, [(1, LONG[kind]), (2, LONG[kind] + " . " + ITEM + " . " + LONG[kind])])
    began = time.time()
    assert [r[:2] for r in hits(table, items)] == [(2, 1)]
    assert [r["doc_id"] for r in decontaminate.keep_clean(table, items).collect()] == [1]
    assert time.time() - began < 90


def test_expressions_of_both_engines_agree(spark):
    texts = [
        "1,2.3 km, 5km 5 km2 5 kmx 7% a,5 m 1..5 kg .5 g 1,000.5usd 12,a 3 ", "5%.6%,7 %", "x New York City, Y Zed.", "a  Bc De\n\tFg", "٣٫٥ km ½ m", "1.5.km 5.km 9,9,9",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    own = rows.orderBy("i").select(decontaminate.template(F.col("t")).alias("w")).collect()
    plain = F.regexp_replace(F.regexp_replace("t", decontaminate.WITH_UNIT, f" {decontaminate.P_NUMBER} {decontaminate.P_UNIT} $2"), decontaminate.NUMBER, f" {decontaminate.P_NUMBER} ")
    words = F.filter(F.split(F.lower(F.regexp_replace(plain, decontaminate.NAME, f"$1 {decontaminate.P_NAME} ")), decontaminate.SPLIT), lambda w: w != "")
    assert [r["w"] for r in own] == [r["w"] for r in rows.orderBy("i").select(words.alias("w")).collect()]


def test_short_items_are_found_whole(spark):
    items = spark.createDataFrame([(1, "What is 2 + 2?"), (2, "so it is Bob"), (3, "of it"), (4, "What is 2 + 2?")], "item_id long, text string")
    rows = [(1, "He asked: what is 2+2? And"), (2, "What is 2 + 3?"), (3, "so it is  bob"), (4, "of it"), (5, "what is 2"), (6, None), (7, "What is 2 + 2? " * 3)]
    table = documents(spark, rows)
    assert hits(table, items) == [(1, 1, 1, 1, 1, 1), (1, 4, 1, 1, 1, 1), (3, 2, 1, 1, 1, 1), (7, 1, 1, 1, 1, 1), (7, 4, 1, 1, 1, 1)]
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(table, items).collect()) == [2, 4, 5, 6]
    assert {r[1] for r in decontaminate.find(table, items, shortest=2).collect()} == {1, 2, 3, 4}


def test_sql_gives_the_same(spark):
    before = "A bus leaves at 9 and drives 80 km, then stops. "
    met = "so Ann met Bob and then Ann saw Bob while Ann told Bob that Ann likes Bob"
    mixed = "so Eve met Max and then Jim saw Tom while Kim told Ben that Ida likes Leo. "
    items = [(1, ITEM), (2, met), (3, "What is 2 + 2?"), (4, None), (5, "A short one")]
    other = ITEM.replace("Alice", "Carlos").replace("120 km", "75 miles").replace(" 5 ", " 7 ")
    rows = [
        (1, before + ITEM), (2, before * 3 + "words " * 50 + "end. " + ITEM + " " + before), (3, other), (4, mixed + "and " + met), (5, mixed + met + " " + mixed + ITEM),
        (6, mixed), (7, "so what is 2 + 2? " + before), (8, None), (9, ""), (10, other + " " + before + other[:60]), (11, "A short one"), (12, ITEM[:80]),
    ]
    table, bench = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", table.select("doc_id", "text").toPandas())
    con.register("benchmark", bench.toPandas())
    got = hits(table, bench)
    assert got == sorted(con.sql(sql.DECONTAMINATION).fetchall()) and {r[0] for r in got} == {1, 2, 3, 4, 5, 7, 10}
