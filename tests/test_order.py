"""Global positions, splits, batches and running values."""

from __future__ import annotations

import hashlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from veilmark.operators import order


def digest(seed, *ids):
    return hashlib.md5("|".join([str(seed), *map(str, ids)]).encode()).hexdigest()


@pytest.mark.parametrize("digits", [1, 2, 4])
@pytest.mark.parametrize("partitions", [1, 7])
def test_hashed_position(spark, digits, partitions):
    df = spark.range(500).repartition(partitions)
    rows = order.hashed_position(df, order.shuffle_key(42, F.col("id")), digits=digits).collect()
    want = sorted(range(500), key=lambda i: digest(42, i))
    assert [r["id"] for r in sorted(rows, key=lambda r: r["position"])] == want
    assert {r["n_rows"] for r in rows} == {500}


def test_split_sizes_and_partition(spark):
    rows = order.shuffled_split(spark.range(101), ["id"]).collect()
    sizes = pd.Series([r["split"] for r in rows]).value_counts().to_dict()
    assert sizes == {"train": 70, "val": 15, "test": 16}  # floor(70.7), floor(15.15), the rest
    assert sorted(r["id"] for r in rows) == list(range(101))


def test_ordered_split(spark):
    rows = order.ordered_split(spark.range(23).repartition(5), ["id"]).collect()
    assert {r["id"]: r["split"] for r in rows} == {i: "train" if i < 18 else "val" if i < 20 else "test" for i in range(23)}


def test_sample(spark):
    got = {r["id"] for r in order.sample_rows(spark.range(300), ["id"], 50).collect()}
    assert got == set(sorted(range(300), key=lambda i: digest(42, i))[:50])
    assert order.sample_rows(spark.range(10), ["id"], 50).count() == 10


def test_batches_cover_all_rows(spark):
    rows = order.batches(spark.range(100), ["id"], 32, epoch=1).collect()
    sizes = pd.Series([r["batch_id"] for r in rows]).value_counts().sort_index().tolist()
    assert sizes == [32, 32, 32, 4]
    again = order.batches(spark.range(100), ["id"], 32, epoch=2).collect()
    assert {r["id"]: r["batch_id"] for r in rows} != {r["id"]: r["batch_id"] for r in again}


def test_budget_sizes():
    assert [order.budget_sample_size(1000, e) for e in (0.5, 4.0, 8.0, 20.0)] == [62, 500, 1000, 1000]
    assert order.budget_sample_size(1000, 4.0, validation=True) == 100


@pytest.mark.parametrize("slices", [1, 3, 64])
def test_running_with_a_hot_key(spark, slices):
    n = 3000
    pdf = pd.DataFrame({"id": range(n)})
    pdf["k"] = pdf.id.map(lambda i: "hot" if i % 3 else f"k{i % 30}")
    pdf["v"] = pdf.id.map(lambda i: float((i * 7919) % 101))
    df = spark.createDataFrame(pdf).repartition(8)
    aggs = {"total": ("sum", F.col("v")), "top": ("max", F.col("v")), "low": ("min", F.col("v")), "past": ("sum", F.col("v"))}
    got = order.running(df, ["k"], ["id"], aggs, slices, before=["past"]).toPandas().sort_values("id").reset_index(drop=True)
    g = pdf.groupby("k").v
    assert got.total.tolist() == pytest.approx(g.cumsum().tolist())
    assert got.top.tolist() == g.cummax().tolist()
    assert got.low.tolist() == g.cummin().tolist()
    assert got.past.tolist() == pytest.approx((g.cumsum() - pdf.v).tolist())
    if slices > 1:  # the hot key is spread over several window groups
        bounds = order.slice_bounds(df, F.col("id"), slices)
        parts = df.where("k = 'hot'").select(order.slice_of(F.col("id"), bounds).alias("s")).distinct().count()
        assert parts == slices


def test_position_with_ties(spark):
    df = spark.createDataFrame([(1, i) for i in range(40)] + [(0, 99)], "a int, b int")
    rows = order.ordered_position(df, ["a", "b"]).collect()
    assert sorted((r["position"], r["a"], r["b"]) for r in rows) == [(0, 0, 99)] + [(i + 1, 1, i) for i in range(40)]


def test_null_keys_keep_their_totals(spark):
    rows = spark.range(200).select(F.lit(None).cast("string").alias("k"), F.col("id").cast("double").alias("at"))
    rows = rows.union(spark.range(50).select(F.lit("a"), F.col("id").cast("double")))
    got = order.running(rows, ["k"], ["at"], {"n": ("sum", F.lit(1))}).groupBy("k").agg(F.max("n").alias("n")).collect()
    assert {r["k"]: r["n"] for r in got} == {None: 200, "a": 50}


def test_samples_are_exact(spark):
    rows = spark.range(1000).repartition(7)
    for n in (0, 1, 37, 999, 1000, 5000):
        got = order.sample_rows(rows, ["id"], n)
        assert got.count() == min(n, 1000)
    few = {r["id"] for r in order.sample_rows(rows, ["id"], 37).collect()}
    assert few == {r["id"] for r in order.sample_rows(rows.repartition(3), ["id"], 37).collect()}
    assert few <= {r["id"] for r in order.sample_rows(rows, ["id"], 38).collect()}


@pytest.mark.parametrize("partitions", [1, 8])
def test_ties_of_the_first_column_are_spread(spark, partitions):
    df = spark.range(4000).select(F.lit(7).alias("a"), (F.col("id") * 31 % 4000).alias("b")).repartition(partitions)
    bounds = order.slice_bounds(df, ["a", "b"], 16)
    sizes = df.groupBy(order.slice_of(["a", "b"], bounds).alias("s")).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 3 * 4000 / 16
    placed = order.ordered_position(df, ["a", "b"]).collect()
    assert all(r["position"] == r["b"] for r in placed)


def test_slices_follow_the_order_of_any_type(spark):
    values = [("b", 2.5), ("", None), (None, 1.0), ("ab", float("nan")), ("b", -0.0), ("ab", 3.0), (None, None), ("é", 1.0), ("a" * 5000, 2.0)]
    df = spark.createDataFrame(values, "t string, x double")
    bounds = order.slice_bounds(df, ["t", "x"], 64)
    assert len(bounds) == len(values) - 1
    rows = df.withColumn("s", order.slice_of(["t", "x"], bounds)).orderBy("t", "x").collect()
    assert [r["s"] for r in rows] == list(range(len(values)))
    got = [r["position"] for r in order.ordered_position(df, ["t", "x"]).orderBy("t", "x").collect()]
    assert got == list(range(len(values)))


def test_slices_of_an_empty_table(spark):
    empty = spark.range(0).select("id", F.lit("k").alias("k"))
    assert order.slice_bounds(empty, "id", 64) == []
    assert order.ordered_position(empty, ["k", "id"]).collect() == []


def test_equal_keys_share_a_slice(spark):
    df = spark.range(600).select((F.col("id") % 3).alias("a"))
    rows = order.running(df, [], ["a"], {"n": ("sum", F.lit(1).cast("long"))}).groupBy("a").agg(F.max("n").alias("n")).collect()
    assert {r["a"]: r["n"] for r in rows} == {0: 200, 1: 400, 2: 600}
