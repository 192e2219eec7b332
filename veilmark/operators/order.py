"""Ordered operators without a single-task sort.

Positions, prefix sums and splits need a global order. An unpartitioned window
would move every row into one task, so rows are first put into buckets that
follow the order, each bucket is ranked on its own, and a small table of bucket
totals supplies what comes before it. Bucket borders never change the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)

#: Keys sampled for each slice, and the most slices there are (their bounds are constants of the plan).
PER_SLICE, MOST_SLICES = 32, 4096


def shuffle_key(seed: int, *ids: Column) -> Column:
    """Hex digest that orders rows pseudo-randomly; unique ids give unique keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def hashed_position(df: DataFrame, key: Column, out: str = "position", n_out: str = "n_rows", digits: int = 4) -> DataFrame:
    """0-based position of each row in the order of a hex digest, plus the row count.

    The first ``digits`` hex digits are the bucket: digests are uniform, so no
    bucket is hot, and at most 16**digits bucket totals are broadcast.
    """
    keyed = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, digits))
    totals = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    carry = totals.select(
        "_bucket",
        F.coalesce(F.sum("_rows").over(Window.orderBy("_bucket").rowsBetween(*_BEFORE)), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias(n_out),
    )
    local = Window.partitionBy("_bucket").orderBy("_key")
    return (
        keyed.join(F.broadcast(carry), "_bucket")
        .withColumn(out, F.col("_before") + F.row_number().over(local) - 1)
        .drop("_bucket", "_key", "_before")
    )


def _key(order: Column | str | Sequence[Column | str]) -> Column:
    """A whole sort key as one value; structs compare field by field, NULL first."""
    parts = [order] if isinstance(order, (Column, str)) else order
    return F.struct(*[(F.col(p) if isinstance(p, str) else p).alias(f"k{i}") for i, p in enumerate(parts)])


def slice_bounds(df: DataFrame, order: Column | str | Sequence[Column | str], slices: int) -> list[Column]:
    """At most ``slices - 1`` sort keys that cut the order into slices of about equal size.

    Keys are whole, so rows that agree in the first column are split by the next
    ones; columns may be of any type that has an order. The bounds are evenly spaced
    among ``PER_SLICE`` sampled keys a slice. Where they lie never changes a result.
    """
    slices = min(slices, MOST_SLICES)
    drawn = F.xxhash64(F.col("k"), F.monotonically_increasing_id())
    sample = df.select(_key(order).alias("k")).orderBy(drawn).limit(slices * PER_SLICE)
    rank, n = F.row_number().over(Window.orderBy("k")), F.count(F.lit(1)).over(Window.partitionBy())
    at = sample.select("k", rank.alias("rank"), n.alias("n"))
    # the first key of every slice but the first
    part = F.floor((F.col("rank") - 1) * slices / F.col("n"))
    before = F.floor((F.col("rank") - 2) * slices / F.col("n"))
    found = at.where((F.col("rank") > 1) & (part > before)).select("k").distinct().orderBy("k")
    types = [f.dataType for f in found.schema["k"].dataType]
    return [F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(r["k"], types))]) for r in found.collect()]


def slice_of(order: Column | str | Sequence[Column | str], bounds: Sequence[Column]) -> Column:
    """Number of bounds <= the sort key, by binary search in one constant array."""
    if not bounds:
        return F.lit(0)
    key, keys = _key(order), F.array(*bounds)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(keys, at + step - 1) <= key, at + step).otherwise(at)
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggs: dict[str, tuple[str, Column]],
    slices: int | Sequence[Column] = 64,
    before: Sequence[str] = (),
) -> DataFrame:
    """Running sum, max or min per key, also when one key or one value holds most rows.

    Each (key, slice of the whole order) is one window group; slices of a key are
    linked by their totals. Only rows that agree in all of ``order`` stay together.
    ``slices`` may be ready bounds of the same order from :func:`slice_bounds`.
    Results named in ``before`` leave the current row out.
    """
    fold = {"sum": F.sum, "max": F.max, "min": F.min}
    if isinstance(slices, int):  # at least as many as the session has shuffle partitions
        slices = max(slices, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = slice_bounds(df, order, slices) if isinstance(slices, int) else slices
    sliced = df.withColumns(
        {"_slice": slice_of(order, bounds)} | {f"_v_{n}": value for n, (_, value) in aggs.items()}
    )
    group = [*keys, "_slice"]
    totals = sliced.groupBy(*group).agg(*[fold[fn](f"_v_{n}").alias(f"_t_{n}") for n, (fn, _) in aggs.items()])
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(*_BEFORE)
    carry = totals.select(*group, *[fold[fn](f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, (fn, _) in aggs.items()])
    if not keys:
        carry = F.broadcast(carry)  # at most one row per slice
    local = Window.partitionBy(*group).orderBy(*order)
    results = {}
    for n, (fn, _) in aggs.items():
        here = fold[fn](f"_v_{n}").over(local.rowsBetween(*(_BEFORE if n in before else _UP_TO)))
        past = F.col(f"_c_{n}")
        if fn == "sum":
            results[n] = F.coalesce(here, F.lit(0)) + F.coalesce(past, F.lit(0))
        else:
            results[n] = F.greatest(here, past) if fn == "max" else F.least(here, past)
    helpers = [f"_{p}_{n}" for n in aggs for p in ("v", "c")]
    named = carry.withColumnsRenamed({g: f"_k_{g}" for g in group})
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_k_{g}")) for g in group])
    return sliced.join(named, same, "left").withColumns(results).drop("_slice", *helpers, *(f"_k_{g}" for g in group))


def ordered_position(df: DataFrame, order: Sequence[str], out: str = "position", slices: int = 64) -> DataFrame:
    """0-based position in the order of the given columns."""
    placed = running(df, [], order, {out: ("sum", F.lit(1).cast("long"))}, slices)
    return placed.withColumn(out, F.col(out) - 1)


def split_label(position: Column, n: Column, ratios: Sequence[float], names: Sequence[str]) -> Column:
    """Positional split: each part but the last gets floor(n * ratio) rows."""
    label, end = None, F.lit(0)
    for ratio, name in zip(ratios[:-1], names[:-1]):
        end = end + F.floor(n * F.lit(float(ratio)))
        label = (F if label is None else label).when(position < end, F.lit(name))
    return label.otherwise(F.lit(names[-1]))


def shuffled_split(
    df: DataFrame,
    ids: Sequence[str],
    ratios: Sequence[float] = (0.70, 0.15, 0.15),
    names: Sequence[str] = ("train", "val", "test"),
    seed: int = 42,
) -> DataFrame:
    """Shuffle, then split by position; adds ``position`` and ``split``."""
    placed = hashed_position(df, shuffle_key(seed, *[F.col(i) for i in ids]))
    return placed.withColumn("split", split_label(F.col("position"), F.col("n_rows"), ratios, names)).drop("n_rows")


def ordered_split(
    df: DataFrame,
    order: Sequence[str],
    ratios: Sequence[float] = (0.8, 0.1, 0.1),
    names: Sequence[str] = ("train", "val", "test"),
) -> DataFrame:
    """Split in the given order without shuffling rows first."""
    placed = ordered_position(df, order)
    n = df.agg(F.count(F.lit(1))).scalar()
    return placed.withColumn("split", split_label(F.col("position"), n, ratios, names))


def sample_rows(df: DataFrame, ids: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows without replacement; all rows if there are no more than n.

    Bucket totals tell in which bucket of the hashed order the n-th row is. Rows of
    earlier buckets stay by a plain filter on their key; only the ids of that one
    bucket are ranked, so rows themselves are not moved.
    """
    key = shuffle_key(seed, *[F.col(i) for i in ids])
    keys = df.select(key.alias("_key")).withColumn("_bucket", F.substring("_key", 1, 4))
    totals = keys.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))  # 65,536 rows at most
    upto = F.sum("_rows").over(Window.orderBy("_bucket"))
    bucket = totals.withColumn("_upto", upto).where(F.col("_upto") >= n).orderBy("_bucket").limit(1)
    last = keys.join(F.broadcast(bucket), "_bucket")
    rank = F.row_number().over(Window.orderBy("_key"))  # the rows of one bucket in 65,536
    cut = last.withColumn("_at", rank + F.col("_upto") - F.col("_rows")).where(F.col("_at") == n).agg(F.max("_key")).scalar()
    return df.where(F.lit(n) > 0).where(key <= F.coalesce(cut, F.lit("g")))  # hex digits end before g


def budget_sample_size(n: int, epsilon: float, validation: bool = False) -> int:
    """n * min(1, epsilon / 8), a fifth of it for validation."""
    size = int(n * min(1.0, epsilon / 8.0))
    return int(size * 0.2) if validation else size


def batches(df: DataFrame, ids: Sequence[str], batch_size: int, epoch: int = 0, seed: int = 42) -> DataFrame:
    """Mini-batch number after a shuffle per epoch; the last batch may be short."""
    placed = hashed_position(df, shuffle_key(seed, F.lit(epoch), *[F.col(i) for i in ids]))
    return placed.withColumn("batch_id", F.floor(F.col("position") / batch_size)).drop("n_rows")
