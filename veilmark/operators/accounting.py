"""Privacy accounting over tables of mechanisms.

A mechanism table has one row per group of equal steps; equal (sigma, q) steps
are counted first, so the order grid multiplies groups and not steps.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark.operators.order import running

ORDERS = tuple(range(2, 65))
INFINITY = float("inf")


def with_grid(df: DataFrame, **values: Sequence) -> DataFrame:
    """Every row once per combination of the listed constants."""
    for name, options in values.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in options])))
    return df


def gaussian_sigma(epsilon: Column, delta: Column, clip: float = 1.0, eps_floor: float | None = None) -> Column:
    """clip * sqrt(2 ln(1.25 / delta)) / epsilon, with an optional budget floor."""
    eps = epsilon if eps_floor is None else F.greatest(epsilon, F.lit(float(eps_floor)))
    scale = F.lit(float(clip)) * F.sqrt(2.0 * F.log(F.lit(1.25) / delta)) / eps
    return F.when(eps > 0, scale).otherwise(0.0)


def steps(n: Column, batch_size: Column, epochs: Column) -> Column:
    return F.floor(epochs * n / batch_size).cast("long")


def noise_multiplier(n: Column, batch_size: Column, epsilon: Column, delta: Column, epochs: Column) -> Column:
    """Sigma for a whole run: split over its steps, at least 0.1, 0 without a target."""
    t = steps(n, batch_size, epochs)
    base = gaussian_sigma(epsilon, delta)
    shared = F.when(t > 1, base / F.sqrt(t.cast("double"))).otherwise(base)
    return F.when((epsilon <= 0) | (delta <= 0), 0.0).otherwise(F.greatest(shared, F.lit(0.1)))


def inverse_multiplier(epsilon: Column) -> Column:
    return F.greatest(F.lit(0.1), 2.0 / epsilon)


def simplified_cost(sigma: Column, q: Column, n_steps: Column, delta: Column) -> Column:
    """sigma * q * sqrt(T ln(1 / delta)); grows with the noise, kept for comparison only."""
    return sigma * q * F.sqrt(n_steps * F.log(1.0 / delta))


def unsampled_rdp(sigma: Column, order: Column) -> Column:
    """Renyi divergence of one Gaussian step, without credit for sampling."""
    return F.when(sigma > 0, order / (2.0 * sigma * sigma)).otherwise(F.lit(INFINITY))


def epsilon_at(rdp: Column, order: Column, delta: float) -> Column:
    return rdp + F.lit(math.log(1.0 / delta)) / (order - 1)


def spent(mechanisms: DataFrame, keys: Sequence[str], sigma: str = "sigma", delta: float = 1e-5,
          orders: Sequence[int] = ORDERS) -> DataFrame:
    """Epsilon spent per key and the order that attains it."""
    # Every order's divergence is that of order 1 times the order: one sum serves all.
    groups = mechanisms.groupBy(*keys, sigma).agg(F.count(F.lit(1)).alias("_n"))
    sums = groups.groupBy(*keys).agg(
        F.sum("_n").alias("steps"), F.sum(F.col("_n") * unsampled_rdp(F.col(sigma), F.lit(1))).alias("_unit")
    )
    best = F.array_min(F.array(*[
        F.struct(epsilon_at(F.col("_unit") * float(a), F.lit(float(a)), delta).alias("epsilon"), F.lit(int(a)).alias("order")) for a in orders
    ]))
    return sums.withColumn("_best", best).select(
        *keys, "steps", F.col("_best.epsilon").alias("epsilon"), F.col("_best.order").alias("best_order")
    )


def spent_so_far(mechanisms: DataFrame, keys: Sequence[str], order_by: Sequence[str], sigma: str = "sigma",
                 delta: float = 1e-5, orders: Sequence[int] = ORDERS) -> DataFrame:
    """Epsilon after each step.

    The divergence of every order is the same running sum of 1 / (2 sigma**2)
    times the order, so one running sum serves all orders.
    """
    unit = F.when(F.col(sigma) > 0, 1.0 / (2.0 * F.col(sigma) * F.col(sigma))).otherwise(F.lit(INFINITY))
    summed = running(mechanisms, keys, order_by, {"_unit": ("sum", unit), "steps": ("sum", F.lit(1).cast("long"))})
    per_order = [epsilon_at(F.col("_unit") * float(a), F.lit(float(a)), delta) for a in orders]
    return summed.withColumn("epsilon", F.least(*per_order)).drop("_unit")
