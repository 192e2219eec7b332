"""Privacy accounting queries: sizes come from the tables, grids are constants."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.operators import accounting as acc
from veilmark.queries.base import query
from veilmark.queries.prep import _rounded
from veilmark.sources.tables import read

_LOG = f"{math.log(1 / 1e-5)!r}::DOUBLE"
_GRID = (
    "g AS (SELECT source, count(*) AS n, epsilon, batch_size, epochs FROM documents, "
    f"(VALUES {', '.join(f'({e}::DOUBLE)' for e in catalog.EPSILONS)}) AS a(epsilon), (VALUES (32), (64)) AS b(batch_size), "
    "(VALUES (3), (15)) AS c(epochs) GROUP BY ALL)"
)
_BASE = "sqrt(2 * ln(1.25::DOUBLE / 1e-5::DOUBLE)) / epsilon"


def grid(spark, sf):
    """Documents per source, combined with budgets, batch sizes and epochs."""
    sizes = read(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return acc.with_grid(sizes, epsilon=catalog.EPSILONS, batch_size=(32, 64), epochs=(3, 15))


@query(
    "noise_multipliers",
    f"WITH {_GRID}, s AS (SELECT *, CAST(floor(epochs * n / batch_size) AS BIGINT) AS steps FROM g) "
    f"SELECT source, n, epsilon, batch_size, epochs, steps, "
    f"round(greatest(CASE WHEN steps > 1 THEN {_BASE} / sqrt(steps) ELSE {_BASE} END, 0.1::DOUBLE), 6) AS sigma FROM s",
)
def noise_multipliers(spark, sf):
    n, b, e, k = F.col("n"), F.col("batch_size"), F.col("epsilon"), F.col("epochs")
    sigma = acc.noise_multiplier(n, b, e, F.lit(1e-5), k)
    return grid(spark, sf).select(
        "source", "n", "epsilon", "batch_size", "epochs", acc.steps(n, b, k).alias("steps"), F.round(sigma, 6).alias("sigma")
    )


@query(
    "noise_scales",
    f"WITH {_GRID} SELECT DISTINCT source, n, epsilon, round(0.3::DOUBLE * sqrt(2 * ln(1.25::DOUBLE / 1e-5::DOUBLE)) / greatest(epsilon, 1), 6) AS floored, "
    f"round(0.5::DOUBLE * {_BASE}, 6) AS half_clip, round({_BASE}, 6) AS unit_clip, round(greatest(0.1::DOUBLE, 2.0::DOUBLE / epsilon), 6) AS inverse FROM g",
)
def noise_scales(spark, sf):
    sizes = read(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    e, d = F.col("epsilon"), F.lit(1e-5)
    return acc.with_grid(sizes, epsilon=catalog.EPSILONS).select(
        "source", "n", "epsilon",
        F.round(acc.gaussian_sigma(e, d, 0.3, 1.0), 6).alias("floored"),
        F.round(acc.gaussian_sigma(e, d, 0.5), 6).alias("half_clip"),
        F.round(acc.gaussian_sigma(e, d), 6).alias("unit_clip"),
        F.round(acc.inverse_multiplier(e), 6).alias("inverse"),
    )


@query(
    "simplified_costs",
    f"WITH {_GRID}, s AS (SELECT *, CAST(floor(epochs * n / batch_size) AS BIGINT) AS steps, greatest(0.1::DOUBLE, 2.0::DOUBLE / epsilon) AS sigma FROM g) "
    f"SELECT source, epsilon, batch_size, epochs, round(sigma * (batch_size::DOUBLE / n) * sqrt(steps * {_LOG}), 6) AS cost FROM s",
)
def simplified_costs(spark, sf):
    n, b, e, k = F.col("n"), F.col("batch_size"), F.col("epsilon"), F.col("epochs")
    cost = acc.simplified_cost(acc.inverse_multiplier(e), b / n, acc.steps(n, b, k), F.lit(1e-5))
    return grid(spark, sf).select("source", "epsilon", "batch_size", "epochs", F.round(cost, 6).alias("cost"))


# Each event is one noisy answer to its user; the noise depends on the kind of event.
_SIGMA = "(2.0::DOUBLE + length(event_type) / 4.0::DOUBLE)"


def mechanisms(spark, sf):
    events = read(spark, sf, "events").select("user_id", "event_id", "event_type")
    return events.withColumn("sigma", F.lit(2.0) + F.length("event_type") / 4.0)


@query(
    "privacy_spent",
    f"WITH u AS (SELECT user_id, count(*) AS steps, sum(1 / (2 * {_SIGMA} * {_SIGMA})) AS r FROM events GROUP BY user_id), "
    f"o AS (SELECT user_id, steps, a, a * r + {_LOG} / (a - 1) AS eps FROM u, (SELECT unnest(range(2, 65)) AS a)) "
    "SELECT user_id, any_value(steps) AS steps, round(min(eps), 6) AS epsilon, CAST(arg_min(a, eps) AS INTEGER) AS best_order FROM o GROUP BY user_id",
)
def privacy_spent(spark, sf):
    return _rounded(acc.spent(mechanisms(spark, sf), ["user_id"]), "epsilon")


@query(
    "privacy_spent_so_far",
    f"WITH u AS (SELECT user_id, event_id, row_number() OVER w AS steps, sum(1 / (2 * {_SIGMA} * {_SIGMA})) OVER w AS r FROM events "
    "WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) "
    f"SELECT user_id, event_id, steps, round(list_min(list_transform(range(2, 65), lambda a: a * r + {_LOG} / (a - 1))), 6) AS epsilon FROM u",
)
def privacy_spent_so_far(spark, sf):
    rows = acc.spent_so_far(mechanisms(spark, sf), ["user_id"], ["event_id"])
    return _rounded(rows.select("user_id", "event_id", "steps", "epsilon"), "epsilon")
