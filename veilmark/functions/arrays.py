"""Array helpers written with higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: So many elements of a prefix scan are combined one by one.
_RUN = 32


def _doubling(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Inclusive prefix scan in O(k log k): round j combines every element with the one
    2**j places before it."""

    def rounds(arr: Column) -> Column:
        bits = F.when(
            F.size(arr) > 1,
            F.sequence(F.lit(0), F.length(F.bin((F.size(arr) - 1).cast("long"))) - 1),
        ).otherwise(F.array().cast("array<int>"))
        return F.aggregate(
            bits,
            arr,
            lambda acc, j: let(
                F.call_function("shiftleft", F.lit(1), j),
                lambda shift: F.transform(
                    acc, lambda x, i: F.when(i >= shift, combine(F.get(acc, i - shift), x)).otherwise(x)
                ),
            ),
        )

    return let(values, rounds)


def prefix_scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Inclusive prefix scan of an array.

    Runs of elements are scanned one by one, which copies a short run only, and then take
    the total of all runs before them; the totals are scanned by doubling.
    """

    def runs(arr: Column) -> Column:
        return F.transform(
            indices(F.size(arr), 0, _RUN),
            lambda i: F.aggregate(
                F.slice(arr, i + 2, F.lit(_RUN - 1)),
                F.array(F.get(arr, i)),
                lambda acc, x: F.array_append(acc, combine(F.element_at(acc, F.lit(-1)), x)),
            ),
        )

    def placed(run: Column) -> Column:
        totals = _doubling(F.transform(run, lambda r: F.element_at(r, F.lit(-1))), combine)

        def behind(total: Column) -> Column:
            return F.flatten(
                F.transform(
                    run,
                    lambda r, i: F.when(i == 0, r).otherwise(
                        let(F.get(total, i - 1), lambda before: F.transform(r, lambda x: combine(before, x)))
                    ),
                )
            )

        return F.when(F.size(run) > 1, let(totals, behind)).otherwise(F.flatten(run))

    return let(values, lambda arr: F.when(arr.isNotNull(), let(runs(arr), placed)))


def prefix_sums(values: Column) -> Column:
    return prefix_scan(values, lambda a, b: a + b)


def indices(size: Column, start: int = 0, step: int = 1) -> Column:
    """start, start+step, ... < size; empty when there is none."""
    return F.when(size > start, F.sequence(F.lit(start), size - 1, F.lit(step))).otherwise(
        F.array().cast("array<int>")
    )


def pad(arr: Column, n: Column, filler: Column) -> Column:
    """Cut ``arr`` to n elements, or fill it up with ``filler``."""
    return let(
        arr,
        lambda a: F.slice(F.concat(a, F.array_repeat(filler, F.greatest(n - F.size(a), F.lit(0)))), F.lit(1), n),
    )
