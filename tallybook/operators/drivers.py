"""What moved a product of drivers, such as units x share x price, without an order of the drivers.

Changing the drivers one after another gives effects that depend on the order; their mean over all
orders (the Shapley value) does not, and adds up to the whole change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallybook.functions.numbers import ratio, real
from tallybook.operators.aggregates import totals


def shapley_effects(before: Sequence[Column], now: Sequence[Column]) -> list[Column]:
    """Effect of each driver on the product of all, averaged over every order of change.

    The mean over orders equals the integral of the other drivers' product while all drivers move from
    old to new together. That product is a polynomial of degree n - 1, which n // 2 + 1 Gauss points
    integrate exactly, so n drivers take on the order of n^3 multiplications and not 2^n.
    """
    nodes, weights = np.polynomial.legendre.leggauss(len(before) // 2 + 1)
    moves = [b - a for a, b in zip(before, now)]

    def others(k: int, at: float) -> Column:
        factors = [a + move * at for j, (a, move) in enumerate(zip(before, moves)) if j != k]
        return reduce(lambda x, y: x * y, factors, F.lit(1.0))

    return [
        moves[k] * sum((others(k, (1 + float(t)) / 2) * (float(w) / 2) for t, w in zip(nodes, weights)), F.lit(0.0))
        for k in range(len(before))
    ]


def rounded_to_total(effects: Mapping[str, Column], total: Column, places: int = 2) -> dict[str, Column]:
    """The effects as decimals that add up to ``total`` exactly.

    What rounding leaves over goes to the largest effect in size (the first named, of equal ones).
    """
    kind = f"decimal(24,{places})"
    rounded = {name: F.round(effect, places).cast(kind) for name, effect in effects.items()}
    rest = total.cast(kind) - sum(rounded.values(), F.lit(0).cast(kind))
    ordered = F.array_sort(F.array(*[
        F.struct((-F.abs(value)).alias("size"), F.lit(k).alias("k")) for k, value in enumerate(rounded.values())]))
    return {name: (value + F.when(ordered[0]["k"] == k, rest).otherwise(F.lit(0).cast(kind))).cast(kind)
            for k, (name, value) in enumerate(rounded.items())}


def _known(value: Column, other: Column) -> Column:
    """A ratio without a base in one year moves nothing: it is taken as in the other year."""
    return F.coalesce(value, other, F.lit(0.0))


def revenue_drivers(sales: DataFrame, parent: str = "location") -> DataFrame:
    """The latest year's change of revenue on the year before, by parent and driver.

    Drivers are the parent's units (``volume_effect``), each item's share of them (``mix_effect``) and its
    average price (``price_effect``). An item sold in one of the years only has no price change; a parent
    without units in one of them has no change of mix. The three effects add up to ``change`` to the cent.
    """
    latest = sales.agg(F.max("year")).scalar()
    aged = totals(sales, parent, "item", "year").withColumn("age", latest - F.col("year"))

    def at(age: int, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("age") == age, F.col(column))), F.lit(0))

    items = aged.where(F.col("age") <= 1).groupBy(parent, "item").agg(
        at(1, "revenue").alias("r0"), at(0, "revenue").alias("r1"),
        at(1, "quantity").alias("q0"), at(0, "quantity").alias("q1"))
    units = items.groupBy(parent).agg(F.sum("q0").alias("units0"), F.sum("q1").alias("units1"))
    both = items.join(units.withColumnRenamed(parent, "__parent"), F.col(parent).eqNullSafe(F.col("__parent")))
    both = both.select(
        parent, "r0", "r1", real("units0").alias("v0"), real("units1").alias("v1"),
        _known(ratio("q0", "units0"), ratio("q1", "units1")).alias("s0"),
        _known(ratio("q1", "units1"), ratio("q0", "units0")).alias("s1"),
        _known(ratio("r0", "q0"), ratio("r1", "q1")).alias("p0"),
        _known(ratio("r1", "q1"), ratio("r0", "q0")).alias("p1"))
    effects = shapley_effects([F.col(c) for c in ("v0", "s0", "p0")], [F.col(c) for c in ("v1", "s1", "p1")])
    names = ("volume_effect", "mix_effect", "price_effect")
    summed = both.groupBy(parent).agg(
        F.sum("r1").alias("revenue"), F.sum("r0").alias("prior_revenue"),
        *[F.sum(F.round(e, 4).cast("decimal(24,4)")).alias(n) for n, e in zip(names, effects)])
    change = F.col("revenue") - F.col("prior_revenue")
    whole = rounded_to_total({n: F.col(n) for n in names}, change)
    return summed.select(parent, "revenue", "prior_revenue", change.alias("change"),
                         *[whole[n].alias(n) for n in names])
