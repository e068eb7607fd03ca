"""Exact quantiles of weighted values without gathering them in one task.

The built-in exact percentile merges every distinct value into one buffer.
Here the position is found digit group by digit group instead: count values by
their leading digits, pick the group that holds the wanted position, refine
inside that group only. Each step is an ordinary distributed aggregation, and
the running count that picks the group sees at most ``10**STEP`` rows per
wanted position (ten times that in the first step), whatever the input size.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybook.sources.staging import stage_table

STEP = 6
LEVELS = 3
SCALE = 6
LIMIT = 10 ** 12


def _group_of(unscaled: Column, width: int) -> Column:
    """floor(unscaled / width) in whole numbers, also below zero."""
    return F.call_function("div", unscaled - F.pmod(unscaled, F.lit(width)), F.lit(width))


def exact_quantiles(values: DataFrame, probabilities: list[float]) -> DataFrame:
    """(series, q): the quantiles of each series as an array of doubles.

    ``values`` has the columns series, value (up to six decimals and twelve
    digits before them; a larger one raises) and n, how often the value occurs.
    Positions between two values are interpolated linearly. ``series`` names a
    measure, so there are few of them; a series without values has no row. The
    distinct values are stored once and each step reads them.
    """
    unscaled = F.when(F.abs("value") < LIMIT, (F.col("value") * F.lit(10 ** SCALE)).cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("quantile of a value beyond 12 digits: "), F.col("value").cast("string"))))
    pairs = stage_table(
        values.filter(F.col("value").isNotNull() & (F.col("n") > 0))
        .groupBy("series", unscaled.alias("unscaled"))
        .agg(F.sum("n").cast("bigint").alias("n")), "quantile-values")
    asked = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"))
        for i, p in enumerate(probabilities)
    ])
    # For each probability the two neighbouring positions, counted from zero.
    position = (F.col("total") - 1) * F.col("ask.p")
    wanted = (
        pairs.groupBy("series").agg(F.sum("n").alias("total"))
        .select("series", "total", F.explode(asked).alias("ask"))
        .select(
            "series",
            F.col("ask.i").alias("i"),
            (position - F.floor(position)).alias("fraction"),
            F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))).alias("rank"),
        )
    )
    start = F.lit(0).cast("bigint")
    chosen = wanted.select("series", "i", "fraction", "rank",
                           start.alias("before"), start.alias("parent"))
    running = Window.partitionBy("series", "i", "rank").orderBy("group").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    for level in reversed(range(LEVELS)):
        width = 10 ** (STEP * level)
        parent = start if level == LEVELS - 1 else _group_of(F.col("unscaled"), width * 10 ** STEP)
        counts = (
            pairs.select("series", parent.alias("parent"),
                         _group_of(F.col("unscaled"), width).alias("group"), "n")
            .groupBy("series", "parent", "group").agg(F.sum("n").alias("n"))
        )
        # `chosen` has at most two rows per series and probability.
        chosen = (
            counts.join(chosen, ["series", "parent"])
            .withColumn("upto", F.col("before") + F.sum("n").over(running))
            .filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
            .select("series", "i", "fraction", "rank",
                    (F.col("upto") - F.col("n")).alias("before"), F.col("group").alias("parent"))
        )
    exact = (F.col("parent").cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-SCALE))).cast("double")
    low, high = F.min_by(exact, "rank"), F.max_by(exact, "rank")
    found = chosen.groupBy("series", "i").agg(
        (low + (high - low) * F.max("fraction")).alias("v"))
    return found.groupBy("series").agg(F.array(*[
        F.max(F.when(F.col("i") == i, F.col("v"))) for i in range(len(probabilities))
    ]).alias("q"))
