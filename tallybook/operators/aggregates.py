"""Additive totals, from sales rows or from a daily rollup of them.

Every KPI is a ratio, rank or window over sums and counts. Those are additive,
so they can come from the rows or from any finer pre-aggregation with the same
result; :func:`totals` takes either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybook.functions.numbers import real

ROLLUP_KEYS = ("transaction_date", "item", "payment_method", "location", "order_type")

# Tasks that the sales of one date and category are dealt over.
PARTS = 4

SUMMED = ("revenue", "cost", "profit", "total_spent", "quantity", "price_per_unit", "gross")


def additive(sales: DataFrame) -> DataFrame:
    """Sales rows with the count, gross and largest bill a rollup carries."""
    if "transactions" in sales.columns:
        return sales
    return sales.withColumns({
        "transactions": F.lit(1).cast("bigint"),
        "gross": F.col("quantity") * F.col("price_per_unit"),
        "max_bill": F.col("total_spent"),
    })


def totals(sales: DataFrame, *keys: str | Column) -> DataFrame:
    """Sums, counts and largest bill by ``keys`` (partial sums before the shuffle)."""
    return additive(sales).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMMED],
        F.coalesce(F.sum("transactions"), F.lit(0)).cast("bigint").alias("transactions"),
        F.max("max_bill").alias("max_bill"),
    )


def gathered(sales: DataFrame, parts: int = PARTS) -> DataFrame:
    """Sales rows of the same date and category brought together, each group to a few tasks.

    For :func:`daily_rollup` of many sales over many groups: tasks that see all groups have hardly two rows
    of one, so sums taken there are as many as the rows, and wider. Rows travel before columns are
    derived from them; a group with many of the rows is spread over ``parts`` tasks, which each send one sum.
    """
    keys = [k for k in ROLLUP_KEYS if k in sales.columns]
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(parts)).cast("tinyint")
    return sales.withColumn("__part", part).repartition(*keys, "__part").drop("__part")


def daily_rollup(engineered: DataFrame) -> DataFrame:
    """Totals by date and category: its size follows the calendar, not the sales."""
    keys = [k for k in ROLLUP_KEYS if k in engineered.columns]
    return totals(engineered, *keys)


def share_of(part: Column | str, *within: str, places: int | None = 2) -> Column:
    """Percentage of the sum over rows with equal ``within`` columns.

    For aggregated rows only: without ``within`` it runs in one task.
    """
    col = F.col(part) if isinstance(part, str) else part
    share = F.try_divide(real(col), real(F.sum(col).over(Window.partitionBy(*within)))) * 100
    return share if places is None else F.round(share, places)
