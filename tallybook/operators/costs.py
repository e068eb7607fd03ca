"""Costs whose rate changes over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallybook.config import COGS_RATE
from tallybook.functions.numbers import pct
from tallybook.operators.features import RATE
from tallybook.schemas import MONEY

# Parts that the sales of an item are dealt over. The rows of a part are held together: a part of a hundred
# million sales of one item still fits in the memory of a task.
PARTS = 128


def with_rate_as_of(sales: DataFrame, rates: DataFrame, parts: int = PARTS) -> DataFrame:
    """Adds ``cogs_rate``: the item's rate with the latest ``valid_from`` up to the transaction date.

    ``rates`` has item, valid_from (date) and cogs_rate. A rate holds from its first day on; of several for
    the same item and day the highest counts. Null where the item has none yet, and for sales without item
    or date. Sales and rates are sorted together and each sale takes the last rate before it, so there is no
    join by range. The sales of an item are dealt over ``parts`` tasks, each with a copy of its rates: an
    item with a third of the sales loads no task.
    """
    single = (
        rates.where(F.col("item").isNotNull() & F.col("valid_from").isNotNull())
        .groupBy("item", F.col("valid_from").cast("date").alias("transaction_date"))
        .agg(F.max(F.col("cogs_rate").cast(RATE)).alias("__rate"))
        .withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        .withColumn("__sale", F.lit(False))
    )
    # Sales travel as they are, with their part alone.
    rows = sales.withColumns({
        "__rate": F.lit(None).cast(RATE), "__sale": F.lit(True),
        "__part": F.pmod(F.xxhash64(*sales.columns), F.lit(parts)).cast("int")})
    both = rows.unionByName(single, allowMissingColumns=True)
    # A rate of the same day comes before the sales; null days come first and find nothing.
    before = Window.partitionBy("item", "__part").orderBy("transaction_date", "__sale").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        both.withColumn("cogs_rate", F.last("__rate", ignorenulls=True).over(before))
        .where("__sale").select(*sales.columns, "cogs_rate")
    )


def add_financials_as_of(sales: DataFrame, rates: DataFrame, default_rate: str = COGS_RATE) -> DataFrame:
    """Revenue, cost, profit and margin with the rate of the day, ``default_rate`` where there is none."""
    rate = F.coalesce(F.col("cogs_rate"), F.lit(default_rate).cast(RATE))
    return (
        with_rate_as_of(sales, rates)
        .withColumn("revenue", F.round(F.col("quantity") * F.col("price_per_unit"), 2).try_cast(MONEY))
        .withColumn("cost", F.round(F.col("revenue") * rate, 2).try_cast(MONEY))
        .withColumn("profit", (F.col("revenue") - F.col("cost")).cast(MONEY))
        .withColumn("profit_margin_pct", pct("profit", "revenue"))
        .drop("cogs_rate")
    )
