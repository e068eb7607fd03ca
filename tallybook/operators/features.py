"""Revenue, cost, profit, margin and calendar columns. No shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.config import COGS_RATE
from tallybook.functions.calendar import calendar_columns
from tallybook.functions.numbers import pct
from tallybook.schemas import FINANCIAL, MONEY, TIME

RATE = "decimal(4,2)"


def cost_rate(rates: Mapping[str, str] | None = None, default: str = COGS_RATE) -> Column:
    """Cost share of revenue, by item where a rate is known."""
    flat = F.lit(default).cast(RATE)
    if not rates:
        return flat
    entries = [F.lit(x) for item, rate in rates.items() for x in (item, rate)]
    known = F.try_element_at(F.create_map(*entries), F.col("item"))
    return F.coalesce(known.cast(RATE), flat)


def add_financials(df: DataFrame, rates: Mapping[str, str] | DataFrame | None = None,
                   default_rate: str = COGS_RATE) -> DataFrame:
    """Revenue, cost, profit and margin of each record.

    ``rates`` gives per-item cost rates: a mapping becomes part of the
    expression; a DataFrame (item, cogs_rate) is joined, and whether it is
    broadcast depends on its size, which Spark checks.
    """
    if isinstance(rates, DataFrame):
        df = df.join(rates.select("item", F.col("cogs_rate").cast(RATE)), "item", "left").select(
            *df.columns, "cogs_rate")
        rate = F.coalesce(F.col("cogs_rate"), F.lit(default_rate).cast(RATE))
    else:
        rate = cost_rate(rates, default_rate)
    revenue = F.round(F.col("quantity") * F.col("price_per_unit"), 2).try_cast(MONEY)
    return (
        df.withColumn("revenue", revenue)
        .withColumn("cost", F.round(F.col("revenue") * rate, 2).try_cast(MONEY))
        .withColumn("profit", (F.col("revenue") - F.col("cost")).cast(MONEY))
        .withColumn("profit_margin_pct", pct("profit", "revenue"))
        .drop("cogs_rate")
    )


def add_calendar(df: DataFrame, date: str = "transaction_date") -> DataFrame:
    return df.withColumns(calendar_columns(F.col(date)))


def gathered_by_month(df: DataFrame, date: str = "transaction_date") -> DataFrame:
    """``df`` with its month, rebalanced on it for a table laid out by month.

    Rows travel before the columns are derived that follow from them, which are most of an engineered row.
    """
    month = calendar_columns(F.col(date))["year_month"]
    return df.withColumn("year_month", month).hint("rebalance", "year_month")


def engineer(df: DataFrame, rates: Mapping[str, str] | DataFrame | None = None,
             default_rate: str = COGS_RATE) -> DataFrame:
    return df.transform(add_financials, rates, default_rate).transform(add_calendar)


def preview(engineered: DataFrame, rows: int = 5) -> DataFrame:
    """The first records by transaction id, main columns only."""
    return engineered.orderBy("transaction_id", "transaction_date").limit(rows).select(
        "transaction_id", "transaction_date", "item", "quantity", "price_per_unit", "revenue",
        "cost", "profit", "profit_margin_pct", "day_of_week", "month", "quarter_label", "year")


def column_types(df: DataFrame) -> DataFrame:
    """(column_name, data_type) of every column; reads no rows."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.lit(t).alias("data_type"))
        for i, (n, t) in enumerate(df.dtypes)
    ]
    return df.sparkSession.range(1).select(F.explode(F.array(*entries)).alias("row")).select("row.*")


ENGINEERED_COLUMNS = tuple(f.name for f in (*FINANCIAL.fields, *TIME.fields))
