"""Datasets behind the dashboard visuals; the drawing is left to the BI tool."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybook.functions.calendar import month_index
from tallybook.functions.numbers import growth, pct, ratio, real
from tallybook.operators import kpis
from tallybook.operators.aggregates import totals


def kpi_cards(sales: DataFrame) -> DataFrame:
    """Six cards for the latest month, against last month and last year."""
    monthly = totals(sales, month_index(F.col("transaction_date")).alias("month_idx"))
    latest = F.max("month_idx").over(Window.partitionBy())
    periods = {"current": 0, "previous_month": 1, "previous_year": 12, "before_previous": 2,
               "before_previous_year": 13}
    aged = monthly.withColumn("age", latest - F.col("month_idx"))

    def at(name: str, column: str) -> Column:
        return F.max(F.when(F.col("age") == periods[name], real(column)))

    needed = ("revenue", "profit", "total_spent", "transactions")
    wide = aged.agg(*[at(p, c).alias(f"{p}_{c}") for p in periods for c in needed])

    def of(period: str, name: str) -> Column:
        def part(c):
            return F.col(f"{period}_{c}")
        earlier = {"current": "previous_month", "previous_month": "before_previous",
                   "previous_year": "before_previous_year"}[period]
        return {
            "Revenue": part("revenue"),
            "Profit": part("profit"),
            "Margin %": pct(part("profit"), part("revenue")),
            "Transactions": part("transactions"),
            "Avg Bill": F.round(ratio(part("total_spent"), part("transactions")), 2),
            "MoM Growth": F.round(growth(part("revenue"), F.col(f"{earlier}_revenue")), 6),
        }[name]

    names = ("Revenue", "Profit", "Margin %", "Transactions", "Avg Bill", "MoM Growth")
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("card"),
            of("current", name).alias("value"),
            of("previous_month", name).alias("last_month"),
            F.round(growth(of("current", name), of("previous_month", name)), 6).alias("vs_lm"),
            of("previous_year", name).alias("prior_year"),
            F.round(growth(of("current", name), of("previous_year", name)), 6).alias("vs_py"),
        )
        for i, name in enumerate(names, 1)
    ])
    return wide.select(F.explode(rows).alias("row")).select("row.*")


def heatmap(sales: DataFrame, columns: Sequence[str], value: str = "transactions",
            rows: str = "item", across: str = "payment_method") -> DataFrame:
    """Rows x columns matrix; ``columns`` are the known values, so no extra pass."""
    matrix = totals(sales, rows, across).groupBy(rows).pivot(across, list(columns)).agg(F.sum(value))
    return matrix.withColumnsRenamed({c: c.lower().replace(" ", "_") for c in columns})


def scatter(sales: DataFrame) -> DataFrame:
    """Items with bubble size, quadrant and the median reference lines."""
    return kpis.product_quadrants(kpis.product_matrix(sales), keep_medians=True).select(
        "item", "total_revenue", "total_profit", "profit_margin_pct",
        F.col("transactions").alias("bubble_size"), "quadrant", "median_revenue",
        "median_margin_pct")


def treemap(sales: DataFrame) -> DataFrame:
    return kpis.product_matrix(sales).select("item", "total_revenue", "revenue_share_pct",
                                             "profit_margin_pct")


def profit_waterfall(sales: DataFrame, channel: str = "location") -> DataFrame:
    """A bar per channel from where the last one ended, and the total."""
    upto = Window.orderBy(F.desc("profit"), "channel").rowsBetween(Window.unboundedPreceding, 0)
    bars = totals(sales, F.col(channel).alias("channel")).select(
        F.row_number().over(Window.orderBy(F.desc("profit"), "channel")).alias("position"),
        "channel",
        "profit",
        (F.sum("profit").over(upto) - F.col("profit")).alias("bar_start"),
        F.sum("profit").over(upto).alias("bar_end"),
    )
    total = bars.agg(
        (F.count(F.lit(1)) + 1).cast("int").alias("position"),
        F.lit("Total").alias("channel"),
        F.sum("profit").alias("profit"),
    ).select("position", "channel", "profit",
             F.lit(0).cast("decimal(18,2)").alias("bar_start"), F.col("profit").alias("bar_end"))
    return bars.unionByName(total)


DRIVERS = ("item", "location", "payment_method", "quarter_label")


def driver_tree(sales: DataFrame, drivers: Sequence[str] = DRIVERS) -> DataFrame:
    """Revenue of the latest year and the one before, for every drill path.

    The drivers are aggregated before the cube, so its grouping sets multiply
    a small table and not the sales.
    """
    latest = sales.agg(F.max("year")).scalar()
    split = (
        totals(sales, *drivers, "year")
        .withColumn("age", latest - F.col("year"))
        .filter(F.col("age") <= 1)
        .groupBy(*drivers)
        .agg(F.coalesce(F.sum(F.when(F.col("age") == 0, F.col("revenue"))), F.lit(0)).alias("now"),
             F.coalesce(F.sum(F.when(F.col("age") == 1, F.col("revenue"))), F.lit(0)).alias("before"))
    )
    tree = split.cube(*drivers).agg(
        F.sum("now").alias("revenue"),
        F.sum("before").alias("prior_revenue"),
        sum((1 - F.grouping(d).cast("int") for d in drivers[1:]),
            1 - F.grouping(drivers[0]).cast("int")).alias("depth"),
    )
    return tree.select(
        *drivers, "depth", "revenue", "prior_revenue",
        (F.col("revenue") - F.col("prior_revenue")).alias("change"),
        pct(F.col("revenue") - F.col("prior_revenue"), "prior_revenue").alias("change_pct"),
    )


def price_volume_mix(sales: DataFrame, parent: str = "location") -> DataFrame:
    """Change on the year before, split into volume, price and mix.

    Volume is the change in units at the parent's old average price, price the
    change of each item's average price on its new units, and mix the rest.
    Items sold in only one of the years fall under mix.
    """
    latest = sales.agg(F.max("year")).scalar()
    aged = totals(sales, parent, "item", "year").withColumn("age", latest - F.col("year"))

    def at(age: int, column: str) -> Column:
        return F.sum(F.when(F.col("age") == age, F.col(column)))

    items = aged.filter(F.col("age") <= 1).groupBy(parent, "item").agg(
        at(0, "revenue").alias("r1"), at(0, "quantity").alias("q1"),
        at(1, "revenue").alias("r0"), at(1, "quantity").alias("q0"))
    price_change = ratio("r1", "q1") - ratio("r0", "q0")
    sides = items.withColumn(
        "item_price_effect", F.coalesce(price_change * real("q1"), F.lit(0.0))
    ).groupBy(parent).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("r1", "q1", "r0", "q0")],
        F.sum(F.round("item_price_effect", 4).cast("decimal(24,4)")).alias("price_sum"),
    )
    volume = (real("q1") - real("q0")) * ratio("r0", "q0")
    return (
        sides.select(
            parent,
            F.col("r1").alias("revenue"),
            F.col("r0").alias("prior_revenue"),
            (F.col("r1") - F.col("r0")).alias("change"),
            F.round(F.coalesce(volume, F.lit(0.0)), 2).alias("volume_effect"),
            F.round(real("price_sum"), 2).alias("price_effect"),
        )
        .withColumn("mix_effect", F.round(
            real("change") - F.col("volume_effect") - F.col("price_effect"), 2))
    )
