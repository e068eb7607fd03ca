"""The fifteen named sales queries over engineered sales or a rollup of them.

Every query aggregates first; windows see groups, not sales. Column names are
those a SQL user of the sales view would choose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallybook.functions.numbers import growth_pct, mean, pct, ratio, real
from tallybook.operators import trends
from tallybook.operators.aggregates import share_of, totals

PRIORITY_REVIEW = "Priority Review — Low Margin, Low Volume"
MARGIN_REVIEW = "Margin Review — Volume Offset"
ACCEPTABLE = "Acceptable"
# Below this share of revenue an item counts as low volume.
LOW_VOLUME_PCT = 10
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def executive_summary(sales: DataFrame) -> DataFrame:
    return totals(sales).select(
        F.col("revenue").alias("total_revenue"),
        F.col("cost").alias("total_cost"),
        F.col("profit").alias("total_profit"),
        pct("profit", "revenue").alias("gross_margin_pct"),
        F.col("transactions").alias("total_transactions"),
        mean("total_spent", "transactions").alias("avg_transaction_value"),
        mean("quantity", "transactions").alias("avg_items_per_txn"),
    )


def monthly_growth(sales: DataFrame) -> DataFrame:
    by_month = Window.orderBy("year_month")
    previous = F.lag("revenue").over(by_month)
    return totals(sales, "year_month", "month_short", "year").select(
        "year_month",
        "month_short",
        F.col("revenue").alias("monthly_revenue"),
        F.col("profit").alias("monthly_profit"),
        pct("profit", "revenue").alias("margin_pct"),
        "transactions",
        previous.alias("prev_month_revenue"),
        growth_pct(F.col("revenue"), previous).alias("mom_growth_pct"),
        F.sum("revenue").over(by_month.rowsBetween(Window.unboundedPreceding, 0))
        .alias("running_total"),
    )


def quarterly_growth(sales: DataFrame) -> DataFrame:
    return trends.quarterly_trend(sales, margin_places=2).withColumnsRenamed(
        {"revenue": "quarterly_revenue", "profit": "quarterly_profit"})


def product_ranking(sales: DataFrame) -> DataFrame:
    margin = ratio("profit", "revenue")
    return totals(sales, "item").select(
        "item",
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        pct("profit", "revenue").alias("profit_margin_pct"),
        "transactions",
        mean("price_per_unit", "transactions").alias("avg_price"),
        share_of("revenue").alias("revenue_share_pct"),
        F.rank().over(Window.orderBy(F.desc("revenue"))).alias("revenue_rank"),
        F.rank().over(Window.orderBy(F.desc("profit"))).alias("profit_rank"),
        F.dense_rank().over(Window.orderBy(margin.desc())).alias("margin_rank"),
    )


def item_by_location(sales: DataFrame) -> DataFrame:
    return totals(sales, "item", "location").select(
        "item", "location", "revenue", "profit", "transactions",
        share_of("revenue", "item").alias("pct_of_item_revenue"),
    )


def item_by_payment(sales: DataFrame) -> DataFrame:
    return totals(sales, "item", "payment_method").select(
        "item", "payment_method", "transactions", "revenue",
        mean("total_spent", "transactions").alias("avg_bill"),
    )


def location_profitability(sales: DataFrame) -> DataFrame:
    return totals(sales, "location").select(
        "location",
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        pct("profit", "revenue").alias("profit_margin_pct"),
        "transactions",
        mean("total_spent", "transactions").alias("avg_bill"),
        share_of("revenue").alias("revenue_share_pct"),
    )


def month_by_location(sales: DataFrame) -> DataFrame:
    return totals(sales, "year_month", "location").select(
        "year_month", "location", F.col("revenue").alias("monthly_revenue"), "transactions")


def location_by_weekday(sales: DataFrame) -> DataFrame:
    """With the weekday's position, Monday first, to sort by."""
    position = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("day_of_week"))
    return totals(sales, "location", "day_of_week").select(
        "location", "day_of_week", position.alias("weekday_order"), "transactions", "revenue",
        mean("total_spent", "transactions").alias("avg_bill"),
    )


def payment_summary(sales: DataFrame) -> DataFrame:
    quartile = F.ntile(4).over(Window.orderBy(F.desc("revenue"), "payment_method"))
    return totals(sales, "payment_method").select(
        "payment_method",
        "transactions",
        F.col("revenue").alias("total_revenue"),
        mean("total_spent", "transactions").alias("avg_bill"),
        F.col("max_bill"),
        share_of("revenue").alias("revenue_share_pct"),
        quartile.alias("revenue_quartile"),
    )


def location_by_payment(sales: DataFrame) -> DataFrame:
    return totals(sales, "location", "payment_method").select(
        "location", "payment_method", "transactions", "revenue",
        mean("total_spent", "transactions").alias("avg_bill"),
        share_of("transactions", "location").alias("pct_of_location_txns"),
    )


def margin_flags(sales: DataFrame) -> DataFrame:
    """Items against the average of the item margins."""
    average = F.avg("profit_margin_pct").over(Window.partitionBy())
    margin = F.col("profit_margin_pct")
    return (
        totals(sales, "item")
        .select("item", F.col("revenue").alias("total_revenue"),
                pct("profit", "revenue").alias("profit_margin_pct"),
                share_of("revenue").alias("revenue_share_pct"))
        .withColumn("avg_margin", average)
        .withColumn("margin_vs_avg", F.round(margin - F.col("avg_margin"), 2))
        .withColumn(
            "action_flag",
            F.when((margin < F.col("avg_margin")) & (F.col("revenue_share_pct") < LOW_VOLUME_PCT),
                   PRIORITY_REVIEW)
            .when(margin < F.col("avg_margin"), MARGIN_REVIEW)
            .otherwise(ACCEPTABLE),
        )
    )


def cumulative_contribution(sales: DataFrame) -> DataFrame:
    """Items by falling revenue with their running share (ties by name)."""
    ranked = F.rank().over(Window.orderBy(F.desc("revenue")))
    upto = Window.orderBy(F.desc("revenue"), "item").rowsBetween(Window.unboundedPreceding, 0)
    running = F.sum("revenue").over(upto)
    whole = F.sum("revenue").over(Window.partitionBy())
    return totals(sales, "item").select(
        "item",
        "revenue",
        ranked.alias("rev_rank"),
        running.alias("cumulative_revenue"),
        share_of("revenue").alias("revenue_pct"),
        F.round(F.try_divide(real(running), real(whole)) * 100, 2).alias("cumulative_pct"),
    )


# Query id -> (builder, columns to order the finished report by).
SALES_QUERIES = {
    "q1_1": (executive_summary, ()),
    "q1_2": (trends.yearly_trend, ("year",)),
    "q2_1": (monthly_growth, ("year_month",)),
    "q2_2": (quarterly_growth, ("quarter_label",)),
    "q2_3": (trends.rolling_average, ("year_month",)),
    "q3_1": (product_ranking, ("revenue_rank", "item")),
    "q3_2": (item_by_location, ("item", "-revenue", "location")),
    "q3_3": (item_by_payment, ("item", "-revenue", "payment_method")),
    "q4_1": (location_profitability, ("-total_revenue", "location")),
    "q4_2": (month_by_location, ("year_month", "location")),
    "q4_3": (location_by_weekday, ("location", "weekday_order")),
    "q5_1": (payment_summary, ("-total_revenue", "payment_method")),
    "q5_2": (location_by_payment, ("location", "-revenue", "payment_method")),
    "q6_1": (margin_flags, ("profit_margin_pct", "item")),
    "q6_2": (cumulative_contribution, ("rev_rank", "item")),
}


def run_query(sales: DataFrame, query: str) -> DataFrame:
    """One of :data:`SALES_QUERIES`, ordered."""
    build, order = SALES_QUERIES[query]
    keys = [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in order]
    report = build(sales)
    return report.orderBy(*keys) if keys else report
