"""Executive figures and product, channel and payment analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallybook.functions.numbers import pct, ratio, real
from tallybook.operators.aggregates import share_of, totals

# The names of the executive figures, in report order.
EXECUTIVE_KPIS = (
    "Total Revenue (₹)",
    "Total Cost (₹)",
    "Total Profit (₹)",
    "Gross Margin (%)",
    "Total Transactions",
    "Avg Transaction Value (₹)",
    "Avg Revenue per Transaction",
    "Avg Quantity per Transaction",
)

# Quadrants by revenue and margin against their medians.
STAR = "Star — High Revenue, High Margin"
VOLUME_DRIVER = "Volume Driver — High Revenue, Low Margin"
NICHE = "Niche — Low Revenue, High Margin"
REVIEW = "Review — Low Revenue, Low Margin"


def executive_kpis(sales: DataFrame) -> DataFrame:
    """The eight executive figures as (position, kpi, value)."""
    values = (
        real("revenue"),
        real("cost"),
        real("profit"),
        ratio("profit", "revenue") * 100,
        real("transactions"),
        ratio("total_spent", "transactions"),
        ratio("revenue", "transactions"),
        ratio("quantity", "transactions"),
    )
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("kpi"), value.alias("value"))
        for i, (name, value) in enumerate(zip(EXECUTIVE_KPIS, values), 1)
    ])
    return totals(sales).select(F.explode(rows).alias("row")).select("row.*")


def product_matrix(sales: DataFrame) -> DataFrame:
    """Per item: totals, averages, share, margin and revenue rank."""
    return totals(sales, "item").select(
        "item",
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        "transactions",
        ratio("price_per_unit", "transactions").alias("avg_price"),
        ratio("quantity", "transactions").alias("avg_qty"),
        share_of("revenue").alias("revenue_share_pct"),
        pct("profit", "revenue").alias("profit_margin_pct"),
        F.rank().over(Window.orderBy(F.desc("revenue"))).alias("revenue_rank"),
    )


def with_medians(matrix: DataFrame) -> DataFrame:
    everything = Window.partitionBy()
    return matrix.withColumns({
        "median_revenue": F.median("total_revenue").over(everything),
        "median_margin_pct": F.median("profit_margin_pct").over(everything),
    })


def product_quadrants(matrix: DataFrame, keep_medians: bool = False) -> DataFrame:
    """Each item's quadrant; on the median counts as high."""
    measured = with_medians(matrix)
    high_revenue = real("total_revenue") >= F.col("median_revenue")
    high_margin = F.col("profit_margin_pct") >= F.col("median_margin_pct")
    low_margin = F.col("profit_margin_pct") < F.col("median_margin_pct")
    low_revenue = real("total_revenue") < F.col("median_revenue")
    labelled = measured.withColumn(
        "quadrant",
        F.when(high_revenue & high_margin, STAR)
        .when(high_revenue & low_margin, VOLUME_DRIVER)
        .when(low_revenue & high_margin, NICHE)
        .otherwise(REVIEW),
    )
    return labelled if keep_medians else labelled.drop("median_revenue", "median_margin_pct")


def top_and_bottom(matrix: DataFrame, n: int = 5) -> DataFrame:
    """The n items with the most and the n with the least revenue."""
    def end(name: str, *order) -> DataFrame:
        return matrix.orderBy(*order, "item").limit(n).select(
            F.lit(name).alias("end"), "item", "total_revenue", "revenue_rank")

    return end("top", F.desc("total_revenue")).unionByName(end("bottom", F.asc("total_revenue")))


def channel_column(sales: DataFrame) -> str:
    """Order type where the data have one, else location."""
    return "order_type" if "order_type" in sales.columns else "location"


def channel_analysis(sales: DataFrame, column: str | None = None) -> DataFrame:
    column = column or channel_column(sales)
    return totals(sales, column).select(
        F.col(column).alias("channel"),
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        "transactions",
        ratio("total_spent", "transactions").alias("avg_bill"),
        share_of("revenue").alias("revenue_share_pct"),
        pct("profit", "revenue").alias("profit_margin_pct"),
    )


def payment_analysis(sales: DataFrame) -> DataFrame:
    return totals(sales, "payment_method").select(
        "payment_method",
        F.col("revenue").alias("total_revenue"),
        "transactions",
        ratio("total_spent", "transactions").alias("avg_bill"),
        share_of("revenue").alias("revenue_share_pct"),
    )
