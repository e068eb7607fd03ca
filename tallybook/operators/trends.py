"""Month, quarter and year trends.

Windows here run over aggregated periods, never over sales rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallybook.functions.numbers import growth_pct, mean, pct
from tallybook.operators.aggregates import totals


def monthly_trend(sales: DataFrame) -> DataFrame:
    """Revenue, profit, margin, growth on the previous month present, running total."""
    by_month = Window.orderBy("month_start")
    previous = F.lag("revenue").over(by_month)
    return totals(sales, "month_start").select(
        "month_start",
        F.date_format("month_start", "MMM yyyy").alias("month_label"),
        "revenue",
        "profit",
        pct("profit", "revenue").alias("margin_pct"),
        "transactions",
        previous.alias("prev_revenue"),
        growth_pct(F.col("revenue"), previous).alias("mom_growth_pct"),
        F.sum("revenue").over(by_month.rowsBetween(Window.unboundedPreceding, 0))
        .alias("running_total"),
    )


def quarterly_trend(sales: DataFrame, grain: str = "quarter_label",
                    margin_places: int = 1) -> DataFrame:
    """Revenue, profit and growth by quarter.

    ``grain="quarter_label"`` merges equal quarters of different years (Q1 to
    Q4); ``grain="quarter"`` keeps them apart.
    """
    by_quarter = Window.orderBy(grain)
    return totals(sales, grain).select(
        grain,
        "revenue",
        "profit",
        "transactions",
        pct("profit", "revenue", margin_places).alias("margin_pct"),
        growth_pct(F.col("revenue"), F.lag("revenue").over(by_quarter)).alias("qoq_growth_pct"),
    )


def yearly_trend(sales: DataFrame) -> DataFrame:
    previous = F.lag("revenue").over(Window.orderBy("year"))
    return totals(sales, "year").select(
        "year",
        F.col("revenue").alias("annual_revenue"),
        F.col("profit").alias("annual_profit"),
        "transactions",
        previous.alias("prev_year_revenue"),
        growth_pct(F.col("revenue"), previous).alias("yoy_revenue_growth_pct"),
    )


def rolling_average(sales: DataFrame, months: int = 3) -> DataFrame:
    """Mean revenue of each month and those before it, as many as there are."""
    window = Window.orderBy("year_month").rowsBetween(1 - months, 0)
    return totals(sales, "year_month").select(
        "year_month",
        F.col("revenue").alias("monthly_revenue"),
        mean(F.sum("revenue").over(window), F.count("revenue").over(window))
        .alias("rolling_3m_avg" if months == 3 else f"rolling_{months}m_avg"),
    )


def revenue_anomalies(monthly: DataFrame, multiplier: float = 1.5) -> DataFrame:
    """Months whose revenue lies outside the interquartile fences."""
    everything = Window.partitionBy()
    quartile = {p: F.percentile("revenue", F.lit(p)).over(everything) for p in (0.25, 0.75)}
    return (
        monthly.withColumns({"q1": quartile[0.25], "q3": quartile[0.75]})
        .withColumn("fence_lower", F.col("q1") - (F.col("q3") - F.col("q1")) * multiplier)
        .withColumn("fence_upper", F.col("q3") + (F.col("q3") - F.col("q1")) * multiplier)
        .filter(~F.col("revenue").cast("double").between(F.col("fence_lower"), F.col("fence_upper")))
        .drop("q1", "q3")
    )


def revenue_forecast(monthly: DataFrame, months: int = 3, by: tuple[str, ...] = ()) -> DataFrame:
    """Straight-line extrapolation by least squares on the month number.

    ``monthly`` has month_start and revenue. With ``by`` each group has its own
    line and numbers its own months.
    """
    ordered = Window.partitionBy(*by).orderBy("month_start")
    revenue = F.col("revenue").cast("double")
    fitted = (
        monthly.withColumn("t", (F.row_number().over(ordered) - 1).cast("double"))
        .groupBy(*by)
        .agg(F.regr_slope(revenue, F.col("t")).alias("slope"),
             F.regr_intercept(revenue, F.col("t")).alias("intercept"),
             F.max("t").alias("last"))
    )
    # An empty history has no last month and yields no forecast.
    return (
        fitted.filter(F.col("last").isNotNull())
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(months))))
        .select(
            *by,
            "step",
            F.concat(F.lit("Forecast +"), "step").alias("month_label"),
            F.round(F.col("intercept") + F.col("slope") * (F.col("last") + F.col("step")), 2)
            .alias("forecast_revenue"),
            F.lit("Forecast").alias("type"),
        )
    )
