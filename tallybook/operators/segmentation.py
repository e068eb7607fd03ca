"""Customer segments and channel profit after order costs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.operators.aggregates import totals
from tallybook.operators.kpis import channel_column
from tallybook.operators.quantiles import exact_quantiles
from tallybook.sources.staging import stage_table

QUINTILES = [0.2, 0.4, 0.6, 0.8]
_METRICS = ("recency_days", "frequency", "monetary")


def customer_metrics(engineered: DataFrame) -> DataFrame:
    """Days since the last purchase, purchases and revenue of each customer.

    The sales are read once: the totals are stored, and the newest date of all
    is the newest of the customers' last purchases.
    """
    totals_of = stage_table(engineered.groupBy("customer_id").agg(
        F.max("transaction_date").alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("revenue").alias("monetary"),
    ), "customer-totals")
    newest = totals_of.agg(F.max("last_purchase")).scalar()
    return totals_of.select("customer_id", F.date_diff(newest, "last_purchase").alias("recency_days"),
                            "frequency", "monetary")


def rfm_scores(customers: DataFrame) -> DataFrame:
    """Quintile scores 1 to 5; the best customers score 5-5-5.

    Scores compare each customer with the exact quintile limits of all
    customers. Ranking every customer would order them all in one task and
    give equal customers different scores; limits do neither. ``customers``
    should be a stored table: it is read for the limits and again for scoring.
    """
    series = F.explode(F.array(*[
        F.struct(F.lit(m).alias("series"), F.col(m).cast("decimal(24,6)").alias("value"))
        for m in _METRICS
    ])).alias("s")
    counted = customers.select(series).select("s.*").groupBy("series", "value").agg(
        F.count(F.lit(1)).alias("n"))
    limits = exact_quantiles(counted, QUINTILES).agg(*[
        F.max(F.when(F.col("series") == m, F.col("q"))).alias(m) for m in _METRICS
    ]).select(F.struct(*_METRICS)).scalar()

    def limits_passed(metric: str) -> Column:
        return F.size(F.filter(F.col("limits")[metric], lambda x: F.col(metric).cast("double") > x))

    return (
        customers.withColumn("limits", limits)
        .select(
            "customer_id", *_METRICS,
            (5 - limits_passed("recency_days")).alias("r_score"),
            (1 + limits_passed("frequency")).alias("f_score"),
            (1 + limits_passed("monetary")).alias("m_score"),
        )
        .withColumn("rfm_code", F.concat("r_score", "f_score", "m_score"))
    )


def rfm_segments(engineered: DataFrame) -> DataFrame:
    return rfm_scores(customer_metrics(engineered))


def channel_net_profit(sales: DataFrame, cost_per_order: Mapping[str, str],
                       column: str | None = None, default_cost: str = "0") -> DataFrame:
    """Profit of each channel after a fixed cost per order."""
    column = column or channel_column(sales)
    cost = F.lit(default_cost).cast("decimal(10,2)")
    for channel, amount in cost_per_order.items():
        cost = F.when(F.col("channel") == channel, F.lit(amount).cast("decimal(10,2)")).otherwise(cost)
    return (
        totals(sales, F.col(column).alias("channel"))
        .select("channel", "revenue", "profit", "transactions")
        .withColumn("order_costs", F.col("transactions") * cost)
        .withColumn("net_profit", F.col("profit") - F.col("order_costs"))
    )
