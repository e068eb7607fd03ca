"""Rule-based recommendations from the product, channel and payment analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallybook.operators.kpis import REVIEW, STAR

# The wording of each rule.
REVIEW_TEXT = (
    "PRODUCT | Menu rationalisation: [%s] are low-revenue AND low-margin. "
    "Consider a price increase (test +15–20%%) or removal. "
    "Monitor basket attach rate before discontinuing.")
STAR_TEXT = (
    "PRODUCT | Protect star SKUs: [%s] drive both volume and margin. "
    "Prioritise stock availability, feature in upsell prompts, and anchor combo deals.")
CHANNEL_TEXT = (
    "CHANNEL | '%s' channel contributes %.1f%% of revenue. "
    "Evaluate net profitability after channel-specific costs (e.g., delivery commissions, "
    "packaging). A minimum order threshold may improve unit economics.")
PAYMENT_TEXT = (
    "PAYMENT | %s represents %.1f%% of revenue. "
    "%s handling costs 2–4%% of transaction value. A targeted Digital Wallet incentive "
    "(e.g., 5%% discount above ₹80) could shift 10–15%% of %s volume within 60 days.")


def _named_items(quadrants: DataFrame, quadrant: str, template: str, position: int) -> DataFrame:
    """One row naming the items of a quadrant by falling revenue, or none."""
    ordered = F.array_sort(F.collect_list(F.struct(
        (-F.col("total_revenue")).alias("order"), F.col("item").alias("item"))))
    names = F.array_join(F.transform(F.col("members"), lambda m: m["item"]), ", ")
    return (
        quadrants.filter(F.col("quadrant") == quadrant)
        .groupBy(F.lit(position).alias("position"))
        .agg(ordered.alias("members"))
        .select("position", F.format_string(template, names).alias("recommendation"))
    )


def recommendations(quadrants: DataFrame, channels: DataFrame, payments: DataFrame,
                    method: str = "Cash", threshold_pct: float = 30.0) -> DataFrame:
    """(position, recommendation).

    Inputs are the aggregated analyses: a row per item, channel or method. The payment rule names
    ``method`` throughout.
    """
    review = _named_items(quadrants, REVIEW, REVIEW_TEXT, 1)
    stars = _named_items(quadrants, STAR, STAR_TEXT, 2)
    by_revenue = F.struct(F.col("total_revenue"), F.col("channel"))
    weakest = (
        channels.agg(F.count(F.lit(1)).alias("channels"),
                     F.min_by("channel", by_revenue).alias("channel"),
                     F.min_by("revenue_share_pct", by_revenue).alias("share"))
        .filter(F.col("channels") > 1)
        .select(F.lit(3).alias("position"),
                F.format_string(CHANNEL_TEXT, F.col("channel"), F.col("share"))
                .alias("recommendation"))
    )
    heavy = (
        payments.filter((F.col("payment_method") == method)
                        & (F.col("revenue_share_pct") > threshold_pct))
        .select(F.lit(4).alias("position"),
                F.format_string(PAYMENT_TEXT, F.col("payment_method"), F.col("revenue_share_pct"),
                                F.col("payment_method"), F.lower("payment_method"))
                .alias("recommendation"))
    )
    return review.unionByName(stars).unionByName(weakest).unionByName(heavy)
