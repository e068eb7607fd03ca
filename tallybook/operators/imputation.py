"""Filling gaps from group and column statistics.

Two passes over the records, however many gaps there are:

1. :func:`value_counts` counts every value the statistics need in one scan
   (grouping sets, combined map-side). The result has one row per distinct
   value and is staged; all modes, means and medians come from it.
2. :func:`fill_gaps` joins the per-item statistics back and fills.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.operators.cleaning import line_total
from tallybook.operators.quantiles import exact_quantiles
from tallybook.schemas import PRICE, QUANTITY
from tallybook.sources.staging import stage_table

_COUNTED = ("item", "quantity", "price_per_unit", "payment_method", "location")
_SETS = (("item", "quantity"), ("item", "price_per_unit"), ("payment_method",), ("location",))


class Statistics(NamedTuple):
    """What gaps are filled with."""

    by_item: DataFrame   # item, item_quantity, item_price: one row per item
    overall: DataFrame   # one row: medians and most frequent categories


def _set_id(present: tuple[str, ...]) -> int:
    """grouping_id of a grouping set: a bit is set for each absent column."""
    return int("".join("0" if c in present else "1" for c in _COUNTED), 2)


def in_set(*present: str) -> Column:
    """True for the rows of :func:`value_counts` that count the given columns."""
    return F.col("set_id") == _set_id(present)


def value_counts(standardised: DataFrame, copies: str | None = None) -> DataFrame:
    """How often each value occurs: (item, quantity), (item, price), payment, location.

    ``copies`` names a column that says how many records a row stands for.
    """
    number = F.sum(copies) if copies else F.count(F.lit(1))
    return standardised.groupingSets([list(s) for s in _SETS], *_COUNTED).agg(
        F.grouping_id().alias("set_id"), number.alias("n"))


def merge_counts(counts: DataFrame) -> DataFrame:
    """Add up counts taken from several parts of the data."""
    return counts.groupBy(*_COUNTED, "set_id").agg(F.sum("n").alias("n"))


def _most_frequent(value: str, condition: Column) -> Column:
    """Value with the highest n; the smallest one on a tie."""
    return F.min_by(value, F.when(condition & F.col(value).isNotNull(), F.struct(-F.col("n"), value)))


def item_statistics(counts: DataFrame) -> DataFrame:
    """Most frequent quantity and mean price of each item."""
    priced = in_set("item", "price_per_unit") & F.col("price_per_unit").isNotNull()
    return (
        counts.filter(F.col("item").isNotNull())
        .groupBy("item")
        .agg(
            _most_frequent("quantity", in_set("item", "quantity")).alias("item_quantity"),
            F.try_divide(
                F.sum(F.when(priced, F.col("price_per_unit") * F.col("n"))),
                F.sum(F.when(priced, F.col("n"))),
            ).cast(PRICE).alias("item_price"),
        )
    )


def overall_statistics(counts: DataFrame, by_item: DataFrame,
                       price_median: str = "raw") -> DataFrame:
    """Medians and most frequent categories, one row.

    The quantity median is taken after items have filled their gaps. The price
    median is taken before that (``"raw"``) or after it (``"filled"``).
    """
    if price_median not in ("raw", "filled"):
        raise ValueError(f"price_median must be 'raw' or 'filled', not {price_median!r}")

    filled_price = F.col("item_price") if price_median == "filled" else F.lit(None)
    # Both sides are statistics: one row per distinct value, one per item.
    values = (
        counts.filter(in_set("item", "quantity") | in_set("item", "price_per_unit"))
        .join(by_item, "item", "left")
        .select(
            F.when(in_set("item", "quantity"), "quantity").otherwise("price_per_unit")
            .alias("series"),
            F.when(in_set("item", "quantity"), F.coalesce("quantity", "item_quantity"))
            .otherwise(F.coalesce(F.col("price_per_unit"), filled_price)).alias("value"),
            "n",
        )
    )
    medians = exact_quantiles(values, [0.5]).agg(*[
        F.max(F.when(F.col("series") == name, F.col("q")[0])).cast(dtype).alias(name)
        for name, dtype in (("quantity", QUANTITY), ("price_per_unit", PRICE))
    ]).select(F.struct("quantity", "price_per_unit")).scalar()
    items = (
        counts.filter(in_set("item", "quantity") & F.col("item").isNotNull())
        .groupBy("item").agg(F.sum("n").alias("n"))
        .agg(F.min_by("item", F.struct(-F.col("n"), "item")))
    )
    return counts.agg(
        _most_frequent("payment_method", in_set("payment_method")).alias("payment_method"),
        _most_frequent("location", in_set("location")).alias("location"),
    ).select(
        medians.alias("medians"), items.scalar().alias("item"), "payment_method", "location",
    )


def flat(overall: DataFrame) -> DataFrame:
    """The stored one-row table with the medians as columns of their own."""
    return overall.select("medians.*", "item", "payment_method", "location")


def fit(counts: DataFrame, price_median: str = "raw") -> Statistics:
    """Statistics from staged counts; both parts are staged in turn."""
    by_item = stage_table(item_statistics(counts), "item-statistics")
    overall = stage_table(overall_statistics(counts, by_item, price_median), "overall-statistics")
    return Statistics(by_item, flat(overall))


def with_item_statistics(df: DataFrame, statistics: Statistics) -> DataFrame:
    """Adds item_quantity and item_price.

    There is one row per vocabulary item, in a stored table whose size Spark
    knows: it broadcasts a small one; otherwise adaptive execution splits the
    items that hold most of the rows.
    """
    return df.join(statistics.by_item, "item", "left")


def _overall(statistics: Statistics, column: str) -> Column:
    """A column of the one-row table as a scalar subquery."""
    return statistics.overall.select(column).scalar()


def filled_quantity(statistics: Statistics) -> Column:
    return F.coalesce("quantity", "item_quantity", _overall(statistics, "quantity"))


def filled_price(statistics: Statistics) -> Column:
    return F.coalesce("price_per_unit", "item_price", _overall(statistics, "price_per_unit"))


def filled_category(statistics: Statistics, column: str) -> Column:
    return F.coalesce(F.col(column), _overall(statistics, column))


def fill_gaps(df: DataFrame, statistics: Statistics) -> DataFrame:
    """All gaps but the transaction id's filled; the total is left out.

    The total follows from quantity and price, so it need not travel through
    the duplicate removal; :func:`with_total` puts it back.
    """
    return (
        with_item_statistics(df, statistics)
        .withColumns({
            "quantity": filled_quantity(statistics),
            "price_per_unit": filled_price(statistics),
            # The item is filled last: its statistics belong to the known item.
            "item": filled_category(statistics, "item"),
            "payment_method": filled_category(statistics, "payment_method"),
            "location": filled_category(statistics, "location"),
        })
        .drop("item_quantity", "item_price", "total_spent")
    )


def with_total(df: DataFrame) -> DataFrame:
    """total_spent = quantity x price, placed after the price."""
    others = [c for c in df.columns if c != "total_spent"]
    at = others.index("price_per_unit") + 1
    return df.select(*others[:at], line_total().alias("total_spent"), *others[at:])
