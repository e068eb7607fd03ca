"""Dashboard measures evaluated in a filter context.

The context is what the caller filters (:func:`in_context`) and groups by.
Measures relative to *all* items leave the item out of that context: they take
item filters as an argument and apply them after the total is known.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybook.config import COGS_RATE
from tallybook.functions.calendar import calendar_columns, month_index
from tallybook.functions.numbers import growth, ratio, real
from tallybook.operators.aggregates import totals

# Margin classes and their lower bounds.
MARGIN_CLASSES = ((0.38, "High Margin (≥38%)"), (0.32, "Mid Margin (32–38%)"))
LOWEST_CLASS = "Low Margin (<32%)"

# Title texts and the growth label.
DATE_TITLE, REVENUE_TITLE = "Revenue Analysis · ", "Total Revenue ("
GROWTH_LABEL, UP, DOWN, NO_GROWTH = "%.1f%% vs LM", "▲ ", "▼ ", "—"

# Unrounded sums of quantity x price.
GROSS = "decimal(28,8)"


def in_context(sales: DataFrame, date_from: str | None = None, date_to: str | None = None,
               **values: str | Iterable[str]) -> DataFrame:
    """Slicers: a date range and, by column name, one value or several.

    Plain comparisons on stored columns, so they reach the file scan; dates
    (yyyy-mm-dd) also limit the month, by which engineered sales are laid out.
    """
    monthly = "year_month" in sales.columns
    if date_from:
        sales = sales.filter(F.col("transaction_date") >= F.lit(date_from).cast("date"))
        if monthly:
            sales = sales.filter(F.col("year_month") >= F.lit(str(date_from)[:7]))
    if date_to:
        sales = sales.filter(F.col("transaction_date") <= F.lit(date_to).cast("date"))
        if monthly:
            sales = sales.filter(F.col("year_month") <= F.lit(str(date_to)[:7]))
    for column, wanted in values.items():
        wanted = [wanted] if isinstance(wanted, str) else list(wanted)
        sales = sales.filter(F.col(column).isin(*wanted))
    return sales


def date_dimension(sales: DataFrame) -> DataFrame:
    """One row per day from the first to the last sale."""
    span = sales.agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last"))
    days = span.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("date"))
    return days.withColumns({
        **calendar_columns(F.col("date")),
        "month_idx": month_index(F.col("date")),
    })


def core_measures(sales: DataFrame, by: tuple[str, ...] = (), rate: str | None = COGS_RATE) -> DataFrame:
    """Revenue, cost, profit, margin, transaction value and count.

    Revenue is the unrounded sum of quantity x price. Cost is ``rate`` times
    the total; with ``rate=None`` it is the sum of the cost column instead.
    """
    revenue = F.coalesce(F.col("gross"), F.lit(0)).cast(GROSS)
    if rate is None:
        cost = F.coalesce(F.col("cost"), F.lit(0))
    else:
        cost = revenue * F.lit(rate).cast("decimal(4,2)")
    return (
        totals(sales, *by)
        .select(*by, revenue.alias("total_revenue"), cost.alias("total_cost"),
                F.col("transactions").alias("total_transactions"))
        .withColumn("total_profit", F.col("total_revenue") - F.col("total_cost"))
        .withColumn("profit_margin", F.coalesce(ratio("total_profit", "total_revenue"), F.lit(0.0)))
        .withColumn("avg_transaction_value",
                    F.coalesce(ratio("total_revenue", "total_transactions"), F.lit(0.0)))
    )


def margin_class(margin: Column | str = "profit_margin") -> Column:
    margin = F.col(margin) if isinstance(margin, str) else margin
    label = F.lit(LOWEST_CLASS)
    for bound, name in reversed(MARGIN_CLASSES):
        label = F.when(margin >= bound, name).otherwise(label)
    return label


# --- calendar measures ------------------------------------------------------


def monthly_spine(sales: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Revenue of every calendar month from the first to the last sale.

    Months without sales are present with a null revenue; with ``by`` each
    group gets every month of the overall range.
    """
    monthly = totals(sales, *by, month_index(F.col("transaction_date")).alias("month_idx")).select(
        *by, "month_idx", F.col("gross").cast(GROSS).alias("total_revenue"))
    span = sales.agg(F.min(month_index(F.col("transaction_date"))).alias("first"),
                     F.max(month_index(F.col("transaction_date"))).alias("last"))
    if by:
        groups = monthly.select(*by).distinct()
        ends = span.select(F.struct("first", "last")).scalar()
        span = groups.withColumn("ends", ends).select(*by, "ends.first", "ends.last")
    else:
        span = span.where("first IS NOT NULL")
    spine = span.select(*by, F.explode(F.sequence("first", "last")).alias("month_idx"))
    year = F.expr("(month_idx - 1) div 12").cast("int")
    month = (F.pmod(F.col("month_idx") - 1, F.lit(12)) + 1).cast("int")
    return spine.join(monthly, [*by, "month_idx"], "left").select(
        *by,
        "month_idx",
        year.alias("year"),
        F.make_date(year, month, F.lit(1)).alias("month_start"),
        "total_revenue",
    )


def _shifted(by: tuple[str, ...], first: int, last: int) -> Column:
    window = Window.partitionBy(*by).orderBy("month_idx").rangeBetween(first, last)
    return F.sum("total_revenue").over(window)


def _against(previous: Column | str) -> Column:
    """Growth on a period that exists; a month without sales counts as zero."""
    return growth(F.coalesce(F.col("total_revenue"), F.lit(0)), previous)


def month_over_month(spine: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Growth on the previous calendar month, null where that had no sales."""
    return spine.withColumn("previous_month", _shifted(by, -1, -1)).withColumn(
        "mom_growth", _against("previous_month"))


def year_over_year(spine: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Revenue of the same month a year before, and growth on it."""
    return spine.withColumn("revenue_py", _shifted(by, -12, -12)).withColumn(
        "yoy_growth", _against("revenue_py"))


def year_to_date(spine: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    window = Window.partitionBy(*by, "year").orderBy("month_idx").rowsBetween(
        Window.unboundedPreceding, 0)
    return spine.withColumn("revenue_ytd", F.sum("total_revenue").over(window))


def rolling_three_months(spine: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A third of the last three calendar months, however many had sales."""
    return spine.withColumn("revenue_3m_rolling_avg", real(_shifted(by, -2, 0)) / 3)


def growth_label(fraction: Column | str = "mom_growth") -> Column:
    """'▲ 12.6% vs LM', '▼ 3.0% vs LM' or a dash."""
    fraction = F.col(fraction) if isinstance(fraction, str) else fraction
    shown = F.format_string(GROWTH_LABEL, F.abs(fraction) * 100)
    return (
        F.when(fraction.isNull(), NO_GROWTH)
        .when(fraction >= 0, F.concat(F.lit(UP), shown))
        .otherwise(F.concat(F.lit(DOWN), shown))
    )


def with_default(measured: DataFrame, column: str, default: float) -> DataFrame:
    """Show ``default`` instead of a blank, as some dashboards do."""
    return measured.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


# --- measures relative to all items -----------------------------------------


def _items(sales: DataFrame, by: tuple[str, ...], rate: str | None) -> DataFrame:
    return core_measures(sales, (*by, "item"), rate)


def _only(df: DataFrame, items: Iterable[str] | None) -> DataFrame:
    return df if items is None else df.filter(F.col("item").isin(*items))


def contribution(sales: DataFrame, by: tuple[str, ...] = (), items: Iterable[str] | None = None,
                 rate: str | None = COGS_RATE) -> DataFrame:
    """Each item's share of the revenue and profit of all items in its group."""
    group = Window.partitionBy(*by)

    def share(column: str) -> Column:
        return F.coalesce(ratio(column, F.sum(column).over(group)), F.lit(0.0))

    shares = _items(sales, by, rate).select(
        *by, "item", "total_revenue", "total_profit",
        share("total_revenue").alias("revenue_contribution"),
        share("total_profit").alias("profit_contribution"))
    return _only(shares, items)


def rank_with_total(sales: DataFrame, items: Iterable[str] | None = None) -> DataFrame:
    """Dense revenue rank among all items; the total row has no rank."""
    ranked = _items(sales, (), None).select(
        "item", "total_revenue",
        F.dense_rank().over(Window.orderBy(F.desc("total_revenue"))).alias("revenue_rank"))
    return (
        _only(ranked, items)
        .rollup("item", "revenue_rank")
        .agg(F.sum("total_revenue").alias("total_revenue"),
             F.grouping_id().alias("level"))
        .filter(F.col("level") != 1)  # the item subtotal repeats the item
        .select("item", (F.col("level") == 3).alias("is_total"), "total_revenue", "revenue_rank")
    )


def top_n(sales: DataFrame, n: int = 5, by: tuple[str, ...] = (),
          items: Iterable[str] | None = None) -> DataFrame:
    """Revenue of the top n items of the group, ties kept, beside each item."""
    ordered = Window.partitionBy(*by).orderBy(F.desc("total_revenue"))
    ranked = _items(sales, by, None).withColumns({
        "position": F.rank().over(ordered), "revenue_rank": F.dense_rank().over(ordered)})
    inside = F.sum(F.when(F.col("position") <= n, F.col("total_revenue"))).over(
        Window.partitionBy(*by))
    return _only(ranked.select(
        *by, "item", "total_revenue", inside.alias("top_n_revenue"), "revenue_rank",
        (F.col("revenue_rank") <= n).alias("is_top_n")), items)


# --- titles -----------------------------------------------------------------


def titles(sales: DataFrame) -> DataFrame:
    """Page and card titles for the date range of the context."""
    span = sales.agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last"))
    return span.select(
        F.concat(F.lit(DATE_TITLE), F.date_format("first", "dd MMM yyyy"),
                 F.lit(" – "), F.date_format("last", "dd MMM yyyy")).alias("title_date_range"),
        F.concat(F.lit(REVENUE_TITLE), F.date_format("last", "MMM yyyy"), F.lit(")"))
        .alias("title_revenue_kpi"),
    )
