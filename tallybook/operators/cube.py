"""All totals the report needs from one pass: every dimension, every pair of them, and the whole.

A level is a combination of at most two dimensions. The cube has a row per value of each level, so its
size follows the calendar and the categories.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from tallybook.functions.calendar import calendar_columns
from tallybook.operators.aggregates import SUMMED, additive

DIMENSIONS = ("month_start", "item", "payment_method", "location", "order_type")
WHOLE = "all"
# Calendar columns that a month or a year decides.
OF_YEAR = ("year",)
OF_MONTH = ("month_num", "month", "month_short", "quarter", "quarter_label", "year_month", *OF_YEAR)


def level_name(*keys: str) -> str:
    return "+".join(d for d in DIMENSIONS if d in keys) or WHOLE


def analysis_cube(sales: DataFrame, most: int = 2) -> DataFrame:
    """Totals of every combination of up to ``most`` dimensions, marked by ``level``.

    One grouping-sets aggregation, combined before its shuffle. Dimensions that ``sales`` lack are left
    out. A null value of a dimension is a value of its own: ``level`` tells it from a dimension that is
    summed up. No sales give no rows.
    """
    present = [d for d in DIMENSIONS if d in sales.columns]
    sets = [list(keys) for size in range(most + 1) for keys in combinations(present, size)]
    # The bit of a dimension is set where it is summed up.
    bits = {d: 1 << (len(present) - 1 - k) for k, d in enumerate(present)}
    names = [x for keys in sets for x in (
        F.lit(sum(b for d, b in bits.items() if d not in keys)).cast("bigint"), F.lit(level_name(*keys)))]
    rows = additive(sales).groupingSets(sets, *present).agg(
        F.element_at(F.create_map(*names), F.grouping_id().cast("bigint")).alias("level"),
        *[F.sum(c).alias(c) for c in SUMMED],
        F.sum("transactions").alias("transactions"),
        F.max("max_bill").alias("max_bill"),
    )
    return rows.select("level", *rows.drop("level").columns)


def level(cube: DataFrame, *keys: str) -> DataFrame:
    """The totals by ``keys``, ready for any operator that takes sales or a rollup.

    A cube stored by level reads that level's folder alone. Months come with the calendar columns they
    decide.
    """
    rows = cube.where(F.col("level") == level_name(*keys))
    rows = rows.drop("level", *[d for d in DIMENSIONS if d not in keys])
    if "month_start" in keys:
        calendar = calendar_columns(F.col("month_start"))
        rows = rows.withColumns({c: calendar[c] for c in OF_MONTH})
    return rows
