"""Calendar columns of a date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def calendar_columns(date: Column) -> dict[str, Column]:
    """Name -> expression, in the order of ``schemas.TIME``."""
    return {
        "day": F.dayofmonth(date),
        "day_of_week": F.date_format(date, "EEEE"),
        "is_weekend": (F.weekday(date) >= 5).cast("int"),  # Monday is 0
        "week": F.weekofyear(date),  # ISO week
        "month_num": F.month(date),
        "month": F.date_format(date, "MMMM"),
        "month_short": F.date_format(date, "MMM"),
        "month_start": F.trunc(date, "MM"),
        "quarter": F.concat(F.year(date), F.lit("Q"), F.quarter(date)),
        "quarter_label": F.concat(F.lit("Q"), F.quarter(date)),
        "year": F.year(date),
        "year_month": F.date_format(date, "yyyy-MM"),
    }


def month_index(date: Column) -> Column:
    """year * 12 + month: consecutive months differ by one."""
    return F.year(date) * 12 + F.month(date)
