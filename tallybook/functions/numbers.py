"""Ratios, growth and rounding that never fail on a zero or missing base."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def real(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole as a double, null when whole is zero or missing."""
    return F.try_divide(real(part), real(whole))


def pct(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    return F.round(ratio(part, whole) * 100, places)


def growth(current: Column | str, previous: Column | str) -> Column:
    """Relative change as a fraction."""
    return F.try_divide(real(current) - real(previous), real(previous))


def growth_pct(current: Column | str, previous: Column | str, places: int = 2) -> Column:
    return F.round(growth(current, previous) * 100, places)


def mean(total: Column | str, count: Column | str, places: int = 2) -> Column:
    return F.round(ratio(total, count), places)
