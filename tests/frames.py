"""Small hand-made inputs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tallybook import schemas
from tallybook.operators import features

RAW = ("T1", "Coffee", "2", "3.00", "6.00", "Cash", "In-Store", "2023-01-05")


def raw(spark, *changes):
    """A raw record per dict of changes to a valid one."""
    names = schemas.RAW_COLUMNS
    rows = [tuple(c.get(n, v) for n, v in zip(names, RAW)) for c in changes]
    return spark.createDataFrame(rows, schemas.RAW)


def clean(spark, *rows):
    """Clean records from (item, quantity, price, date, location, payment)."""
    data = []
    for i, (item, quantity, price, date, *rest) in enumerate(rows):
        location = rest[0] if rest else "In-Store"
        payment = rest[1] if len(rest) > 1 else "Cash"
        q, p = Decimal(str(quantity)), Decimal(str(price))
        data.append((f"T{i}", item, q, p, round(q * p, 2), payment, location,
                     dt.date.fromisoformat(date)))
    return spark.createDataFrame(data, schemas.CLEAN)


def sales(spark, *rows, rates=None):
    return features.engineer(clean(spark, *rows), rates)


def months(spark, *pairs):
    """One sale per (date, revenue)."""
    return sales(spark, *[("Tea", 1, revenue, date) for date, revenue in pairs])


def by(df, key, value):
    return {row[key]: row[value] for row in df.collect()}
