"""Schemas at the job boundaries (snake_case throughout)."""

from __future__ import annotations

from pyspark.sql import types as T

# As wide as the product of quantity and price stays exact: 18 + 18 + 1 digits.
QUANTITY = T.DecimalType(18, 2)
PRICE = T.DecimalType(18, 6)
MONEY = T.DecimalType(18, 2)

RAW_COLUMNS = ("transaction_id", "item", "quantity", "price_per_unit",
               "total_spent", "payment_method", "location", "transaction_date")
NUMERIC_COLUMNS = {"quantity": QUANTITY, "price_per_unit": PRICE, "total_spent": MONEY}
CATEGORICAL_COLUMNS = ("item", "payment_method", "location")

RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

CLEAN = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("quantity", QUANTITY),
    T.StructField("price_per_unit", PRICE),
    T.StructField("total_spent", MONEY),
    T.StructField("payment_method", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("transaction_date", T.DateType()),
])

FINANCIAL = T.StructType([
    T.StructField("revenue", MONEY),
    T.StructField("cost", MONEY),
    T.StructField("profit", MONEY),
    T.StructField("profit_margin_pct", T.DoubleType()),
])

TIME = T.StructType([
    T.StructField("day", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("month_num", T.IntegerType()),
    T.StructField("month", T.StringType()),
    T.StructField("month_short", T.StringType()),
    T.StructField("month_start", T.DateType()),
    T.StructField("quarter", T.StringType()),
    T.StructField("quarter_label", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("year_month", T.StringType()),
])

ENGINEERED = T.StructType(CLEAN.fields + FINANCIAL.fields + TIME.fields)


def with_extras(schema: T.StructType, *names: str) -> T.StructType:
    """``schema`` followed by further text columns (order type, customer)."""
    return T.StructType(schema.fields + [T.StructField(n, T.StringType()) for n in names])
