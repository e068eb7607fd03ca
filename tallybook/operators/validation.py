"""Checks as DataFrames of (check_name, violations, passed).

All row conditions of a report are counted in one pass over the data; schema
checks need no data at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallybook.config import COGS_RATE, SHOP, TOTAL_TOLERANCE, Vocabulary
from tallybook.functions.numbers import ratio
from tallybook.schemas import NUMERIC_COLUMNS


class CheckFailed(ValueError):
    """At least one check reported violations."""


def require(report: DataFrame) -> None:
    """Raise :class:`CheckFailed` naming every failed check."""
    failed = report.filter(~F.col("passed")).collect()  # one row per check
    if failed:
        raise CheckFailed("; ".join(f"{r.check_name}: {r.violations}" for r in failed))


def as_rows(counted: DataFrame) -> DataFrame:
    """One row per check from a one-row table with a column for each."""
    entries = [
        F.struct(F.lit(n).alias("check_name"), F.col(n).cast("bigint").alias("violations"))
        for n in counted.columns
    ]
    rows = counted.select(F.explode(F.array(*entries)).alias("row")).select("row.*")
    return rows.withColumn("passed", F.col("violations") == 0)


def _beyond(difference: Column, tolerance: str) -> Column:
    return F.abs(difference) > F.lit(tolerance).cast("decimal(6,4)")


def _schema_mismatch(df: DataFrame, expected: dict[str, type[T.DataType]]) -> int:
    actual = {f.name: f.dataType for f in df.schema.fields}
    return sum(not isinstance(actual.get(c), t) for c, t in expected.items())


def clean_figures(df: DataFrame, vocabulary: Vocabulary = SHOP,
                  tokens: tuple[str, ...] | None = None) -> dict[str, Column]:
    """Violations of each check on clean records, as aggregates."""
    looked_for = tokens if tokens is not None else tuple(t for t in vocabulary.invalid_tokens if t)
    text_columns = [n for n, t in df.dtypes if t == "string"]

    def over(conditions: list[Column]) -> Column:
        return sum((F.count_if(c) for c in conditions[1:]), F.count_if(conditions[0]))

    off = _beyond(F.col("total_spent") - F.col("quantity") * F.col("price_per_unit"),
                  TOTAL_TOLERANCE)
    outside = [
        F.col(name).isNull() | ~F.col(name).isin(*values)
        for name, values, _ in vocabulary.columns()
    ]
    return {
        "no_nulls": over([F.col(c).isNull() for c in df.columns]),
        "no_invalid_tokens": over([F.col(c).isin(*looked_for) for c in text_columns]),
        "numeric_types": F.lit(_schema_mismatch(df, {c: T.DecimalType for c in NUMERIC_COLUMNS})),
        "date_type": F.lit(_schema_mismatch(df, {"transaction_date": T.DateType})),
        "total_is_quantity_times_price": F.count_if(off),
        "categories_in_vocabulary": over(outside),
    }


def _counted(df: DataFrame, figures: dict[str, Column]) -> DataFrame:
    return as_rows(df.agg(*[c.alias(k) for k, c in figures.items()]))


def validate_clean(df: DataFrame, vocabulary: Vocabulary = SHOP,
                   tokens: tuple[str, ...] | None = None) -> DataFrame:
    """The six checks on clean records.

    ``tokens`` overrides the tokens looked for; by default they are the
    vocabulary's, without the empty string.
    """
    return _counted(df, clean_figures(df, vocabulary, tokens))


REQUIRED_FEATURES = ("revenue", "cost", "profit", "profit_margin_pct", "day", "day_of_week",
                     "month", "quarter", "year", "month_start")
REQUIRED_FEATURES_V1 = ("revenue", "cost", "profit", "day", "month", "quarter", "year")


def feature_figures(df: DataFrame, rate: str = COGS_RATE, tolerance: str = TOTAL_TOLERANCE,
                    required: tuple[str, ...] = REQUIRED_FEATURES) -> dict[str, Column]:
    """Violations of each check on engineered rows, as aggregates."""
    present = [c for c in required if c in df.columns]
    gaps = sum((F.count_if(F.col(c).isNull()) for c in present), F.lit(0))
    product = F.col("quantity") * F.col("price_per_unit")
    cost = F.col("revenue") * F.lit(rate).cast("decimal(4,2)")
    if tolerance == "0":
        cost = F.round(cost, 2)
    return {
        "features_present": F.lit(len(required) - len(present)),
        "features_filled": gaps,
        "revenue_identity": F.count_if(_beyond(F.col("revenue") - product, tolerance)),
        "cost_identity": F.count_if(_beyond(F.col("cost") - cost, tolerance)),
        "profit_identity": F.count_if(_beyond(F.col("profit") - (F.col("revenue") - F.col("cost")), tolerance)),
    }


def validate_features(df: DataFrame, rate: str = COGS_RATE, tolerance: str = TOTAL_TOLERANCE,
                      required: tuple[str, ...] = REQUIRED_FEATURES) -> DataFrame:
    """Engineered columns present and filled, money identities within tolerance.

    ``tolerance="0"`` asks for exact equality, as the older rules do: revenue
    with the unrounded product, cost with the rounded share of revenue.
    """
    return _counted(df, feature_figures(df, rate, tolerance, required))


def margin_figures() -> dict[str, Column]:
    return {f"total_{c}": F.sum(c) for c in ("revenue", "cost", "profit")}


def validate_margin(df: DataFrame, rate: str = COGS_RATE, limit: float = 0.05) -> DataFrame:
    """Overall margin against the one the cost rate implies, in points."""
    return margin_row(df.agg(*[c.alias(k) for k, c in margin_figures().items()]), rate, limit)


def margin_row(sums: DataFrame, rate: str = COGS_RATE, limit: float = 0.05) -> DataFrame:
    expected = (1 - float(rate)) * 100
    return (
        sums.withColumn("actual_margin_pct", ratio("total_profit", "total_revenue") * 100)
        .withColumn("expected_margin_pct", F.lit(expected))
        .withColumn("deviates", F.abs(F.col("actual_margin_pct") - expected) > limit)
    )
