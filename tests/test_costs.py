"""Rates as of the day of sale, against a search through all rates."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import frames
from tallybook.operators import costs

RATES = [("Tea", dt.date(2023, 1, 10), "0.50"), ("Tea", dt.date(2023, 2, 1), "0.40"), ("Tea", dt.date(2023, 2, 1), "0.45"),
         ("Cake", dt.date(2024, 1, 1), "0.90"), (None, dt.date(2020, 1, 1), "0.99"), ("Cookie", None, "0.99"),
         ("Unsold", dt.date(2020, 1, 1), "0.99")]
SCHEMA = "item string, valid_from date, cogs_rate string"


def expected(item, day, rates):
    known = [(d, Decimal(r)) for i, d, r in rates if i == item and i and d and d <= day]
    return max(known)[1] if known else None


@pytest.mark.parametrize("parts", [1, 5, 32])
def test_the_last_rate_up_to_the_day_counts(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["Tea", "Tea", "Cake", "Cookie"]), 1, 10, f"2023-{rng.randint(1, 3):02d}-{rng.randint(1, 28):02d}")
            for _ in range(300)]
    rows += [("Tea", 1, 10, d) for d in ("2023-01-09", "2023-01-10", "2023-01-31", "2023-02-01")]
    sales = frames.clean(spark, *rows)
    got = costs.with_rate_as_of(sales, spark.createDataFrame(RATES, SCHEMA), parts)
    assert got.columns == [*sales.columns, "cogs_rate"]
    found = got.collect()
    assert len(found) == len(rows)
    assert all(r.cogs_rate == expected(r.item, r.transaction_date, RATES) for r in found)


def test_sales_without_rates_take_the_default(spark):
    sales = frames.clean(spark, ("Tea", 2, 5, "2023-01-01"), ("Tea", 2, 5, "2023-03-01"))
    priced = costs.add_financials_as_of(sales, spark.createDataFrame(RATES, SCHEMA)).orderBy("transaction_date").collect()
    assert [(r.cost, r.profit) for r in priced] == [(Decimal("6.00"), Decimal("4.00")), (Decimal("4.50"), Decimal("5.50"))]
    none = costs.add_financials_as_of(sales, spark.createDataFrame([], SCHEMA))
    assert [r.cost for r in none.collect()] == [Decimal("6.00")] * 2


def test_repeated_sales_stay_and_no_join_by_range(spark):
    sales = frames.clean(spark, *[("Tea", 1, 10, "2023-02-03")] * 3)
    again = sales.unionByName(sales)
    priced = costs.add_financials_as_of(again, spark.createDataFrame(RATES, SCHEMA))
    assert priced.count() == 6
    text = priced._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "CartesianProduct" not in text


def test_sales_travel_without_a_copy_of_their_columns(spark):
    priced = costs.with_rate_as_of(frames.clean(spark, ("Tea", 1, 10, "2023-02-03")), spark.createDataFrame(RATES, SCHEMA))
    text = priced._jdf.queryExecution().executedPlan().toString()
    assert "struct" not in text and text.count("Exchange hashpartitioning(item") >= 1


def test_columns_called_like_those_of_the_rates_stay(spark):
    sales = frames.clean(spark, ("Tea", 1, 10, "2023-01-20"), ("Cake", 1, 10, "2023-01-20"))
    named = sales.selectExpr("*", "'a' AS rate", "'b' AS part", "'c' AS day").withColumn("location", F.lit(None).cast("string"))
    found = costs.with_rate_as_of(named, spark.createDataFrame(RATES, SCHEMA)).collect()
    assert {(r.item, r.rate, r.part, r.day, r.location, r.cogs_rate) for r in found} == {
        ("Tea", "a", "b", "c", None, Decimal("0.50")), ("Cake", "a", "b", "c", None, None)}


def test_an_item_is_dealt_over_more_tasks_than_a_core_has(spark):
    """A part is held in memory as a whole, so parts must stay small on large tables."""
    sales = frames.clean(spark, *[("Tea", 1, 10, "2023-02-03")] * 4).crossJoin(spark.range(500)).withColumn(
        "transaction_id", F.concat("transaction_id", F.lit("-"), "id")).drop("id")
    dealt = sales.select(F.pmod(F.xxhash64(*sales.columns), F.lit(costs.PARTS)).alias("part")).groupBy("part").count()
    assert dealt.agg(F.max("count")).first()[0] < 2000 / 32
