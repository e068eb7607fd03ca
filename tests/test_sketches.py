"""Sketches against exact counts and quantiles, whole and merged from parts."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.operators import imputation, sketches
from tallybook.plans.clean import fit_statistics

COLUMNS = "item string, quantity decimal(18,2), price_per_unit decimal(18,6), payment_method string, location string"


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(30_000):
        price = None if rng.random() < 0.1 else Decimal(str(round(rng.lognormvariate(3, 1.5), 6)))
        quantity = None if rng.random() < 0.2 else Decimal(rng.choice([1, 2, 2, 3, 5, 8, 13]))
        rows.append((rng.choice(["Tea", "Tea", "Tea", "Cake", "Juice", None]), quantity, price,
                     rng.choice(["Cash", "Card", None]), rng.choice(["Here", "There", "There", None])))
    rows += [("Empty", None, None, None, None)] * 3
    return spark.createDataFrame(rows, COLUMNS).repartition(6).cache()


def parts_of(records):
    part = F.pmod(F.hash("quantity", "price_per_unit", "item"), F.lit(5))
    return [records.where(part == k) for k in range(5)]


def merged(records):
    parts = [sketches.value_sketches(p) for p in parts_of(records)]
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    return sketches.merge_sketches(table)


def share_below(records, column, value):
    known = records.where(F.col(column).isNotNull())
    below, upto, n = known.agg(F.count_if(F.col(column).cast("double") < value),
                               F.count_if(F.col(column).cast("double") <= value), F.count("*")).first()
    return below / n, upto / n


@pytest.mark.parametrize("whole", [True, False])
def test_quantiles_keep_the_rank_bound(spark, records, whole):
    table = (sketches.value_sketches(records) if whole else merged(records)).where("kind = 'item'")
    shares = [0.01, 0.25, 0.5, 0.9, 0.999]
    row = table.agg(F.kll_merge_agg_double("prices").alias("prices")).select(
        sketches.quantiles(F.col("prices"), shares).alias("q"), F.kll_sketch_get_n_double("prices").alias("n")).first()
    assert row.n == records.where("price_per_unit IS NOT NULL").count()
    for share, value in zip(shares, row.q):
        low, high = share_below(records, "price_per_unit", value)
        assert low - sketches.RANK_ERROR <= share <= high + sketches.RANK_ERROR


def test_sketch_sizes_do_not_follow_the_data(spark, records):
    size = sketches.value_sketches(records).agg(F.max(F.length("prices")), F.max(F.length("frequent.sketch"))).first()
    assert size[0] < 100_000 and size[1] < 20_000


@pytest.mark.parametrize("price_median", ["raw", "filled"])
def test_statistics_from_parts_equal_the_exact_ones(spark, records, folder, price_median):
    merged(records).write.parquet(f"{folder}/sketches")
    rough = sketches.fit_sketches(spark.read.parquet(f"{folder}/sketches"), price_median)
    exact = fit_statistics(records, price_median)
    assert sorted(map(str, rough.by_item.collect())) == sorted(map(str, exact.by_item.where("item IS NOT NULL").collect()))
    a, b = rough.overall.first(), exact.overall.first()
    assert (a.item, a.payment_method, a.location, a.quantity) == (b.item, b.payment_method, b.location, b.quantity)
    assert rough.overall.schema["price_per_unit"].dataType == schemas.PRICE
    filled = records
    if price_median == "filled":
        filled = imputation.with_item_statistics(records, exact).withColumn(
            "price_per_unit", F.coalesce("price_per_unit", "item_price"))
    low, high = share_below(filled, "price_per_unit", float(a.price_per_unit))
    assert low - 2 * sketches.RANK_ERROR <= 0.5 <= high + 2 * sketches.RANK_ERROR


def test_no_records(spark, records, folder):
    sketches.merge_sketches(sketches.value_sketches(records.limit(0))).write.parquet(f"{folder}/none")
    rough = sketches.fit_sketches(spark.read.parquet(f"{folder}/none"))
    assert rough.by_item.count() == 0 and rough.overall.first().quantity is None
