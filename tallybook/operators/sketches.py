"""Statistics for filling gaps from sketches of bounded size instead of counts of every value.

A table of counts grows with the number of distinct values, which for continuous prices is that of the
sales. A sketch does not: per item there is one of quantities, one of prices and one of frequent
quantities. Sketches of parts of the data are merged, so each batch stores its own and nothing is read twice.

Bounds. A quantile's rank is off by at most ``RANK_ERROR`` of the values, with a probability of 99 % (the
sketch's published bound for ``K``, rounded up). A frequent value's count is exact while an item has at
most three quarters of ``TRACKED`` distinct values, else off by at most 3.5 / ``TRACKED`` of the item's
records. Means, sums and numbers of gaps are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.operators.imputation import Statistics
from tallybook.schemas import PRICE, QUANTITY
from tallybook.sources.staging import stage_table

K = 2048
RANK_ERROR = 0.003
TRACKED = 4096
# Steps of the grid on which a median of sketched and filled values is looked for; one step more may be lost.
GRID = 2000


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def value_sketches(standardised: DataFrame, k: int = K, tracked: int = TRACKED) -> DataFrame:
    """One row per item and kind: the sketches and exact sums of its records.

    ``kind`` is ``item``, or ``payment_method`` or ``location`` with the value in ``name`` and its number of
    records in ``n``. Sketches are combined before the shuffle, so a frequent item loads no task.
    """
    items = standardised.groupBy(F.lit("item").alias("kind"), F.col("item").alias("name")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("quantity").isNull()).alias("quantity_gaps"),
        F.count_if(F.col("price_per_unit").isNull()).alias("price_gaps"),
        F.sum("price_per_unit").alias("price_sum"),
        F.kll_sketch_agg_double(_double("quantity"), F.lit(k)).alias("quantities"),
        F.kll_sketch_agg_double(_double("price_per_unit"), F.lit(k)).alias("prices"),
        F.call_function("approx_top_k_accumulate", F.col("quantity"), F.lit(tracked)).alias("frequent"))
    few = [
        standardised.where(F.col(c).isNotNull()).groupBy(F.lit(c).alias("kind"), F.col(c).alias("name"))
        .agg(F.count(F.lit(1)).alias("n")) for c in ("payment_method", "location")]
    for counts in few:
        items = items.unionByName(counts, allowMissingColumns=True)
    return items


def merge_sketches(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Sketches of several parts of the data as one table."""
    sums = ("n", "quantity_gaps", "price_gaps", "price_sum")
    merged = sketches.where("kind = 'item'").groupBy("kind", "name").agg(
        *[F.sum(c).cast(sketches.schema[c].dataType).alias(c) for c in sums],
        F.kll_merge_agg_double("quantities").alias("quantities"), F.kll_merge_agg_double("prices").alias("prices"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(tracked)).alias("frequent"))
    few = sketches.where("kind <> 'item'").groupBy("kind", "name").agg(F.sum("n").alias("n"))
    return merged.unionByName(few, allowMissingColumns=True)


def quantiles(sketch: Column, probabilities: list[float]) -> Column:
    """Values of a sketch at the given shares of its values, null for an empty one."""
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, asked))


def frequent_values(sketch: Column, most: int = 64) -> Column:
    """(value, n) of the most frequent values, the smaller value first on a tie."""
    found = F.filter(F.call_function("approx_top_k_estimate", sketch, F.lit(most)), lambda x: x["item"].isNotNull())
    ordered = F.array_sort(F.transform(found, lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("value"))))
    return F.transform(ordered, lambda x: F.struct(x["value"].alias("value"), (-x["n"]).alias("n")))


def item_statistics(sketches: DataFrame) -> DataFrame:
    """Most frequent quantity and mean price of each item, as the exact counts give them."""
    return sketches.where("kind = 'item' AND name IS NOT NULL").select(
        F.col("name").alias("item"),
        F.get(frequent_values(F.col("frequent")), 0)["value"].cast(QUANTITY).alias("item_quantity"),
        F.try_divide("price_sum", F.col("n") - F.col("price_gaps")).cast(PRICE).alias("item_price"))


def _median_with_fills(sketch: str, fills: DataFrame, sketches: DataFrame) -> DataFrame:
    """One row with the median of a sketch's values and of (value, n) ``fills``, one row per item."""
    whole = sketches.where("kind = 'item'").agg(F.kll_merge_agg_double(sketch).alias("sketch"))
    filled = fills.where("value IS NOT NULL AND n > 0").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("filled"), F.collect_list(F.struct("value", "n")).alias("fills"))
    one = whole.select(F.struct("sketch").alias("w"), filled.select(F.struct("filled", "fills")).scalar().alias("f"))
    shares = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    points = F.arrays_zip(F.coalesce(quantiles(F.col("w.sketch"), [k / GRID for k in range(GRID + 1)]),
                                     F.array().cast("array<double>")).alias("value"), shares.alias("share"))
    both = one.select(
        F.kll_sketch_get_n_double("w.sketch").alias("known"), "f.*",
        F.filter(points, lambda p: p["value"].isNotNull()).alias("points"))
    both = both.withColumn("value", F.explode(F.array_distinct(F.concat(
        F.transform("points", lambda p: p["value"]), F.transform("fills", lambda x: x["value"])))))
    below = F.filter("points", lambda p: p["value"] <= F.col("value"))
    filled_below = F.filter("fills", lambda x: x["value"] <= F.col("value"))
    rank = (
        F.coalesce(F.array_max(F.transform(below, lambda p: p["share"])), F.lit(0.0)) * F.col("known")
        + F.aggregate(filled_below, F.lit(0).cast("long"), lambda done, x: done + x["n"])
    )
    return (
        both.where(rank >= 0.5 * (F.col("known") + F.col("filled"))).agg(F.min("value").alias("median"))
    )


def fit_sketches(sketches: DataFrame, price_median: str = "raw") -> Statistics:
    """Statistics as :func:`imputation.fit` gives them, the medians within ``RANK_ERROR`` by rank.

    ``sketches`` is a stored table, merged already.
    """
    by_item = stage_table(item_statistics(sketches), "item-statistics")
    gaps = sketches.where("kind = 'item'").join(by_item, F.col("name") == F.col("item"))
    quantities = gaps.select(_double("item_quantity").alias("value"), F.col("quantity_gaps").alias("n"))
    prices = gaps.select(_double("item_price").alias("value"),
                         (F.col("price_gaps") if price_median == "filled" else F.lit(0).cast("long")).alias("n"))

    def most(kind: str) -> Column:
        this = (F.col("kind") == kind) & F.col("name").isNotNull()
        return F.min_by("name", F.when(this, F.struct(-F.col("n"), "name")))

    overall = sketches.agg(*[most(c).alias(c) for c in ("item", "payment_method", "location")]).select(
        _median_with_fills("quantities", quantities, sketches).scalar().cast(QUANTITY).alias("quantity"),
        _median_with_fills("prices", prices, sketches).scalar().cast(PRICE).alias("price_per_unit"),
        "item", "payment_method", "location")
    return Statistics(by_item, stage_table(overall, "overall-statistics"))
