"""Cube, lattice, clustered layout and driver effects."""

import glob
import itertools
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import frames
from tallybook import schemas
from tallybook.operators import aggregates, cube, drivers, features, kpis, measures, trends
from tallybook.plans import lattice, registry, report
from tallybook.sources import files, layout


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def mixed(spark):
    pick = random.Random(5)
    rows = [(pick.choice(("Tea", "Cake", "Juice")), pick.randint(1, 9), pick.choice((2, 3.5, 4.25)),
             f"20{pick.choice((22, 23))}-{pick.randint(1, 12):02}-{pick.randint(1, 28):02}",
             pick.choice(("In-Store", "Takeaway")), pick.choice(("Cash", "Card"))) for _ in range(200)]
    return frames.sales(spark, *rows)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- cube -------------------------------------------------------------------


def test_levels_equal_the_totals_of_the_sales(spark):
    sales = mixed(spark)
    stored = report.store_cube(sales)
    for keys in ((), ("item",), ("month_start",), ("month_start", "item"), ("payment_method", "location")):
        names = [*keys, "revenue", "profit", "transactions", "max_bill"]
        assert rows(aggregates.totals(cube.level(stored, *keys), *keys).select(names)) == rows(
            aggregates.totals(sales, *keys).select(names))
    assert rows(trends.quarterly_trend(cube.level(stored, "month_start"))) == rows(trends.quarterly_trend(sales))


def test_a_null_value_is_not_a_sum(spark):
    sales = mixed(spark).withColumn("item", F.when(F.col("item") != "Cake", F.col("item")))
    found = cube.level(cube.analysis_cube(sales), "item")
    assert found.count() == 3 and rows(found.select("item", "revenue")) == rows(
        sales.groupBy("item").agg(F.sum("revenue")))


def test_no_sales_still_make_a_report(spark):
    none = mixed(spark).limit(0)
    analysis = report.analyse(none)
    assert rows(analysis.executive) == rows(kpis.executive_kpis(none))
    assert report.report_lines(analysis).count() > 40


def test_the_report_scans_the_rollup_once(spark, folder):
    mixed(spark).write.parquet(f"{folder}/sales")
    sales = spark.read.parquet(f"{folder}/sales")
    made = plan(cube.analysis_cube(sales))
    assert made.count("FileScan") == 1 and made.count("Exchange hashpartitioning") == 1 and "partial_sum" in made
    text = plan(report.report_lines(report.analyse(sales)))
    # The lines read the stored totals, each section the folder of its own level.
    assert f"{folder}/sales" not in text
    assert text.count("FileScan") == text.count("PartitionFilters: [isnotnull(level")


# --- lattice ----------------------------------------------------------------


def test_answers_equal_the_rollup_and_read_less(spark):
    sales = mixed(spark)
    rollup = report.sales_rollup(sales)
    stored = lattice.Lattice(rollup, most=4)
    assert len(stored.stored) == 5
    spared = 0
    for keys in (("item",), ("location", "month_start"), ("year",), ("item", "payment_method"), ("week", "item"), ()):
        names = [*keys, "revenue", "quantity", "transactions", "max_bill"]
        found = stored.rows(*keys)
        assert rows(aggregates.totals(found, *keys).select(names)) == rows(aggregates.totals(sales, *keys).select(names))
        spared += found.count() < rollup.count()
    assert spared >= 4
    # A measure with a slicer names the slicer's column too.
    chosen = measures.in_context(stored.rows("item", "location"), location="Takeaway")
    assert rows(measures.core_measures(chosen, ("item",))) == rows(
        measures.core_measures(measures.in_context(sales, location="Takeaway"), ("item",)))
    with pytest.raises(ValueError):
        stored.rows("customer_id")


def test_greedy_choice_takes_what_spares_most():
    a, b, ab, none = (frozenset(x) for x in ("a", "b", "ab", ""))
    rows_of = {ab: 100, a: 10, b: 90, none: 1}
    # a spares 90 for itself and 90 for the total; b only 10 for itself then.
    assert lattice.choose(rows_of, ab, 1) == [a]
    assert lattice.choose(rows_of, ab, 9) == [a, b, none]
    assert lattice.choose(rows_of, ab, 1, {b: 5.0, none: 0.1}) == [b]
    assert lattice.choose({ab: 5, a: 5, b: 5, none: 5}, ab, 3) == []


# --- layout -----------------------------------------------------------------


def groups_read(path, **wanted):
    """(row groups whose footers admit the wanted values, all row groups)."""
    read = total = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics
                       for c in range(meta.num_columns)}
            total += 1
            read += all(any(columns[c].min <= v <= columns[c].max for v in values) for c, values in wanted.items())
    return read, total


def test_a_slicer_reads_few_row_groups(spark, folder):
    n = F.col("id")
    many = spark.range(0, 400_000, 1, 8).select(
        F.concat(F.lit("Item "), F.lpad((F.xxhash64(n) % 40 + 40).cast("string"), 3, "0")).alias("item"),
        # One place has most of the rows.
        F.when(n % 3 == 0, F.concat(F.lit("P"), (F.abs(F.xxhash64(n, F.lit(1))) % 8))).otherwise("Main").alias("location"),
        F.concat(F.lit("M"), F.abs(F.xxhash64(n, F.lit(2))) % 5).alias("payment_method"), n.alias("amount"))
    columns = ("item", "location", "payment_method")
    many.write.parquet(f"{folder}/plain")
    source = spark.read.parquet(f"{folder}/plain")
    layout.write_clustered(source, f"{folder}/by-key", columns, row_group_bytes=32 << 10)
    stored = spark.read.parquet(f"{folder}/by-key")
    items = ["Item 007", "Item 031"]
    read, total = groups_read(f"{folder}/by-key", item=items)
    assert total >= 40 and read < total / 5
    both, _ = groups_read(f"{folder}/by-key", item=items, location=["P3"])
    assert both < read
    place, _ = groups_read(f"{folder}/by-key", location=["P3"])
    assert place < total * 2 / 3
    chosen = measures.in_context(stored, item=items)
    assert "In(item" in plan(chosen) or "item IN" in plan(chosen)
    assert chosen.agg(F.sum("amount"), F.count("*")).first() == measures.in_context(source, item=items).agg(
        F.sum("amount"), F.count("*")).first()


def test_layout_keeps_every_row(spark, folder):
    few = spark.createDataFrame([("a", None, 1), (None, "x", 2), ("a", "x", 3), ("a", "x", 3), ("", "y", 4)],
                                "item string, location string, n int")
    layout.write_clustered(few, f"{folder}/few", ("item", "location"))
    assert rows(spark.read.parquet(f"{folder}/few")) == rows(few)
    layout.write_clustered(few.limit(0), f"{folder}/none", ("item", "location"))
    assert spark.read.schema(few.schema).parquet(f"{folder}/none").count() == 0


def test_cut_points_follow_the_rows(spark):
    df = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("v"))
    cuts = layout.cut_points(df, "v", bits=4)
    placed = df.groupBy(layout.position("v", cuts).alias("p")).count().collect()
    assert len(cuts) == 15 and len(placed) == 16 and max(r["count"] for r in placed) < 1500
    two = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert layout.cut_points(two, "v") == ["b"]
    assert rows(two.select(layout.position("v", ["b"]))) == [(0,), (0,), (1,), (1,)]


# --- drivers ----------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_effects_equal_the_mean_over_all_orders(spark, n):
    pick = random.Random(n)
    before, now = ([pick.uniform(0, 5) for _ in range(n)] for _ in range(2))
    found = spark.range(1).select(*[e.alias(f"e{k}") for k, e in enumerate(drivers.shapley_effects(
        [F.lit(x) for x in before], [F.lit(x) for x in now]))]).first()

    def product(changed):
        value = 1.0
        for k in range(n):
            value *= now[k] if k in changed else before[k]
        return value

    expected = [0.0] * n
    orders = list(itertools.permutations(range(n)))
    for order in orders:
        for k, driver in enumerate(order):
            expected[driver] += (product(order[:k + 1]) - product(order[:k])) / len(orders)
    assert list(found) == pytest.approx(expected)
    assert sum(found) == pytest.approx(product(range(n)) - product(()))


def test_driver_effects_add_up_to_the_cent(spark):
    found = drivers.revenue_drivers(mixed(spark)).collect()
    assert len(found) == 2
    for r in found:
        assert r.volume_effect + r.mix_effect + r.price_effect == r.change == r.revenue - r.prior_revenue


def test_drivers_without_a_base(spark):
    # Tea only before, Cake only now, and a place that is new.
    sales = frames.sales(spark, ("Tea", 10, 2, "2022-05-01"), ("Cake", 10, 3, "2023-05-01"),
                         ("Tea", 4, 5, "2023-05-01", "Delivery"))
    found = {r.location: r for r in drivers.revenue_drivers(sales).collect()}
    old, new = found["In-Store"], found["Delivery"]
    # As many units, at prices that did not change: all is mix.
    assert (old.volume_effect, old.mix_effect, old.price_effect) == (0, 10, 0)
    assert (new.volume_effect, new.mix_effect, new.price_effect) == (20, 0, 0)


def test_rounding_rest_goes_to_the_largest(spark):
    total = F.lit(Decimal("1.00"))
    whole = drivers.rounded_to_total({"a": F.lit(0.333), "b": F.lit(0.333), "c": F.lit(0.334)}, total)
    assert tuple(spark.range(1).select(*[whole[k].alias(k) for k in whole]).first()) == (
        Decimal("0.34"), Decimal("0.33"), Decimal("0.33"))


def test_columns_are_derived_once_the_rows_are_in_order(spark, folder):
    sales = mixed(spark)
    clean = sales.select(*schemas.CLEAN.names, "year_month")
    seen = []

    def derive(df):
        seen.append(plan(df))
        return features.engineer(df)

    layout.write_clustered(clean, f"{folder}/sales", ("item", "location"), ("year_month",), derive=derive)
    assert "rangepartitioning" in seen[0] and "quarter_label" not in seen[0] and "revenue" not in seen[0]
    stored = files.read_engineered(spark, f"{folder}/sales")
    assert rows(stored) == rows(sales.select(*stored.columns))


def test_clustered_sales_are_stored_before_columns_are_derived(spark, small, monkeypatch):
    kept = []
    monkeypatch.setattr(registry, "stage_table", lambda df, *rest, stage=registry.stage_table: kept.append(df) or stage(df, *rest))
    registry.queries()["view_clustered_slicer"](spark, small)
    assert "transaction_id" in kept[0].columns and not {"revenue", "quarter_label"} & set(kept[0].columns)


def test_the_hash_that_spreads_equal_keys_does_not_travel(spark):
    text = layout.clustered(mixed(spark), ("item", "location"))._jdf.queryExecution().optimizedPlan().toString()
    travels = text.split("RepartitionByExpression")[1]
    assert "xxhash64" in travels.splitlines()[0] and "xxhash64" not in travels.split("\n", 1)[1]
