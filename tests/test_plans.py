"""The physical plans stay the ones meant: no Python, no row-level windows, one shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from tallybook.config import Vocabulary
from tallybook.operators import aggregates, cleaning, features, imputation
from tallybook.plans import clean, registry
from tallybook.sources import staging
from tallybook.sources.sample_tables import SAMPLE, SAMPLE_COST_RATES, raw_sales


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "raw")
    raw_sales(spark, small).write.parquet(path)
    raw = spark.read.parquet(path)
    standardised = cleaning.standardised_records(raw, SAMPLE)
    return standardised, clean.fit_statistics(standardised)


def test_row_local_cleaning_does_not_shuffle(stored):
    text = plan(stored[0])
    # The only join is the item lookup, and its side is small.
    assert "Exchange hashpartitioning" not in text and text.count("BroadcastHashJoin") == 1


def test_statistics_come_from_one_scan(stored):
    text = plan(imputation.value_counts(stored[0]))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    # Counted before the shuffle, and only the needed columns read.
    assert text.count("partial_count") == 1
    assert "total_spent" not in text and "transaction_id" not in text


def test_cleaning_shuffles_once(stored):
    standardised, statistics = stored
    text = plan(clean.clean_records(standardised, statistics))
    assert text.count("Exchange hashpartitioning") == 1
    # One for the item lookup, one for the item statistics.
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    # The raw total is not read: it follows from quantity and price.
    assert not re.search(r"total_spent:string", text)


def test_items_are_never_forced_to_broadcast(stored):
    standardised, statistics = stored
    joined = imputation.with_item_statistics(standardised, statistics)
    assert "hint" not in joined._jdf.queryExecution().analyzed().toString().lower()


def test_large_vocabulary_adds_no_expression(spark, stored):
    items = Vocabulary(tuple(f"Item {i}" for i in range(10_000)), ("Cash",), ("Here",))
    raw = spark.createDataFrame([(f"item {i}", "cash", "here") for i in range(50)],
                                "item string, payment_method string, location string")
    found = cleaning.standardise_categoricals(raw, items)
    assert found.filter("item IS NULL").count() == 0 and found.count() == 50
    assert len(plan(found)) < 20_000


def test_windows_of_products_are_not_in_one_task(spark, small):
    for name in ("measure_mom_calendar", "view_driver_tree", "view_price_volume"):
        text = plan(registry.queries()[name](spark, small))
        assert not re.search(r"Window[^\n]*\n(?:[^\n]*Sort[^\n]*\n)?[^\n]*Exchange SinglePartition", text)


def test_slicers_prune_months(spark, small, folder):
    from tallybook.operators import measures
    from tallybook.sources import files
    files.write_table(registry.Tables(spark, small).engineered(), f"{folder}/sales", "parquet", ("year_month",))
    sales = measures.in_context(files.read_engineered(spark, f"{folder}/sales"), "1997-03-01", "1997-04-30")
    assert re.search(r"PartitionFilters: \[[^\]]*year_month", plan(sales))


def test_rollup_adds_up_before_its_shuffle(stored):
    standardised, statistics = stored
    sales = features.engineer(clean.clean_records(standardised, statistics), SAMPLE_COST_RATES)
    text = plan(aggregates.daily_rollup(sales))
    assert text.count("Exchange hashpartitioning") == 2 and "partial_sum" in text
    assert "Window" not in text and "Exchange SinglePartition" not in text


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_and_no_cross_join(spark, small, name):
    if name in ("incremental_load", "io_raw_csv_roundtrip", "io_clean_roundtrip",
                "io_engineered_roundtrip"):
        pytest.skip("runs its job while building")
    text = plan(registry.queries()[name](spark, small))
    for node in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_windows_never_see_sales_rows(spark, small):
    tables = registry.Tables(spark, small)
    for df in (tables.standardised(), tables.clean(), tables.costed()):
        assert "Window" not in plan(df)


def test_lines_travel_for_part_and_order_alone(spark, small):
    """Orders meet buyers below the join with the lines, not after it."""
    text = raw_sales(spark, small)._jdf.queryExecution().analyzed().toString()
    assert text.index("(l_orderkey") < text.index("(o_custkey")


def test_lines_travel_with_day_and_billed_amount_only_where_shown(spark, folder):
    tables = {
        "region": "SELECT 0 r_regionkey, 'ASIA' r_name",
        "nation": "SELECT 0 n_nationkey, 0 n_regionkey",
        "customer": "SELECT 1L c_custkey, 0 c_nationkey, 'BUILDING' c_mktsegment",
        "orders": "SELECT 1L o_orderkey, 1L o_custkey, '2-HIGH' o_orderpriority",
        "part": "SELECT 1L p_partkey, 'PROMO TIN' p_type, 3.0D p_retailprice",
        "lineitem": """SELECT 1L l_orderkey, 1L l_partkey, nullif(id, 40) l_suppkey, 1 l_linenumber, 2.0D l_quantity,
            7.0D l_extendedprice, timestamp'2023-01-05 13:00:00' l_shipdate FROM range(41)""",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")
    raw = raw_sales(spark, folder)
    text = raw._jdf.queryExecution().optimizedPlan().toString()
    lines = text[text.index("Join Inner, (l_orderkey"):]
    assert "as date) AS l_shipdate" in lines and "THEN l_extendedprice" in lines
    # The row key is 51 + 3 x supplier, and unknown without one.
    billed = {r.transaction_id for r in raw.filter("total_spent = '7.00'").collect()}
    assert billed == {f"TXN_1_1_1_{s}" for s in range(40) if (51 + 3 * s) % 17 == 0}
    assert raw.filter("transaction_id = 'TXN_1_1_1' AND total_spent = '6.00'").count() == 1
    assert raw.filter("trim(transaction_date) = '2023-01-05'").count() > 0


def test_duplicates_are_found_without_the_total(spark, small):
    """It follows from quantity and price, so it need not travel."""
    shuffles = re.findall(r"Exchange hashpartitioning\(.*", plan(registry.queries()["clean_dedup"](spark, small)))
    assert shuffles and not any("total_spent" in s for s in shuffles)


def test_passes_over_the_records_share_one_join_of_the_tables(spark, small):
    t = registry.Tables(spark, small)
    for rows in (t.clean(), t.clean_v1(), imputation.value_counts(t.records())):
        assert rows.inputFiles() and not any("lineitem" in f for f in rows.inputFiles())


def test_sales_of_a_group_are_gathered_in_few_tasks(spark):
    rows = [(f"T{k}", f"2023-01-0{1 + k % 2}", "Cake", "Cash", "Shop", k % 5) for k in range(400)]
    df = spark.createDataFrame(
        rows, "transaction_id string, transaction_date string, item string, payment_method string, location string, n int")
    found = aggregates.gathered(df.repartition(16), 2)
    assert sorted(found.collect()) == sorted(df.collect())
    spread = found.select("transaction_date", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(spread) <= 2 * 2


def test_staged_files_have_few_rows(spark, monkeypatch):
    monkeypatch.setattr(staging, "FILE_ROWS", 100)
    assert len(staging.stage_table(spark.range(1000, numPartitions=1), "few").inputFiles()) == 10
