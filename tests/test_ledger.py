"""Batches taken in one by one equal one load of everything."""

import datetime as dt
import glob
import random
import re

import pyarrow.parquet as pq
import pytest

import frames
from tallybook.operators import aggregates, cleaning, features
from tallybook.plans import clean
from tallybook.session import shared_folder
from tallybook.streaming import ledger as ledgers
from tallybook.streaming.ledger import Ledger


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def records(rng, n, months, prefix):
    """Changes to valid records: gaps of all kinds, copies, prices that move the statistics."""
    rows = []
    for k in range(n):
        day = dt.date(2023, rng.choice(months), rng.randint(1, 28)).isoformat()
        rows.append({
            "transaction_id": rng.choice([f"{prefix}{k}", f"T{rng.randint(0, 8)}", None]),
            "item": rng.choice(["Tea", "Cake", "Juice", "ERROR", None]),
            "quantity": rng.choice(["1", "2", "3", None]),
            "price_per_unit": rng.choice(["1.50", "2.00", "4.00", "UNKNOWN", None]),
            "payment_method": rng.choice(["Cash", "Credit Card", None]),
            "location": rng.choice(["In-Store", "Takeaway", None]), "transaction_date": day})
        if rng.random() < 0.3:
            rows.append(dict(rng.choice(rows)))
    return rows


def rollup_rows(df):
    return sorted(map(str, (r.asDict() for r in df.select(sorted(df.columns)).collect())))


@pytest.mark.parametrize("seed,price_median", [(1, "raw"), (2, "filled"), (3, "raw")])
def test_batches_equal_one_load(spark, folder, seed, price_median):
    rng = random.Random(seed)
    batches = [records(rng, 60, [1, 2], "a"), records(rng, 40, [2, 3, 4], "b"), records(rng, 8, [1, 5], "c")]
    batches[1] += rng.sample(batches[0], 15)
    batches[2] += rng.sample(batches[0] + batches[1], 20)
    ledger = Ledger(spark, folder, price_median, rates={"Tea": "0.50"})
    for k in range(len(batches)):
        ledger.apply(cleaning.standardised_records(frames.raw(spark, *batches[k])), k)
        whole = clean.clean_sales(frames.raw(spark, *sum(batches[:k + 1], [])), price_median=price_median)
        assert sorted(map(str, ledger.clean().collect())) == sorted(map(str, whole.collect()))
        fresh = aggregates.daily_rollup(features.engineer(whole, {"Tea": "0.50"}))
        assert rollup_rows(ledger.rollup()) == rollup_rows(fresh)


def full(month, n, price="2.00", item="Tea"):
    return [{"transaction_id": f"M{month}-{k}", "item": item, "price_per_unit": price, "quantity": "2",
             "transaction_date": f"2023-{month:02d}-{k % 28 + 1:02d}"} for k in range(n)]


def test_a_batch_reads_only_its_months(spark, folder, monkeypatch):
    ledger = Ledger(spark, folder)
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *full(1, 30), *full(2, 30))), 0)
    asked = []
    read = Ledger._read

    def watched(self, table, schema, batches, months=None):
        df = read(self, table, schema, batches, months)
        if batches == [0]:
            asked.append((table, months, plan(df)))
        return df

    monkeypatch.setattr(Ledger, "_read", watched)
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *full(2, 31), *full(3, 5))), 1)
    assert asked and all(sorted(months) == [202302, 202303] for _, months, _ in asked)
    # There were no gaps, so only complete records have folders by month.
    assert all(re.search(r"PartitionFilters: \[month#\d+ IN \(202302,202303\)", text)
               for table, _, text in asked if table == "complete")
    assert ledger.clean().count() == 30 + 31 + 5


def test_a_changed_statistic_touches_only_months_with_its_gaps(spark, folder):
    ledger = Ledger(spark, folder)
    gap = [{"transaction_id": "G", "item": "Tea", "price_per_unit": None, "transaction_date": "2023-02-03"},
           {"transaction_id": "H", "item": "Cake", "price_per_unit": None, "transaction_date": "2023-03-03"}]
    first = [*full(1, 5), *full(1, 5, "3.00", "Cake"), *gap]
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *first)), 0)
    more = full(4, 5, "8.00")  # moves the mean price of tea only
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *more)), 1)
    changes = spark.read.parquet(f"{folder}/changes/batch=1")
    assert {r.month for r in changes.select("month").distinct().collect()} == {202302, 202304}
    whole = clean.clean_sales(frames.raw(spark, *first, *more))
    assert rollup_rows(ledger.rollup()) == rollup_rows(aggregates.daily_rollup(features.engineer(whole)))
    assert ledger.rollup([202302]).count() == 1


def test_an_interrupted_batch_leaves_no_trace_and_can_be_repeated(spark, folder, monkeypatch):
    ledger = Ledger(spark, folder)
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *full(1, 4))), 0)
    before = ledger.clean().collect(), ledger.rollup().collect()
    batch = cleaning.standardised_records(frames.raw(spark, *full(1, 6)))
    with monkeypatch.context() as m:
        m.setattr(Ledger, "_changes", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ledger.apply(batch, 1)
    assert (ledger.clean().collect(), ledger.rollup().collect()) == before and ledger.batches() == [0]
    ledger.apply(batch, 1)
    ledger.apply(batch, 1)
    assert ledger.clean().count() == 6 and ledger.batches() == [0, 1]


def test_an_empty_batch_changes_nothing(spark, folder):
    ledger = Ledger(spark, folder)
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *full(1, 4))), 0)
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *full(1, 4)).limit(0)), 1)
    assert ledger.clean().count() == 4 and ledger.rollup().count() == 4


def stored_rows(*folders):
    """Records in the Parquet files of some folders, by file."""
    found = {}
    for file in (f for folder in folders for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)):
        opened = pq.ParquetFile(file)
        if "transaction_id" in opened.schema_arrow.names:
            found[file] = opened.metadata.num_rows
    return found


def test_records_are_written_once(spark, folder):
    before = stored_rows(shared_folder(spark))
    gaps = [{"transaction_id": f"G{k}", "item": "Tea", "price_per_unit": None, "transaction_date": "2023-01-09"}
            for k in range(5)]
    ledger = Ledger(spark, folder)
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *full(1, 20), *full(2, 20), *gaps)), 0)
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *full(2, 22, "2.00"), *full(3, 9, "4.00"))), 1)
    written = stored_rows(shared_folder(spark), folder)
    # 45 records, then 31 of which 20 are known.
    assert sum(n for file, n in written.items() if file not in before) == 45 + 31
    assert ledger.clean().count() == 45 + 11


def test_rows_of_a_batch_travel_once(spark, folder, monkeypatch):
    monkeypatch.setattr(ledgers, "SLOT_ROWS", 6)
    ledger = Ledger(spark, folder)
    batch = cleaning.standardised_records(frames.raw(spark, *full(1, 30)))
    ledger.apply(batch, 0)
    schema = ledger._schema(0)
    held = ledger._read("complete", ledger._stored(schema), [0])
    dates = batch.groupBy("transaction_date").count().withColumnRenamed("count", "n")
    days, slots = ledger._days(dates, held)
    text = plan(ledger._arrived(batch, days, slots, schema, held))
    # Copies and known records are found where the rows are.
    assert text.count("Exchange shufflepartitionid") == 1 and "Exchange hashpartitioning" not in text


def test_days_of_several_slots_and_tasks_of_several_days(spark, folder, monkeypatch):
    monkeypatch.setattr(ledgers, "SLOT_ROWS", 6)
    monkeypatch.setattr(ledgers, "MOST_ROWS", 12)
    heavy = [{"transaction_id": f"H{k}", "price_per_unit": None if k % 3 else "2.50", "transaction_date": "2023-02-03"}
             for k in range(50)]
    batches = [[*full(1, 12), *heavy, *heavy[:9]], [*full(2, 12), *heavy[5:30], *full(1, 15)]]
    ledger = Ledger(spark, folder)
    for k, rows in enumerate(batches):
        ledger.apply(cleaning.standardised_records(frames.raw(spark, *rows)), k)
    days, slots = ledger._days(spark.createDataFrame(
        [(dt.date(2023, 2, d), n) for d, n in ((1, 2), (2, 60), (3, 2))], "transaction_date date, n long"), None)
    placed = sorted(map(tuple, days.collect()))
    assert slots == 6 and [d[1:] for d in placed] == [(0, 1), (0, 6), (5, 1)]
    whole = clean.clean_sales(frames.raw(spark, *sum(batches, [])))
    assert sorted(map(str, ledger.clean().collect())) == sorted(map(str, whole.collect()))
    assert rollup_rows(ledger.rollup()) == rollup_rows(aggregates.daily_rollup(features.engineer(whole)))
    kinds = spark.read.parquet(f"{folder}/records/batch=1").groupBy("kind").agg({"copies": "sum"})
    # Of the first month 12 records are known and of the heavy day 25.
    assert dict(map(tuple, kinds.collect())) == {"complete": 12 + 3, "known": 12 + 25}


def test_records_that_filling_makes_equal_are_one_while_it_does(spark, folder):
    record = {"transaction_id": "A", "transaction_date": "2023-01-09", "price_per_unit": "9.00"}
    batches = [[{**record, "payment_method": None}, *full(1, 5)], [{**record, "payment_method": "Cash"}],
               [{**r, "payment_method": "Credit Card"} for r in full(4, 12)]]
    ledger, counts = Ledger(spark, folder), []
    for k in range(3):
        ledger.apply(cleaning.standardised_records(frames.raw(spark, *batches[k])), k)
        whole = clean.clean_sales(frames.raw(spark, *sum(batches[:k + 1], [])))
        assert sorted(map(str, ledger.clean().collect())) == sorted(map(str, whole.collect()))
        assert rollup_rows(ledger.rollup()) == rollup_rows(aggregates.daily_rollup(features.engineer(whole)))
        counts.append(ledger.clean().where("transaction_id = 'A'").count())
    assert counts == [1, 1, 2]


def test_the_clean_table_moves_only_records_that_may_be_equal(spark, folder):
    ledger = Ledger(spark, f"{folder}/apart")
    gaps = [{"transaction_id": f"G{k}", "payment_method": None, "transaction_date": "2023-01-09"} for k in range(5)]
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *full(1, 9), *gaps)), 0)
    assert "Exchange hashpartitioning" not in plan(ledger.clean()) and ledger.clean().count() == 14
    ledger = Ledger(spark, f"{folder}/shared")
    twin = {"transaction_id": "G3", "payment_method": "Cash", "transaction_date": "2023-01-09"}
    ledger.apply(cleaning.standardised_records(frames.raw(spark, *full(1, 9), *gaps, twin)), 0)
    assert spark.read.parquet(f"{folder}/shared/shared/batch=0").count() == 1 and ledger.clean().count() == 14
