import datetime as dt
import os
from decimal import Decimal

import pytest

import frames
from tallybook import schemas
from tallybook.operators import features, validation
from tallybook.plans import engineered
from tallybook.sources import files


def test_money_columns(spark):
    row = frames.sales(spark, ("Tea", 3, "1.115", "2023-01-01")).first()
    # 3.345 rounds half up.
    assert (row.revenue, row.cost, row.profit) == (Decimal("3.35"), Decimal("2.01"), Decimal("1.34"))
    assert row.profit_margin_pct == 40.0


def test_zero_revenue_has_no_margin(spark):
    assert frames.sales(spark, ("Tea", 0, 5, "2023-01-01")).first().profit_margin_pct is None


def test_calendar_columns(spark):
    row = frames.sales(spark, ("Tea", 1, 1, "2023-01-01")).first()
    got = {f.name: row[f.name] for f in schemas.TIME.fields}
    assert got == {
        "day": 1, "day_of_week": "Sunday", "is_weekend": 1, "week": 52, "month_num": 1,
        "month": "January", "month_short": "Jan", "month_start": dt.date(2023, 1, 1),
        "quarter": "2023Q1", "quarter_label": "Q1", "year": 2023, "year_month": "2023-01"}
    assert frames.sales(spark, ("Tea", 1, 1, "2023-01-06")).first().is_weekend == 0


def test_cost_rates_by_mapping_and_by_table(spark):
    rates = {"Tea": "0.25"}
    rows = (("Tea", 1, 100, "2023-01-01"), ("Cake", 1, 100, "2023-01-01"))
    table = spark.createDataFrame([("Tea", "0.25")], "item string, cogs_rate string")
    for source in (rates, table):
        got = frames.by(frames.sales(spark, *rows, rates=source), "item", "cost")
        assert got == {"Tea": Decimal("25.00"), "Cake": Decimal("60.00")}


def test_schema(spark):
    got = frames.sales(spark, ("Tea", 1, 1, "2023-01-01")).schema
    assert [(f.name, f.dataType) for f in got] == [
        (f.name, f.dataType) for f in schemas.ENGINEERED]


def test_validation(spark):
    df = frames.sales(spark, ("Tea", 1, 10, "2023-01-01"))
    assert all(r.passed for r in validation.validate_features(df).collect())
    wrong = df.withColumn("cost", df.cost + 1).drop("month")
    found = frames.by(validation.validate_features(wrong), "check_name", "violations")
    assert found == {"features_present": 1, "features_filled": 0, "revenue_identity": 0,
                     "cost_identity": 1, "profit_identity": 1}


def test_margin_check(spark):
    df = frames.sales(spark, ("Tea", 1, 10, "2023-01-01"))
    assert validation.validate_margin(df).first().deviates is False
    dear = frames.sales(spark, ("Tea", 1, 10, "2023-01-01"), rates={"Tea": "0.61"})
    assert validation.validate_margin(dear).first().deviates is True


def test_preview_and_types(spark):
    df = frames.sales(spark, *[("Tea", 1, 1, "2023-01-01")] * 7)
    assert [r.transaction_id for r in features.preview(df).collect()] == ["T0", "T1", "T2", "T3", "T4"]
    assert frames.by(features.column_types(df), "column_name", "data_type")["month_start"] == "date"


def test_run_features_round_trip(spark, folder):
    clean = frames.clean(spark, ("Tea", 1, 1, "2023-01-01"), ("Tea", 2, 1, "2023-02-01"))
    engineered.run_features(clean, f"{folder}/out")
    back = files.read_engineered(spark, f"{folder}/out")
    assert back.count() == 2
    month = back.filter("year_month = '2023-02'")
    assert "PartitionFilters: [isnotnull(year_month" in plan(month)
    as_csv = engineered.run_features(clean, f"{folder}/csv", "csv", rates={"Tea": "0.5"})
    assert sorted(r.cost for r in as_csv.collect()) == [Decimal("0.50"), Decimal("1.00")]
    with pytest.raises(validation.CheckFailed):
        engineered.run_features(frames.clean(spark, ("Tea", 0, 1, "2023-01-01")), f"{folder}/bad")
    # Nothing half-done stays, and a deviating margin warns.
    assert sorted(os.listdir(folder)) == ["csv", "out"]
    with pytest.warns(UserWarning, match="margin 0.00, expected 40.00"):
        engineered.run_features(frames.clean(spark, ("Tea", 1, "0.01", "2023-01-01")), f"{folder}/out")
    assert files.read_engineered(spark, f"{folder}/out").count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_travel_to_their_month_before_columns_are_derived(spark, folder, monkeypatch):
    written = []
    monkeypatch.setattr(files, "write_table", lambda df, *rest, write=files.write_table: written.append(df) or write(df, *rest))
    clean = frames.clean(spark, ("Tea", 1, 1, "2023-01-01"), ("Tea", 2, 1, "2023-02-01"), ("Tea", 2, 1, "2023-02-01"))
    engineered.run_features(clean, f"{folder}/out")
    text = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("RebalancePartitions") == 1
    travels = text.split("RebalancePartitions")[1]
    assert "year_month" in travels and "revenue" not in travels and "quarter_label" not in travels
    back = files.read_engineered(spark, f"{folder}/out")
    assert sorted(back.collect()) == sorted(features.engineer(clean).select(*back.columns).collect())


def test_rows_that_are_together_are_not_dealt_again(spark, folder):
    rows = features.engineer(features.gathered_by_month(frames.clean(spark, ("Tea", 1, 1, "2023-01-01"))))
    files.write_table(rows, f"{folder}/sales", "parquet", ("year_month",), rebalance=False)
    files.write_table(rows.drop("quarter"), f"{folder}/again", "parquet", ("year_month",))
    assert [os.listdir(f"{folder}/{f}").count("year_month=2023-01") for f in ("sales", "again")] == [1, 1]
