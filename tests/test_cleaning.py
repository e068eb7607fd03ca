import os
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import frames
from tallybook.config import CHECKED_TOKENS_V1, INVALID_TOKENS, READER_NULLS, SHOP, SHOP_V1
from tallybook.functions import text
from tallybook.operators import cleaning, imputation, profiling, validation
from tallybook.plans import clean
from tallybook.sources import files


def column(df, name):
    return [row[name] for row in df.orderBy("transaction_id").collect()]


def numbered(spark, name, values):
    return frames.raw(spark, *[{"transaction_id": f"T{i:02}", name: v} for i, v in enumerate(values)])


def test_every_token_becomes_null(spark):
    tokens = [*READER_NULLS, *INVALID_TOKENS]
    got = cleaning.normalise_tokens(numbered(spark, "item", tokens))
    assert set(column(got, "item")) == {None}


def test_tokens_are_exact_and_blanks_trimmed(spark):
    values = [" ERROR ", "error", "  ", "\tTea\n", " Tea　", "N/A "]
    got = cleaning.normalise_tokens(numbered(spark, "item", values))
    assert column(got, "item") == ["ERROR", "error", None, "Tea", "Tea", "N/A"]


def test_trim_first_tests_tokens_after_trimming(spark):
    got = cleaning.normalise_tokens(numbered(spark, "item", [" ERROR ", "Tea"]), trim_first=True)
    assert column(got, "item") == [None, "Tea"]


def test_numbers_and_coercion_counts(spark):
    raw = numbered(spark, "quantity", ["2", "abc", None, " 7 ", "1e1"])
    normalised = cleaning.normalise_tokens(raw)
    assert column(cleaning.cast_numeric(normalised), "quantity") == [2, None, None, 7, 10]
    assert frames.by(profiling.coercion_counts(normalised), "column_name", "coerced") == {
        "quantity": 1, "price_per_unit": 0, "total_spent": 0}


def test_huge_numbers_do_not_fail_the_job(spark):
    raw = frames.raw(spark, {"quantity": "9999999999", "price_per_unit": "999999999999",
                             "total_spent": "1e30"})
    got = cleaning.standardised_records(raw).first()
    assert got.total_spent is None


@pytest.mark.parametrize("value", ["2023-02-30", "2023", "2023-01", "05/01/2023", "2023-01-05T10",
                                   "2023-01-1T", "ERROR", "", None, "20230105", "+023-01-01"])
def test_bad_dates_are_dropped(spark, value):
    raw = frames.raw(spark, {"transaction_date": value}, {"transaction_date": " 2023-01-05 "})
    assert cleaning.typed_records(raw).count() == 1
    counted = profiling.date_counts(cleaning.parse_dates(cleaning.normalise_tokens(raw))).first()
    assert (counted.records, counted.dropped, counted.kept) == (2, 1, 1)


def test_other_date_format(spark):
    got = cleaning.parse_dates(frames.raw(spark, {"transaction_date": "05/01/2023"}), "dd/MM/yyyy")
    assert str(got.first().transaction_date) == "2023-01-05"


def test_location_spellings(spark):
    values = ["in-store", "IN STORE", "Instore", "INSTORE", "take away", "Take-Away", " delivery ",
              "Drive-in", None]
    got = cleaning.standardise_categoricals(numbered(spark, "location", values))
    assert column(got, "location") == ["In-Store"] * 4 + ["Takeaway"] * 2 + ["Delivery", None, None]
    counts = profiling.out_of_vocabulary_counts(numbered(spark, "location", values))
    assert frames.by(counts, "column_name", "unrecognised")["location"] == 1


def test_older_vocabulary_is_narrower(spark):
    raw = numbered(spark, "location", ["Delivery", "take away", "instore"])
    got = cleaning.standardise_categoricals(raw, SHOP_V1)
    assert column(got, "location") == [None, None, "In-Store"]


def test_totals_follow_quantity_and_price(spark):
    raw = frames.raw(spark, {"total_spent": "9.99"}, {"total_spent": None}, {"total_spent": "6.01"},
                     {"quantity": None, "total_spent": "5.00"})
    typed = cleaning.typed_records(raw)
    assert profiling.mismatch_counts(typed).first().mismatched == 2
    totals = sorted(r.total_spent for r in cleaning.reconcile_totals(typed).collect())
    assert totals == [Decimal("5.00")] + [Decimal("6.00")] * 3


def test_mismatch_can_use_the_unrounded_product(spark):
    raw = frames.raw(spark, {"quantity": "1", "price_per_unit": "1.004", "total_spent": "1.01"})
    typed = cleaning.typed_records(raw)
    assert profiling.mismatch_counts(typed, round_first=True).first().mismatched == 0
    typed = cleaning.typed_records(
        frames.raw(spark, {"quantity": "1", "price_per_unit": "1.006", "total_spent": "1.02"}))
    assert profiling.mismatch_counts(typed, round_first=True).first().mismatched == 0
    assert profiling.mismatch_counts(typed, round_first=False).first().mismatched == 1


def test_fused_and_stepwise_cleaning_agree(spark, small):
    from tallybook.sources.sample_tables import SAMPLE, raw_sales
    raw = raw_sales(spark, small)
    stepwise = (cleaning.typed_records(raw, SAMPLE)
                .transform(cleaning.standardise_categoricals, SAMPLE)
                .transform(cleaning.reconcile_totals))
    fused = cleaning.standardised_records(raw, SAMPLE)
    assert fused.exceptAll(stepwise).isEmpty() and stepwise.exceptAll(fused).isEmpty()


def fit(raw, vocabulary=SHOP, price_median="raw"):
    standardised = cleaning.standardised_records(raw, vocabulary)
    return standardised, clean.fit_statistics(standardised, price_median)


def test_quantity_mode_takes_the_smallest_on_a_tie(spark):
    raw = numbered(spark, "quantity", ["3", "1", "1", "3", None])
    standardised, statistics = fit(raw)
    filled = imputation.fill_gaps(standardised, statistics)
    assert column(filled, "quantity") == [3, 1, 1, 3, 1]


def test_unknown_item_takes_the_median_after_filling(spark):
    # Filling Tea first makes the quantities 1, 9, 9, 9, so the median is 9.
    raw = frames.raw(spark, {"transaction_id": "A", "item": "Coffee", "quantity": "1"},
                     {"transaction_id": "B", "item": "Tea", "quantity": "9"},
                     {"transaction_id": "C", "item": "Tea", "quantity": None},
                     {"transaction_id": "D", "item": "Tea", "quantity": None},
                     {"transaction_id": "E", "item": "nothing", "quantity": None})
    standardised, statistics = fit(raw)
    assert column(imputation.fill_gaps(standardised, statistics), "quantity")[-1] == 9


def test_price_median_before_or_after_filling(spark):
    rows = [{"item": "Coffee", "price_per_unit": "1"}, {"item": "Coffee", "price_per_unit": "2"},
            {"item": "Tea", "price_per_unit": "8"}, {"item": "Tea", "price_per_unit": None},
            {"item": "Tea", "price_per_unit": None}, {"item": None, "price_per_unit": None}]
    raw = frames.raw(spark, *[{"transaction_id": f"T{i}", **r} for i, r in enumerate(rows)])
    for basis, expected in (("raw", 2), ("filled", 8)):
        standardised, statistics = fit(raw, price_median=basis)
        assert column(imputation.fill_gaps(standardised, statistics), "price_per_unit")[-1] == expected
    with pytest.raises(ValueError):
        fit(raw, price_median="other")


def test_price_mean_per_item_and_category_mode(spark):
    raw = frames.raw(
        spark,
        {"transaction_id": "A", "price_per_unit": "1", "payment_method": "Debit Card"},
        {"transaction_id": "B", "price_per_unit": "2", "payment_method": "Cash"},
        {"transaction_id": "C", "price_per_unit": None, "payment_method": "UNKNOWN"})
    standardised, statistics = fit(raw)
    filled = imputation.with_total(imputation.fill_gaps(standardised, statistics))
    last = filled.orderBy("transaction_id").collect()[-1]
    assert (last.price_per_unit, last.payment_method, last.total_spent) == (
        Decimal("1.5"), "Cash", Decimal("3.00"))


def test_all_gaps_leave_nulls_and_fail_validation(spark):
    raw = frames.raw(spark, {"item": None, "quantity": None, "price_per_unit": None})
    report = validation.validate_clean(clean.clean_sales(raw))
    assert frames.by(report, "check_name", "passed")["no_nulls"] is False
    with pytest.raises(validation.CheckFailed):
        validation.require(report)


def test_empty_input(spark):
    got = clean.clean_sales(frames.raw(spark, {}).limit(0))
    assert got.count() == 0
    assert got.dtypes == [("transaction_id", "string"), ("item", "string"),
                          ("quantity", "decimal(18,2)"), ("price_per_unit", "decimal(18,6)"),
                          ("total_spent", "decimal(18,2)"), ("payment_method", "string"),
                          ("location", "string"), ("transaction_date", "date")]


def test_duplicates_that_arise_by_filling_are_removed(spark):
    raw = frames.raw(spark, {}, {}, {"quantity": None})
    assert clean.clean_sales(raw).count() == 1
    standardised, statistics = fit(raw)
    counted = profiling.duplicate_counts(imputation.fill_gaps(standardised, statistics)).first()
    assert (counted.records, counted.distinct_records, counted.removed) == (3, 1, 2)


def test_clean_is_idempotent(spark):
    raw = frames.raw(spark, {}, {"transaction_id": "T2", "quantity": None, "location": "instore"})
    once = clean.clean_sales(raw)
    again = clean.clean_sales(once.select(*[F.col(c).cast("string") for c in once.columns]))
    assert sorted(once.collect()) == sorted(again.collect())


def test_validation_reports_each_violation(spark):
    df = frames.clean(spark, ("Coffee", 2, 3, "2023-01-05"), ("Beer", 1, 1, "2023-01-05"))
    df = df.withColumn("transaction_id", F.when(F.col("item") == "Beer", "NaN").otherwise("x"))
    df = df.withColumn("total_spent", (F.col("total_spent") + 1).cast("decimal(18,2)"))
    report = frames.by(validation.validate_clean(df), "check_name", "violations")
    assert report == {"no_nulls": 0, "no_invalid_tokens": 1, "numeric_types": 0, "date_type": 0,
                      "total_is_quantity_times_price": 2, "categories_in_vocabulary": 1}
    old = validation.validate_clean(df, SHOP_V1, CHECKED_TOKENS_V1)
    assert frames.by(old, "check_name", "violations")["no_invalid_tokens"] == 0
    text = validation.validate_clean(df.withColumn("quantity", F.lit("1")).withColumn(
        "transaction_date", F.lit("2023-01-01")))
    found = frames.by(text, "check_name", "violations")
    assert (found["numeric_types"], found["date_type"]) == (1, 1)


def test_run_cleaning_writes_only_what_passes(spark, folder):
    good = frames.raw(spark, {}, {"transaction_id": "T2", "item": "Tea"})
    written = clean.run_cleaning(good, f"{folder}/deep/clean")
    assert written.count() == 2
    bad = frames.raw(spark, {"transaction_id": None})
    with pytest.raises(validation.CheckFailed):
        clean.run_cleaning(bad, f"{folder}/deep/clean")
    assert spark.read.parquet(f"{folder}/deep/clean").count() == 2
    assert os.listdir(f"{folder}/deep") == ["clean"]


def test_csv_is_read_by_column_name(spark, folder):
    path = f"{folder}/raw.csv"
    with open(path, "w") as f:
        f.write('Item,Transaction ID,Quantity,Price Per Unit,Total Spent,Payment Method,Location,'
                'Transaction Date,Order Type\n'
                '"Tea, ""green""",TXN_1,2,1.5,3,Cash,In-Store,2023-01-05,Dine\n')
    row = files.read_raw_csv(spark, path).first()
    assert (row.transaction_id, row.item, row.order_type) == ("TXN_1", 'Tea, "green"', "Dine")
    with open(path, "w") as f:
        f.write("Item,Quantity\nTea,1\n")
    with pytest.raises(ValueError, match="lacks columns"):
        files.read_raw_csv(spark, path)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_raw_csv(spark, f"{folder}/absent.csv")


def test_typed_csv_round_trip(spark, folder):
    df = frames.clean(spark, ("Tea", 2, "1.5", "2023-01-05"))
    files.write_table(df, f"{folder}/clean", "csv")
    assert files.read_clean(spark, f"{folder}/clean", "csv").collect() == df.collect()


PADS = (" ", "\t", " ", "　")


def test_padding_in_every_column_changes_nothing(spark):
    names = ("item", "quantity", "price_per_unit", "total_spent", "payment_method", "location",
             "transaction_date")
    plain = dict(zip(frames.schemas.RAW_COLUMNS, frames.RAW))
    rows = [{**{n: f"{a}{plain[n]}{b}" for n in names}, "transaction_id": f"P{i}"}
            for i, (a, b) in enumerate((a, b) for a in PADS for b in PADS)]
    raw = frames.raw(spark, {"transaction_id": "P"}, *rows)
    fused = cleaning.standardised_records(raw)
    assert fused.drop("transaction_id").distinct().count() == 1 and fused.count() == 17
    stepwise = cleaning.reconcile_totals(cleaning.standardise_categoricals(cleaning.typed_records(raw)))
    assert sorted(fused.collect()) == sorted(stepwise.select(*fused.columns).collect())


def test_a_vocabulary_may_hold_a_token(spark):
    from tallybook.config import Vocabulary
    words = Vocabulary(("NA", "Tea"), ("Cash",), ("In-Store",))
    raw = numbered(spark, "item", ["NA", " NA ", "tea"])
    assert column(cleaning.standardised_records(raw, words), "item") == [None, "NA", "Tea"]


def test_large_numbers_are_kept_or_counted(spark):
    raw = numbered(spark, "quantity", ["99999999999", "1" + "0" * 20, "x"])
    assert column(cleaning.standardised_records(raw), "quantity") == [99999999999, None, None]
    counts = {r.column_name: (r.coerced, r.out_of_range)
              for r in profiling.coercion_counts(cleaning.normalise_tokens(raw)).collect()}
    assert counts["quantity"] == (2, 1)


def test_csv_files_may_order_their_columns_differently(spark, folder):
    import os
    os.makedirs(f"{folder}/csv")
    head = "Transaction ID,Item,Quantity,Price Per Unit,Total Spent,Payment Method,Location,Transaction Date"
    with open(f"{folder}/csv/a.csv", "w") as out:
        out.write(head + "\nA,Cake,1,2,2,Cash,\"In\nStore\",2023-01-05\n")
    turned = ",".join(reversed(head.split(",")))
    with open(f"{folder}/csv/b.csv", "w") as out:
        out.write(turned + ",Note\n2023-01-06,Takeaway,Cash,2,2,1,Tea,B,hello\n2023-01-07,x\n")
    raw = files.read_raw_csv(spark, f"{folder}/csv/*.csv", malformed="broken")
    rows = {r.transaction_id: r for r in raw.collect()}
    assert (rows["A"].item, rows["A"].location, rows["A"].note) == ("Cake", "In\nStore", None)
    assert (rows["B"].item, rows["B"].transaction_date, rows["B"].note) == ("Tea", "2023-01-06", "hello")
    assert files.malformed_records(raw, "broken").first() == (3, 1)


def test_text_is_trimmed_once_a_column(spark):
    df = spark.createDataFrame([(" a ",), ("ERROR",), (" ERROR ",), ("\u00a0",), ("",), (None,)], "t string")
    found = df.select(text.known_text(F.col("t"), ("ERROR", "")).alias("t"))
    assert [r.t for r in found.collect()] == ["a", None, "ERROR", None, None, None]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("trim(") == 1
