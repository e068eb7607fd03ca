"""Counts come from the writing pass, and a table changes in one step."""

import os

import pytest

import frames
from tallybook.operators import profiling, validation
from tallybook.plans import clean, engineered, observed
from tallybook.sources import files


def test_figures_of_the_run_equal_the_profiles(spark, folder):
    raw = frames.raw(spark, {}, {}, {"item": "Gadget"}, {"quantity": "x", "item": None}, {"transaction_date": "never"},
                     {"price_per_unit": " 9e15 ", "total_spent": "1"}, {"location": "ERROR", "payment_method": "moon"})
    figures = observed.Figures(spark)
    written = clean.run_cleaning(raw, f"{folder}/out", figures=figures)
    found = {(r.step, r.figure): r.n for r in figures.counts().collect()}
    from tallybook.operators import cleaning
    normalised = cleaning.normalise_tokens(raw)
    typed = cleaning.typed_records(raw)
    for step, rows in (("nulls", profiling.null_counts(normalised)), ("coercions", profiling.coercion_counts(normalised)),
                       ("out_of_vocabulary", profiling.out_of_vocabulary_counts(typed)),
                       ("imputed", profiling.imputation_counts(cleaning.standardised_records(raw)))):
        for r in rows.collect():
            assert found[step, r.column_name] == r[1], (step, r)
    assert found["mismatches", "mismatched"] == profiling.mismatch_counts(typed).first().mismatched
    assert (found["dates", "records"], found["dates", "dropped"], found["dates", "kept"]) == (7, 1, 6)
    assert found["clean", "records"] == written.count() and found["duplicates", "removed"] == 6 - written.count()
    assert {k[1] for k in found if k[0] == "checks"} == set(validation.clean_figures(written))


def test_the_rows_are_cleaned_and_written_in_one_pass(spark, folder):
    raw = frames.raw(spark, {}, {"transaction_id": "B"})
    raw.write.parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    statistics = clean.fit_statistics(clean.cleaning.standardised_records(raw))
    rows = observed.clean_records(raw, statistics, observed.Figures(spark))
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert text.count(f"{folder}/raw") == 1 and text.count("Exchange hashpartitioning") == 1
    assert text.count("CollectMetrics") == 8


@pytest.mark.parametrize("step", ["write_table", "point_to", "forget_versions"])
def test_a_crash_between_the_steps_leaves_a_whole_table(spark, folder, monkeypatch, step):
    path = f"{folder}/sales"
    old = frames.clean(spark, ("Tea", 1, 1, "2023-01-01"))
    new = frames.clean(spark, ("Tea", 1, 1, "2023-01-01"), ("Cake", 2, 1, "2023-02-01"))
    files.publish_table(old, path, versions=True)
    work = getattr(files, step)

    def crash(*args):
        if step == "write_table":
            work(*args)  # the rows are there, the pointer is not
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(files, step, crash)
        with pytest.raises(KeyboardInterrupt):
            files.publish_table(new, path, versions=True)
    seen = files.read_clean(spark, path).count()
    assert seen == (2 if step == "forget_versions" else 1)
    assert files.publish_table(new, path, versions=True).count() == 2
    assert files.read_clean(spark, path).count() == 2


def test_a_reader_that_has_begun_keeps_its_version(spark, folder):
    path = f"{folder}/sales"
    files.publish_table(frames.clean(spark, ("Tea", 1, 1, "2023-01-01")), path, versions=True)
    reader = files.read_clean(spark, path)
    files.publish_table(frames.clean(spark, *[("Tea", 1, 1, "2023-01-01")] * 3), path, versions=True)
    assert reader.count() == 1 and files.read_clean(spark, path).count() == 3
    for _ in range(3):
        files.publish_table(frames.clean(spark, ("Tea", 1, 1, "2023-01-01")), path, versions=True)
    assert len(os.listdir(f"{path}/{files.VERSIONS}")) == 2


def test_a_failed_check_shows_nothing_new(spark, folder):
    good = frames.raw(spark, {}, {"transaction_id": "T2", "item": "Tea"})
    assert clean.run_cleaning(good, f"{folder}/clean", versions=True).count() == 2
    with pytest.raises(validation.CheckFailed):
        clean.run_cleaning(frames.raw(spark, {"transaction_id": None}), f"{folder}/clean", versions=True)
    stored = files.read_clean(spark, f"{folder}/clean")
    assert stored.count() == 2 and len(os.listdir(f"{folder}/clean/{files.VERSIONS}")) == 1
    engineered.run_features(stored, f"{folder}/sales", versions=True)
    assert files.read_engineered(spark, f"{folder}/sales").count() == 2


def test_parquet_tables_are_written_with_zstd(spark, folder):
    files.write_table(spark.range(9), f"{folder}/plain")
    published = files.publish_table(spark.range(9), f"{folder}/published", versions=True)
    found = spark.read.parquet(f"{folder}/plain").inputFiles() + published.inputFiles()
    assert found and all(f.endswith(".zstd.parquet") for f in found) and published.count() == 9
