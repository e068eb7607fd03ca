"""Run counts and checks gathered by the pass that writes the rows.

Each step's figures are aggregates observed while its rows go by, the same that the ``profile_*`` and
``validate_*`` queries take from passes of their own. Spark adds up the figures of tasks that end; if
executors are lost and a finished step runs again, its figures may count rows twice, so that a check may
report violations too many times, but never misses one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallybook.config import SHOP, Vocabulary
from tallybook.functions import text
from tallybook.operators import cleaning, imputation, profiling, validation
from tallybook.sources.vocabulary import item_table


class Figures:
    """Named sets of figures; each is there once the rows it watches have been written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, figures: dict[str, Column]) -> DataFrame:
        self._seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(self._seen[name], *[c.alias(k) for k, c in figures.items()])

    def row(self, name: str) -> DataFrame:
        """One row with the figures of a set."""
        found = self._seen[name].get
        return self.spark.range(1).select(*[F.lit(v).alias(k) for k, v in found.items()])

    def clean_checks(self) -> DataFrame:
        return validation.as_rows(self.row("clean_checks"))

    def counts(self) -> DataFrame:
        """All run counts of a cleaning as (step, figure, n)."""
        dates, kept = self.row("dates").first(), self.row("clean_rows").first()
        found = [("dates", k, dates[k]) for k in ("records", "dropped", "kept")]
        found += [("mismatches", "mismatched", self.row("mismatches").first().mismatched)]
        found += [("duplicates", "removed", dates.kept - kept.records), ("clean", "records", kept.records)]
        for step, rows in (("nulls", profiling.null_rows(self.row("nulls"))),
                           ("coercions", profiling.coercion_rows(self.row("coercions"))),
                           ("out_of_vocabulary", profiling.vocabulary_rows(self.row("out_of_vocabulary"))),
                           ("imputed", profiling.gap_rows(self.row("imputed")))):
            found += [(step, r.column_name, r[1]) for r in rows.collect()]
        found += [("checks", r.check_name, r.violations) for r in self.clean_checks().collect()]
        return self.spark.createDataFrame(found, "step string, figure string, n bigint")


def clean_records(raw: DataFrame, statistics: imputation.Statistics, figures: Figures,
                  vocabulary: Vocabulary = SHOP, tokens: tuple[str, ...] | None = None) -> DataFrame:
    """Clean records as :func:`tallybook.plans.clean.clean_sales` gives them, every step watched."""
    columns = raw.columns
    normalised = cleaning.normalise_tokens(raw, vocabulary)
    normalised = figures.watch(normalised, "nulls", profiling.null_figures(columns))
    normalised = figures.watch(normalised, "coercions", profiling.coercion_figures())
    dated = cleaning.parse_dates(cleaning.cast_numeric(normalised))
    typed = cleaning.drop_undated(figures.watch(dated, "dates", profiling.date_figures()))
    typed = figures.watch(typed, "mismatches", profiling.mismatch_figures())
    known = cleaning.with_known_item(typed, item_table(raw.sparkSession, vocabulary))
    known = figures.watch(known, "out_of_vocabulary", profiling.vocabulary_figures(vocabulary))
    few = {name: text.canonical(F.col(name), values, aliases)
           for name, values, aliases in vocabulary.columns() if name != "item"}
    standardised = known.withColumns({**few, "item": F.col("known_item")}).select(*columns)
    standardised = figures.watch(cleaning.reconcile_totals(standardised), "imputed", profiling.gap_figures())
    rows = (
        standardised.transform(imputation.fill_gaps, statistics)
        .transform(cleaning.remove_duplicates).transform(imputation.with_total).select(*columns)
    )
    rows = figures.watch(rows, "clean_rows", {"records": F.count(F.lit(1))})
    return figures.watch(rows, "clean_checks", validation.clean_figures(rows, vocabulary, tokens))
