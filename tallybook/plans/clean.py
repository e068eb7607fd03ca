"""Raw records to clean records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.config import SHOP, Vocabulary
from tallybook.operators import cleaning, imputation, validation
from tallybook.plans import observed
from tallybook.sources import files
from tallybook.sources.staging import stage_table


def fit_statistics(standardised: DataFrame, price_median: str = "raw") -> imputation.Statistics:
    """One scan of the records for all statistics."""
    counts = stage_table(imputation.value_counts(standardised), "value-counts")
    return imputation.fit(counts, price_median)


def clean_records(standardised: DataFrame, statistics: imputation.Statistics) -> DataFrame:
    """Gaps filled, duplicates removed, columns in the usual order."""
    columns = standardised.columns
    return (
        standardised.transform(imputation.fill_gaps, statistics)
        .transform(cleaning.remove_duplicates)
        .transform(imputation.with_total)
        .select(*columns)
    )


def clean_sales(raw: DataFrame, vocabulary: Vocabulary = SHOP,
                price_median: str = "raw") -> DataFrame:
    """All cleaning steps; ``price_median="filled"`` gives the older rule."""
    standardised = cleaning.standardised_records(raw, vocabulary)
    return clean_records(standardised, fit_statistics(standardised, price_median))


def run_cleaning(raw: DataFrame, output_path: str, vocabulary: Vocabulary = SHOP,
                 file_format: str = "parquet", price_median: str = "raw",
                 tokens: tuple[str, ...] | None = None,
                 figures: observed.Figures | None = None, versions: bool = False) -> DataFrame:
    """Clean, check and write; a failed check raises and leaves the output as it was.

    The records are read twice, for the statistics and for the rows; run counts and checks come from the
    second pass, which writes them. ``figures`` receives them. With ``versions`` the new rows replace the
    old ones in one step, see :func:`files.publish_table`.
    """
    figures = figures or observed.Figures(raw.sparkSession)
    statistics = fit_statistics(cleaning.standardised_records(raw, vocabulary), price_median)
    rows = observed.clean_records(raw, statistics, figures, vocabulary, tokens)
    return files.publish_table(rows, output_path, lambda: validation.require(figures.clean_checks()), file_format,
                               versions=versions)
