"""Run counts of the cleaning steps, each from one pass over its input.

The ``*_figures`` are the aggregates themselves, for a pass that does other work too.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallybook.config import SHOP, Vocabulary
from tallybook.functions import text
from tallybook.operators import cleaning
from tallybook.schemas import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS
from tallybook.sources.vocabulary import item_table


Figures = dict[str, Column]


def as_rows(counted: DataFrame, names: Iterable[str], *columns: str) -> DataFrame:
    """One row (column_name, ...) per name from a one-row table.

    The first of ``columns`` comes from the column called like the name, others
    from ``<name>_<column>``.
    """
    def entry(name: str) -> Column:
        values = [F.col(name if k == 0 else f"{name}_{c}").alias(c) for k, c in enumerate(columns)]
        return F.struct(F.lit(name).alias("column_name"), *values)

    rows = F.explode(F.array(*[entry(n) for n in names]))
    return counted.select(rows.alias("row")).select("row.*")


def counted(df: DataFrame, figures: Figures) -> DataFrame:
    """All figures in one row, from a single scan."""
    return df.agg(*[c.alias(k) for k, c in figures.items()])


def null_figures(names: Iterable[str]) -> Figures:
    return {c: F.count_if(F.col(c).isNull()) for c in names}


def null_rows(found: DataFrame) -> DataFrame:
    names = found.columns
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    return as_rows(found.withColumn("(total)", total), [*names, "(total)"], "nulls")


def null_counts(normalised: DataFrame) -> DataFrame:
    """Nulls per column, and over all columns as ``(total)``."""
    return null_rows(counted(normalised, null_figures(normalised.columns)))


def coercion_figures() -> Figures:
    def lost(name: str) -> Column:
        return F.col(name).isNotNull() & text.number(F.col(name), NUMERIC_COLUMNS[name]).isNull()

    def finite(name: str) -> Column:
        value = text.number(F.col(name), T.DoubleType())
        return value.isNotNull() & (F.abs(value) < float("inf"))

    return {c: F.count_if(lost(c)) for c in NUMERIC_COLUMNS} | {
        f"{c}_out_of_range": F.count_if(lost(c) & finite(c)) for c in NUMERIC_COLUMNS}


def coercion_rows(found: DataFrame) -> DataFrame:
    return as_rows(found, NUMERIC_COLUMNS, "coerced", "out_of_range")


def coercion_counts(normalised: DataFrame) -> DataFrame:
    """Per numeric column: values present that are no number, and numbers too large for it.

    Both end as gaps; ``out_of_range`` tells real numbers from text.
    """
    return coercion_rows(counted(normalised, coercion_figures()))


def date_figures() -> Figures:
    return {
        "records": F.count(F.lit(1)),
        "dropped": F.count_if(F.col("transaction_date").isNull()),
        "kept": F.count("transaction_date"),
    }


def date_counts(dated: DataFrame) -> DataFrame:
    """Records before, dropped for want of a date, and kept."""
    return counted(dated, date_figures())


def vocabulary_figures(vocabulary: Vocabulary) -> Figures:
    """Of records with ``known_item`` beside the item."""
    return {
        name: F.count_if(F.col(name).isNotNull() & (
            F.col("known_item") if name == "item" else text.canonical(F.col(name), values, aliases)
        ).isNull())
        for name, values, aliases in vocabulary.columns()
    }


def vocabulary_rows(found: DataFrame) -> DataFrame:
    return as_rows(found, CATEGORICAL_COLUMNS, "unrecognised")


def out_of_vocabulary_counts(typed: DataFrame, vocabulary: Vocabulary = SHOP) -> DataFrame:
    """Per categorical column: values present that the vocabulary lacks."""
    known = cleaning.with_known_item(typed, item_table(typed.sparkSession, vocabulary))
    return vocabulary_rows(counted(known, vocabulary_figures(vocabulary)))


def mismatch_figures(round_first: bool = True) -> Figures:
    return {"mismatched": F.count_if(cleaning.total_mismatch(round_first)), "records": F.count(F.lit(1))}


def mismatch_counts(typed: DataFrame, round_first: bool = True) -> DataFrame:
    """Records whose total disagrees with quantity x price."""
    return counted(typed, mismatch_figures(round_first))


def gap_figures() -> Figures:
    names = ("quantity", "price_per_unit", *CATEGORICAL_COLUMNS)
    return {c: F.count_if(F.col(c).isNull()) for c in names}


def gap_rows(found: DataFrame) -> DataFrame:
    return as_rows(found, gap_figures(), "imputed")


def imputation_counts(standardised: DataFrame) -> DataFrame:
    """Per filled column: records with a gap."""
    return gap_rows(counted(standardised, gap_figures()))


def duplicate_counts(filled: DataFrame) -> DataFrame:
    """Records before and after duplicate removal."""
    return (
        filled.groupBy(*filled.columns).agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("records"),
             F.count(F.lit(1)).alias("distinct_records"))
        .withColumn("removed", F.col("records") - F.col("distinct_records"))
    )
