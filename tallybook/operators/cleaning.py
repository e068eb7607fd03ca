"""Row-local cleaning: tokens, types, dates, categories, totals, duplicates.

Nothing here shuffles except :func:`remove_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.config import READER_NULLS, SHOP, TOTAL_TOLERANCE, Vocabulary
from tallybook.functions import text
from tallybook.schemas import MONEY, NUMERIC_COLUMNS
from tallybook.sources.vocabulary import item_table


def normalise_tokens(df: DataFrame, vocabulary: Vocabulary = SHOP,
                     reader_nulls: Iterable[str] = READER_NULLS,
                     trim_first: bool = False,
                     columns: Iterable[str] | None = None) -> DataFrame:
    """Missing-value tokens and blanks become null in every text column.

    Tokens must match exactly and are tested before trimming, so a padded
    token stays text (later steps reject it in every column but the id).
    ``trim_first`` tests them after trimming instead. ``columns`` limits the
    step to some columns.
    """
    tokens = tuple(dict.fromkeys((*reader_nulls, *vocabulary.invalid_tokens)))
    chosen = set(df.columns if columns is None else columns)

    def cleaned(name: str) -> Column:
        col = F.col(name)
        return text.known_text(text.trimmed(col) if trim_first else col, tokens)

    return df.select(*[
        cleaned(name).alias(name) if dtype == "string" and name in chosen else F.col(name)
        for name, dtype in df.dtypes
    ])


def cast_numeric(df: DataFrame) -> DataFrame:
    """Quantity, price and total as decimals; text that is no number is null."""
    return df.withColumns({
        name: text.number(F.col(name), dtype) for name, dtype in NUMERIC_COLUMNS.items()
    })


def parse_dates(df: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Transaction date as DATE; what does not parse is null."""
    col = F.col("transaction_date")
    if date_format == "yyyy-MM-dd":
        parsed = text.iso_date(col)
    else:
        parsed = F.try_to_timestamp(text.trimmed(col), F.lit(date_format)).cast("date")
    return df.withColumn("transaction_date", parsed)


def drop_undated(df: DataFrame) -> DataFrame:
    return df.filter(F.col("transaction_date").isNotNull())


def with_known_item(df: DataFrame, items: DataFrame, name: str = "known_item") -> DataFrame:
    """Adds the vocabulary's spelling of the item, null when it is not in it.

    Items are looked up by a join with a table (spelling, known), so the cost of
    a row does not grow with their number; Spark broadcasts a table of a size
    below its threshold and splits frequent items otherwise.
    """
    columns = df.columns
    keyed = df.withColumn("spelling", text.lookup_key(F.col("item")))
    return keyed.join(items, "spelling", "left").select(*columns, F.col("known").alias(name))


def standardise_categoricals(df: DataFrame, vocabulary: Vocabulary = SHOP,
                             items: DataFrame | None = None) -> DataFrame:
    """Item, payment method and location in their vocabulary spelling or null.

    ``items`` is an item table (spelling in lower case, known) to use instead
    of the vocabulary's items.
    """
    columns = df.columns
    if items is None:
        items = item_table(df.sparkSession, vocabulary)
    few = {
        name: text.canonical(F.col(name), values, aliases)
        for name, values, aliases in vocabulary.columns() if name != "item"
    }
    found = with_known_item(df, items).withColumns({**few, "item": F.col("known_item")})
    return found.select(*columns)


def line_total(quantity: str = "quantity", price: str = "price_per_unit") -> Column:
    return F.round(F.col(quantity) * F.col(price), 2).try_cast(MONEY)


def total_mismatch(round_first: bool = True) -> Column:
    """True where both factors are known and the total is missing or off.

    ``round_first=False`` compares with the unrounded product, as the older
    rules do.
    """
    product = F.col("quantity") * F.col("price_per_unit")
    expected = F.round(product, 2) if round_first else product
    off = F.abs(F.col("total_spent") - expected) > F.lit(TOTAL_TOLERANCE).cast("decimal(4,2)")
    return product.isNotNull() & (F.col("total_spent").isNull() | off)


def reconcile_totals(df: DataFrame) -> DataFrame:
    """Total = quantity x price wherever both are known, else as it was."""
    return df.withColumn("total_spent", F.coalesce(line_total(), F.col("total_spent")))


def typed_records(raw: DataFrame, vocabulary: Vocabulary = SHOP) -> DataFrame:
    """Tokens, numbers and dates done; undated records dropped."""
    return (
        raw.transform(normalise_tokens, vocabulary)
        .transform(cast_numeric)
        .transform(parse_dates)
        .transform(drop_undated)
    )


def standardised_records(raw: DataFrame, vocabulary: Vocabulary = SHOP) -> DataFrame:
    """All row-local steps in order: one narrow stage over the source.

    Tokens are looked for only where they make a difference: in the columns
    that stay text, and in a category whose vocabulary has a token's spelling.
    In the others they end as null anyway, since no token is a number, a date
    or a valid category. That keeps the generated code small enough for the JVM
    to compile.
    """
    tokens = {t.lower() for t in (*READER_NULLS, *vocabulary.invalid_tokens)}
    plain = {name for name, values, aliases in vocabulary.columns()
             if tokens.isdisjoint(text.spellings(values, aliases))}
    free_text = [c for c in raw.columns
                 if c not in (*NUMERIC_COLUMNS, *plain, "transaction_date")]
    return (
        raw.transform(normalise_tokens, vocabulary, columns=free_text)
        .transform(cast_numeric)
        .transform(parse_dates)
        .transform(drop_undated)
        .transform(standardise_categoricals, vocabulary)
        .transform(reconcile_totals)
    )


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of identical rows.

    Planned as an aggregate over all columns: copies collapse within each task
    before the shuffle, so a heavily repeated row does not load one task.
    """
    return df.dropDuplicates()
