"""Text clean-up: blanks, missing-value tokens, dates and vocabulary lookup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

# Code points a text trim drops, not only the space (fixed values).
WHITESPACE = "".join(map(chr, (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009,
    0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))


# Each function below names its input as few times as it can: Catalyst puts the expression that computes
# the input in each of those places, above all in filters.


def trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def known_text(col: Column, tokens: Iterable[str]) -> Column:
    """The trimmed text; null where it is blank or, untrimmed, one of ``tokens``."""
    return F.nullif(F.when(~col.isin(*tokens), trimmed(col)), F.lit(""))


def _inner(col: Column, shape: str) -> Column:
    """The text without white space around it where that has the given shape, else empty text."""
    return F.regexp_extract(col, rf"\A[{WHITESPACE}]*({shape})[{WHITESPACE}]*\z", 1)


def number(col: Column, dtype: DataType) -> Column:
    """The text as a number, null when it is none.

    What cannot be a number is kept from the cast, which would raise and catch an exception for it.
    """
    return F.nullif(_inner(col, "[-+.0-9][-+.0-9eE]*"), F.lit("")).try_cast(dtype)


def iso_date(col: Column) -> Column:
    """DATE of text in the exact form yyyy-mm-dd, else null.

    A plain cast would also take a bare year or a date with a time behind it.
    White space around the date does not count.
    """
    return _inner(col, "[0-9]{4}-[0-9]{2}-[0-9]{2}").try_cast("date")


def spellings(values: Iterable[str], aliases: Mapping[str, str]) -> dict[str, str]:
    """Lower-case spelling -> the vocabulary's."""
    values = tuple(values)
    known = {v.lower(): v for v in values}
    known.update({k.lower(): v for k, v in aliases.items() if v in set(values)})
    return known


def lookup_key(col: Column) -> Column:
    return F.lower(trimmed(col))


def canonical(col: Column, values: Iterable[str], aliases: Mapping[str, str]) -> Column:
    """The vocabulary's spelling of a value, null when it is not in it.

    The map is searched entry by entry: for a handful of values only.
    """
    pairs = [F.lit(text) for entry in spellings(values, aliases).items() for text in entry]
    return F.try_element_at(F.create_map(*pairs), lookup_key(col))
