"""Vocabularies as tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallybook.config import Vocabulary
from tallybook.functions.text import spellings


def item_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """(spelling, known): every lower-case spelling of an item and the one to use."""
    known = spellings(vocabulary.items, vocabulary.item_aliases)
    return spark.createDataFrame(pa.table({
        "spelling": pa.array(list(known.keys()), pa.string()),
        "known": pa.array(list(known.values()), pa.string()),
    }))
