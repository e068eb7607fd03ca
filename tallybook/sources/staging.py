"""Intermediate tables written once to the shared folder and read back.

Writing cuts the lineage: later stages neither recompute the input nor lose it
with an executor. The registered reports stage statistics, rollups and, where
more than one pass needs them, the standardised records.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybook.session import shared_folder


# Rows of a file at most. Compressed rows are small: a task that reads a hundred megabytes of them would have
# more than it can group in memory, and of small files Spark gives it fewer.
FILE_ROWS = 100_000


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tallybook/{app}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.partitionBy(*partition_by).options(compression="zstd", maxRecordsPerFile=FILE_ROWS).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def staged_once(spark: SparkSession, dataset: str, name: str,
                build: Callable[[], DataFrame], partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``stage_table(build(), name, partition_by)``, kept for the life of the application."""
    key = (spark.sparkContext.applicationId, dataset, name)
    found = _STAGED.get(key)
    if found is None or found.sparkSession is not spark:
        found = stage_table(build(), name, partition_by)
        _STAGED[key] = found
    return found
