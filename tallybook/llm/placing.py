"""Running sums and gapless ranks within groups, without one task per group."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def bucket_count(rows: int) -> int:
    """Buckets per group for ``rows`` rows in all.

    With the square root of the rows, neither a bucket of a group that has all rows nor the list of
    a group's buckets is longer than that root.
    """
    return max(1, isqrt(rows))


def running_sum(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: str,
                name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows before this one in its group.

    Rows are ordered by ``bucket``, then ``order``; ``group`` and ``bucket`` hold no nulls. A window
    sees one bucket only. The sums of whole buckets are added from an aggregate that has one row per
    bucket, so the rows are shuffled once, however large their group is. ``df`` is read twice.
    """
    keys = [*group, bucket]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("__sum"))
    over = Window.partitionBy(*group).orderBy(bucket) if group else Window.partitionBy(F.lit(0)).orderBy(bucket)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("__within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return (
        local.join(offsets, keys)
        .withColumn(name, F.col("__before") + F.col("__within"))
        .drop("__before", "__within")
    )
