"""Rows stored so that slicers on any of several columns skip most of a file.

A space-filling key interleaves the bits of the columns' positions. Files and row groups sorted by it
hold a narrow range of every column, so the least and greatest values in the Parquet footers rule most
row groups out, whichever of the columns is filtered.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Positions a column is cut into (a power of two), and distinct values the cuts are taken from at most.
# Both decide the layout alone, never which rows a query returns.
BITS = 6
SAMPLED_VALUES = 4096


def cut_points(df: DataFrame, column: str, bits: int = BITS) -> list[str]:
    """Up to 2^bits - 1 values that cut the rows into parts of like size.

    Rows are counted per value; of more than ``SAMPLED_VALUES`` values those with the smallest hashes
    stand for all.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    found = sorted(counts.orderBy(F.xxhash64("value"), "value").limit(SAMPLED_VALUES).collect())
    parts = 1 << bits
    if len(found) <= parts:
        return [r.value for r in found[1:]]
    upto, total = [], 0
    for r in found:
        total += r.n
        upto.append(total)
    at = sorted({bisect_left(upto, total * k / parts) for k in range(1, parts)})
    return [found[k].value for k in at if k]


def position(column: str, cuts: Sequence[str]) -> Column:
    """Number of cut points up to a value, by halving; null counts as the lowest."""
    value = F.col(column).cast("string")

    def find(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), find(low, middle)).otherwise(find(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(find(0, len(cuts)))


def interleaved(positions: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of all positions in turn, the highest first."""
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for k, p in enumerate(positions):
            key = key + F.shiftleft(F.shiftright(p, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(positions) + k)
    return key


def clustered(df: DataFrame, columns: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """``df`` range-partitioned and sorted by ``within`` and the interleaved key of ``columns``.

    A value that a third of the rows share is spread over several partitions by the rest of the key and
    a hash of the row, since equal keys would meet in one.
    """
    bits = max(1, min(BITS, 60 // len(columns)))
    key = interleaved([position(c, cut_points(df, c, bits)) for c in columns], bits)
    order = [*within, "__key"]
    # The hash decides the partition alone and does not travel.
    rows = df.withColumn("__key", key).repartitionByRange(*order, F.xxhash64(*df.columns))
    return rows.sortWithinPartitions(*order).drop("__key")


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], partition_by: Sequence[str] = (),
                    row_group_bytes: int = 16 << 20,
                    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Overwrite ``path`` with Parquet files clustered by ``columns`` within each of ``partition_by``.

    ``df`` is read once per column to count its values and twice to sort by range: store it first if it
    is costly. Smaller row groups skip more and compress less. ``derive`` adds columns row by row once the
    rows are in order, so that these neither travel nor are sorted.
    """
    # The columns of the order keep their identity, or the writer would sort the rows anew.
    held = {c: f"__{c}" for c in partition_by}
    rows = derive(clustered(df, columns, partition_by).withColumns({h: F.col(c) for c, h in held.items()}))
    rows = rows.drop(*held).withColumnsRenamed({h: c for c, h in held.items()})
    writer = rows.write.mode("overwrite").options(**{"parquet.block.size": row_group_bytes, "compression": "zstd"})
    writer.partitionBy(*partition_by).parquet(path)
