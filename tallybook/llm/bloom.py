"""Bit tables for membership probes, built by aggregation and bounded in size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits that one row of the aggregate holds.
BUCKET = 1 << 15


def power_of_two(wanted: int, most: int) -> int:
    """The power of two at or above ``wanted``, a bucket at least and ``most`` at most."""
    return min(max(BUCKET, 1 << max(wanted - 1, 1).bit_length()), most)


def bit_table(positions: DataFrame, position: str, bits: int) -> np.ndarray:
    """A table of ``bits`` bits, a multiple of ``BUCKET``, as bytes, with the given positions set.

    Positions are combined on the executors; the driver receives the table, ``bits / 8`` bytes at most.
    """
    table = np.zeros(bits // 8, np.uint8)
    at = F.col(position)
    rows = (
        positions.groupBy(F.shiftright(at, 15).alias("bucket"))
        .agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(BUCKET - 1))).alias("bitmap"))
    )
    width = BUCKET // 8
    for row in rows.toLocalIterator():
        table[row.bucket * width:(row.bucket + 1) * width] = np.frombuffer(row.bitmap, np.uint8)
    return table


def probe_positions(key: Column, bits: int, probes: int) -> Column:
    """The positions of a well mixed 64-bit key in a table of a power of two of bits."""
    low, high = key.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(key, 32).bitwiseOR(F.lit(1))
    return F.array(*[(low + high * j).bitwiseAND(F.lit(bits - 1)) for j in range(probes)])


def probe(table: np.ndarray, keys: np.ndarray, probes: int) -> np.ndarray:
    """True for each key whose positions are all set: all that were put in, and few others."""
    keys = keys.view(np.uint64)
    low, high = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    last = np.uint64(len(table) * 8 - 1)
    left = np.arange(len(keys))
    for j in range(probes):
        at = (low[left] + high[left] * np.uint64(j)) & last
        left = left[(table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0]
    found = np.zeros(len(keys), dtype=bool)
    found[left] = True
    return found
