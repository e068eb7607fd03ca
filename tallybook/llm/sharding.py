"""Shards by jump consistent hashing.

A row's shard follows from its key and the number of shards alone: there is no ring table, and one
more shard takes rows only into itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.placing import bucket_count, running_sum


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), dtype=np.int64)
    active = np.arange(len(state))
    while len(active):
        state[active] = state[active] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[active] >> np.uint64(33)).astype(np.float64) + 1.0
        jump = ((shard[active] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        on = jump < shards
        active = active[on]
        shard[active] = jump[on]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard column of a 64-bit key column; null keys share the shard of key 0."""
    if shards < 1:
        raise ValueError("shards must be positive")

    @F.pandas_udf("int")
    def jumped(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64), shards))

    return jumped(F.coalesce(key, F.lit(0)))


def shard_rows(df: DataFrame, keys: list[str], shards: int = 16, grow_by: int = 1,
               rows: int | None = None) -> DataFrame:
    """Adds ``shard``, ``slot`` and ``grown_shard`` to every row.

    ``shard`` comes from the hash of ``keys``; rows with equal keys share a shard, nulls count as a
    value of their own. ``slot`` numbers the rows of a shard without gaps from 0, in an order that
    follows from the keys; rows with equal keys are numbered in any order. ``grown_shard`` is the
    shard once ``grow_by`` shards are appended. All rows and columns are kept, but columns of these
    three names are replaced; an empty table gives an empty one.

    A shard may hold any number of rows: slots are counted in buckets of hashed keys.
    """
    count = df.count() if rows is None else rows
    df = df.drop("shard", "slot", "grown_shard")
    placed = (
        df.withColumn("__key", F.xxhash64(*keys))
        .withColumn("shard", shard_of(F.col("__key"), shards))
        .withColumn("grown_shard", shard_of(F.col("__key"), shards + grow_by))
        .withColumn("__bucket", F.pmod(F.xxhash64(F.col("__key")), F.lit(bucket_count(count))))
        .withColumn("__one", F.lit(1).cast("long"))
    )
    numbered = running_sum(placed, ["shard"], "__bucket", [F.col("__key")], "__one", "slot")
    return numbered.drop("__key", "__bucket", "__one")
