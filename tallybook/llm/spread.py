"""Joins on keys of which one may hold a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts that the rows of a hot key are dealt over.
PARTS = 64
# A key is hot with more than a thousandth of the rows, so there are at most a thousand.
HOT_SHARE = 1000


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joins ``many`` with ``one``, which has at most one row per key; keys hold no nulls.

    Rows of hot keys are dealt over ``PARTS`` tasks, to each of which the key's row of ``one`` goes. The
    list of hot keys is broadcast; it cannot be longer than ``HOT_SHARE``. ``many`` is read three times, so
    it should be a stored table or come from one.
    """
    counts = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = many.agg(F.count(F.lit(1)).alias("t")).scalar()
    frequent = F.col("__n") > F.greatest(F.lit(HOT_SHARE), total / HOT_SHARE)
    hot = F.broadcast(counts.where(frequent).select(*keys, F.lit(PARTS).alias("__parts")))
    part = F.pmod(F.xxhash64(*many.columns), F.lit(PARTS)).cast("int")
    dealt = many.join(hot, keys, "left").withColumn(
        "__part", F.when(F.col("__parts").isNotNull(), part).otherwise(0)).drop("__parts")
    copied = one.join(hot, keys, "left").withColumn(
        "__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return dealt.join(copied, [*keys, "__part"], how).drop("__part")
