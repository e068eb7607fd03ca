"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.stage import stage


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``vertex`` and ``label`` (smallest vertex reachable) for every vertex of ``edges`` (``a``, ``b``).

    Alternates large-star and small-star steps until nothing changes. Each step is a grouped minimum
    and a join on the vertex; every step is stored, so that a lost executor repeats one step only.
    Raises if ``rounds`` steps do not end it, which takes about the logarithm of the longest path.
    """
    # From the larger to the smaller end.
    directed = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .distinct(), "edges")
    state = None
    for _ in range(rounds):
        upward = directed.select(F.col("b").alias("a"), F.col("a").alias("b"))
        low = directed.unionByName(upward).groupBy("a").agg(F.min("b").alias("low"))
        large = upward.join(low, "a").select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        directed = stage(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "edges")
        now = directed.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if now == state:
            labels = directed.select(F.col("a").alias("vertex"), F.col("b").alias("label"))
            roots = directed.select(F.col("b").alias("vertex"), F.col("b").alias("label")).distinct()
            return labels.unionByName(roots)
        state = now
    raise RuntimeError(f"no end after {rounds} rounds")
