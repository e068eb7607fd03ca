"""Mixing sources to target weights, with DataFrame functions only.

Every row gets a key from a hash. Within a source the rows are ordered by the key in ranges, sizes
are summed up along that order, and the mix takes the order from its start, again and again, until
the source's target is reached to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.placing import bucket_count, running_sum

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float,
                   most: int) -> DataFrame:
    """Adds ``weight`` and ``target`` to a table with a row per ``source`` and its ``source_size``.

    Sources in code point order, null last, get ``weights`` in turn. Their targets share ``share``
    times all sizes by weight, but none exceeds ``most`` times its source's size; what that leaves
    over goes to the others by weight. With sources ordered by the level at which they are full, the
    common level is the largest of (what is left) / (weights left) over that order, so no iteration
    is needed. The table has a row per source, which is why its windows may be unpartitioned.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weighted = sizes.withColumn("__n", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("__n") % len(weights) + 1).cast("int"))
    weighted = weighted.withColumn("weight", weight.cast("double"))
    limit = F.col("source_size") * most
    fill = Window.orderBy(limit / F.col("weight"), "__n")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (
        (F.lit(share) * F.sum("source_size").over(everything)
         - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        / F.sum("weight").over(after)
    )
    return (
        weighted.withColumn("__level", level)
        .withColumn("__level", F.max("__level").over(everything))
        .withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.col("__level")))
        .drop("__n", "__level")
    )


def mix_sources(df: DataFrame, id_column: str = "doc_id", source: str = "source",
                text: str = "text", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                most: int = 2, seed: str = "mix", rows: int | None = None) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``taken`` to every row.

    ``taken`` is the number of words that the mix takes from the row: whole epochs of the source,
    then the row's part of the last one, which ends at the exact word (the target rounded to a whole
    number). It lies between 0 and ``most`` times the size; the row at the cut gives a part of its
    words, its first ones. Null texts have size 0 and a null source is a source like others. Rows
    with equal ids differ in rank by size and text; of equal rows each is taken on its own. All rows
    and columns stay, but columns of the four names are replaced; an empty table gives an empty one.
    """
    count = df.count() if rows is None else rows
    df = df.drop("size", "source_size", "target", "taken")
    digits = F.md5(F.concat_ws("|", F.lit(seed), F.col(id_column).cast("string")).cast("binary"))
    buckets = bucket_count(count)
    keyed = (
        df.withColumn("size", word_count(F.col(text)))
        # Nulls can be no join key: sources are matched by a prefixed copy.
        .withColumn("__source", F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("+"), source)))
        .withColumn("__key", digits)
        .withColumn("__bucket", F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long")
                                       * buckets / F.lit(2.0**32)))
    )
    sizes = keyed.groupBy("__source").agg(F.sum("size").alias("source_size"),
                                         F.first(source).alias("source"))
    targets = source_targets(sizes, weights, share, most).select("__source", "source_size", "target")
    order = [F.col("__key"), F.col("size"), F.xxhash64(text)]
    ranked = running_sum(keyed, ["__source"], "__bucket", order, "size", "__place")
    wanted = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0)
    rest = wanted - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__place")))
    return (
        ranked.join(targets, "__source")
        .withColumn("taken", (epochs * F.col("size") + part).cast("long"))
        .drop("__source", "__key", "__bucket", "__place")
    )


def mixed_rows(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: each row as often as it is taken, the row at the cut with its first words.

    ``mixed`` is the result of ``mix_sources``; its columns come out again. A row without words is
    in no mix.
    """
    full = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    rest = F.col("taken") - full * F.col("size")
    copies = F.concat(F.array_repeat(F.col("size"), full.cast("int")),
                      F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    words = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    first = F.array_join(F.slice(words, 1, F.col("__part").cast("int")), "")
    cut = F.col("__part") < F.col("size")
    return (
        mixed.withColumn("__part", F.explode(copies))
        .withColumn(text, F.when(cut, first).otherwise(F.col(text)))
        .drop("__part")
    )
