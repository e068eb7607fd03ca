"""Token ids as Parquet: one list per text, dictionary and delta encoding, page indexes.

A data set is a folder of files in ascending order of document id. Each row has ``doc_id``,
``file_no`` (files in order), ``first`` (ids of the file before this row), ``n_tokens`` and
``tokens``. Readers that want counts, places or some documents read those narrow columns alone and
skip row groups and pages by ``doc_id``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.tokens import token_slices
from tallybook.llm.workers import small_batches

TOKEN_COLUMN = "tokens.list.element"


def _list_rows(batches, path: str, end: int | None):
    file_no, first = TaskContext.get().partitionId(), 0
    for batch in batches:
        doc_ids = batch.column(0)
        for start, stop, ids, limits in token_slices(batch.column(1), path):
            rows = stop - start
            if end is not None:
                ids = np.insert(ids, limits[1:], end)
                limits = limits + np.arange(rows + 1)
            lists = pa.ListArray.from_arrays(pa.array(limits.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [doc_ids.slice(start, rows), pa.array(np.full(rows, file_no, np.int32)),
                 pa.array(first + limits[:-1]), pa.array(np.diff(limits)), lists],
                names=["doc_id", "file_no", "first", "n_tokens", "tokens"])
            first += int(limits[-1])


def write_tokens(df: DataFrame, folder: str, path: str, id_column: str = "doc_id",
                 text: str = "text", end: int | None = 0, files: int | None = None,
                 row_group_bytes: int = 64 << 20, page_bytes: int = 256 << 10) -> None:
    """Encodes whole texts and writes them to ``folder`` in ascending order of id.

    Null ids come first; rows with equal ids stay next to each other in any order; a null text is an
    empty one. Each range of ids is one file; ``files`` defaults to the shuffle partitions, and one
    wide range holds as many rows as the others whatever its ids. The ids of tokens are
    dictionary-encoded, which packs them into the bits their file needs; the other columns rise or
    vary little and are delta-encoded.
    """
    kind = df.schema[id_column].dataType.simpleString()
    count = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        df.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id")
        .mapInArrow(lambda batches: _list_rows(batches, path, end),
                    f"doc_id {kind}, file_no int, first long, n_tokens long, tokens array<int>")
    )
    with small_batches(df.sparkSession):
        (rows.write.option("compression", "zstd")
         .option("parquet.writer.version", "PARQUET_2_0")
         .option("parquet.enable.dictionary", "false")
         .option(f"parquet.enable.dictionary#{TOKEN_COLUMN}", "true")
         .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
         .option("parquet.dictionary.page.size", 1 << 20)
         .parquet(folder))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a data set with ``start``: the ids of all documents before this one.

    Only the counts are read for the starts of files, one row per file; those are broadcast, so that the
    lists of tokens are not shuffled.
    """
    rows = spark.read.parquet(folder)
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        rows.groupBy("file_no").agg(F.sum("n_tokens").alias("__ids"))
        .select("file_no", F.coalesce(F.sum("__ids").over(before), F.lit(0)).alias("__file_start"))
    )
    return (
        rows.join(F.broadcast(files), "file_no")
        .select("doc_id", (F.col("__file_start") + F.col("first")).alias("start"), "n_tokens", "tokens")
    )


def ids_crc32(tokens: Column) -> Column:
    """CRC-32 of a list of ids as little-endian unsigned 32-bit numbers."""

    @F.arrow_udf("long")
    def checksum(lists: pa.Array) -> pa.Array:
        numbers = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
        limits = (np.asarray(lists.offsets).astype(np.int64) * 4).tolist()
        return pa.array([zlib.crc32(numbers[a:b]) for a, b in zip(limits, limits[1:])], pa.int64())

    return checksum(tokens)
