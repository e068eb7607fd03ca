"""Incremental load: new raw files are standardised as they arrive.

Gap filling needs statistics over all records, so each batch also stores its
value counts; counts add up, and the statistics of the whole history come from
them without reading it again. :func:`clean_history` cleans all stored records;
a :class:`Ledger` keeps the clean table and its rollup up to date instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from tallybook import schemas
from tallybook.config import SHOP, Vocabulary
from tallybook.operators import cleaning, imputation
from tallybook.plans.clean import clean_records
from tallybook.sources.files import read_raw_csv
from tallybook.sources.staging import stage_table
from tallybook.streaming.ledger import Ledger


# The columns of the source that lists files; only paths are read.
_FILES = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def each_batch(spark: SparkSession, source: str, progress: str, handle: Callable[[DataFrame, int], None],
               extras: tuple[str, ...] = (), files_per_batch: int | None = None, multi_line: bool = True) -> None:
    """Calls ``handle`` with the raw records of the CSV files that are new in ``source``, batch by batch.

    The stream carries file names; the files are read as :func:`files.read_raw_csv` reads them, so header
    layouts may differ and quoted fields may hold line breaks. Stops when nothing new is left.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def read(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.collect()]  # the names of one batch's files
        if paths:
            raw = read_raw_csv(batch.sparkSession, paths, multi_line)
            missing = [c for c in extras if c not in raw.columns]
            if missing:
                raise ValueError(f"raw files lack columns: {', '.join(missing)}")
            handle(raw.select(*schemas.RAW_COLUMNS, *extras), batch_id)

    query = (
        reader.load(source).select("path")
        .writeStream.foreachBatch(read).option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def load_new_files(spark: SparkSession, source: str, store: str, vocabulary: Vocabulary = SHOP,
                   extras: tuple[str, ...] = (), files_per_batch: int | None = None) -> None:
    """Process the CSV files that appeared in ``source`` since the last call.

    Columns are found by their names in any spelling (``Transaction ID``), file by file. ``store`` keeps
    records, counts and progress. A batch repeated after a failure overwrites its own output, so no record
    is stored twice.
    """
    def store_batch(raw: DataFrame, batch_id: int) -> None:
        records = f"{store}/records/batch={batch_id}"
        cleaning.standardised_records(raw, vocabulary).write.mode("overwrite").parquet(records)
        stored = raw.sparkSession.read.parquet(records)
        imputation.value_counts(stored).write.mode("overwrite").parquet(
            f"{store}/counts/batch={batch_id}")

    each_batch(spark, source, f"{store}/progress", store_batch, extras, files_per_batch)


def update_ledger(ledger: Ledger, source: str, vocabulary: Vocabulary = SHOP, extras: tuple[str, ...] = (),
                  files_per_batch: int | None = None) -> None:
    """Takes the CSV files that appeared in ``source`` since the last call into ``ledger``."""
    each_batch(ledger.spark, source, f"{ledger.store}/progress",
               lambda raw, batch_id: ledger.apply(cleaning.standardised_records(raw, vocabulary), batch_id),
               extras, files_per_batch)


def clean_history(spark: SparkSession, store: str, price_median: str = "raw") -> DataFrame:
    """Clean records of everything loaded so far.

    A batch counts once both its records and their counts are there, so a
    reader never mixes records with statistics that lack them.
    """
    records, counts = (spark.read.parquet(f"{store}/{part}") for part in ("records", "counts"))
    complete = counts.select("batch").distinct()
    records = records.join(complete, "batch", "left_semi").drop("batch")
    counts = imputation.merge_counts(counts)
    statistics = imputation.fit(stage_table(counts, "value-counts"), price_median)
    return clean_records(records, statistics)
