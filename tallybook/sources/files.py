"""File readers and writers at the job boundaries."""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallybook import schemas

# Quotes are doubled inside quoted fields, blanks are data.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "dateFormat": "yyyy-MM-dd",
}


def snake_case(name: str) -> str:
    """'Price Per Unit' -> 'price_per_unit', 'DayOfWeek' -> 'day_of_week'."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name.strip())
    return re.sub(r"[^0-9a-z]+", "_", spaced.lower()).strip("_")


def first_lines(spark: SparkSession, files: list[str]) -> list[str | None]:
    """The first line of each file, read by the driver from the start of the file alone.

    Sixteen files are open at a time; no Spark job runs. Compressed files are recognised by their names.
    """
    context = spark.sparkContext
    jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def line(file: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream, codec = path.getFileSystem(conf).open(path), codecs.getCodec(path)
        reader = jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(line, files))


def csv_headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> the CSV files that have it; the driver keeps file names and headers.

    Files without a line are left out.
    """
    files = sorted(spark.read.text(path).inputFiles())
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, first_lines(spark, files)):
        names = tuple(next(csv.reader([line.removeprefix("\ufeff")]), ())) if line else ()
        if names:
            layouts.setdefault(names, []).append(file)
    return layouts


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True,
                 malformed: str | None = None) -> DataFrame:
    """Raw records with a header row, every column text, found by name.

    Files may differ in the order of their columns and in further columns; each
    header is read on its own and the rows are united by name. A path that does
    not exist fails at once (``PATH_NOT_FOUND``), and so does a file without one
    of the eight record columns.

    ``multi_line`` allows line breaks inside quotes; a file is then read by one
    task, whatever its size, at some 60 MB a second: turn it off for files of
    more than a few hundred megabytes that have no such breaks. ``malformed``
    names a further column with the text of a record that does not fit its
    header, null for all others; count it to report such records.
    """
    parts = []
    for header, paths in csv_headers(spark, path).items():
        names = [snake_case(c) for c in header]
        missing = [c for c in schemas.RAW_COLUMNS if c not in names]
        if missing:
            raise ValueError(f"raw file lacks columns: {', '.join(missing)}")
        extras = [c for c in names if c not in schemas.RAW_COLUMNS]
        fields = [T.StructField(c, T.StringType()) for c in (*header, *([malformed] if malformed else []))]
        reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).schema(T.StructType(fields))
        if malformed:
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", malformed)
            names = [*names, malformed]
            extras = [*extras, malformed]
        parts.append(reader.csv(paths).toDF(*names).select(*schemas.RAW_COLUMNS, *extras))
    if not parts:
        raise ValueError(f"no header in {path}")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def malformed_records(raw: DataFrame, malformed: str) -> DataFrame:
    """How many records do not fit their header, in one row.

    The count names all columns, since Spark refuses to parse for the malformed text alone.
    """
    return raw.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col(malformed).isNotNull() & F.coalesce(*raw.columns).isNotNull()).alias("malformed"))


# A published table is a folder with its versions and a file that names the current one.
CURRENT, VERSIONS = "_current", "_versions"


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(context._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version a published table shows; None for a plain table or none at all."""
    pointer, store = _hadoop(spark, f"{path.rstrip('/')}/{CURRENT}")
    if not store.exists(pointer):
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(store.open(pointer), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def table_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds the rows of a table, published in versions or plain."""
    version = current_version(spark, path)
    return f"{path.rstrip('/')}/{VERSIONS}/{version}" if version else path


def read_typed(spark: SparkSession, path: str, schema: T.StructType,
               file_format: str = "parquet") -> DataFrame:
    """Read a clean or engineered table written by :func:`write_table` or :func:`publish_table`."""
    reader = spark.read.schema(schema)
    if file_format == "csv":
        # A header that disagrees with the schema is an error, not a shift.
        reader = reader.options(**CSV_OPTIONS).option("enforceSchema", False).option("mode", "FAILFAST")
    return reader.format(file_format).load(table_folder(spark, path))


def read_clean(spark: SparkSession, path: str, file_format: str = "parquet",
               extras: tuple[str, ...] = ()) -> DataFrame:
    return read_typed(spark, path, schemas.with_extras(schemas.CLEAN, *extras), file_format)


def read_engineered(spark: SparkSession, path: str, file_format: str = "parquet",
                    extras: tuple[str, ...] = ()) -> DataFrame:
    """``extras`` are further text columns of the clean records, such as the order type."""
    clean = schemas.with_extras(schemas.CLEAN, *extras).fields
    schema = T.StructType(clean + schemas.FINANCIAL.fields + schemas.TIME.fields)
    return read_typed(spark, path, schema, file_format)


def write_table(df: DataFrame, path: str, file_format: str = "parquet",
                partition_by: tuple[str, ...] = (), rebalance: bool = True) -> None:
    """Overwrite ``path`` with ``df``; missing parent folders are created.

    With ``partition_by`` the rows are first rebalanced on those columns, so a
    month is written by a few tasks rather than by all of them, and adaptive
    execution splits a month that is much larger than the rest. ``rebalance=False``
    leaves that out for rows that are together already, such as those of
    :func:`tallybook.operators.features.gathered_by_month`. Parquet files are
    compressed with zstd.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_format == "csv":
        writer = writer.options(**CSV_OPTIONS)
    elif file_format == "parquet":
        writer = writer.option("compression", "zstd")
    writer.format(file_format).save(path)


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Makes ``version`` the one that readers of ``path`` see.

    The pointer is written beside and renamed over the old one in one step of the file system, so a reader
    finds the old or the new one, and a writer that dies before leaves the old one.
    """
    root = path.rstrip("/")
    target, store = _hadoop(spark, f"{root}/{CURRENT}")
    pending, _ = _hadoop(spark, f"{root}/{CURRENT}.{uuid.uuid4().hex}")
    out = store.create(pending)
    out.write(bytearray(version.encode()))
    out.close()
    context = spark.sparkContext
    files = context._jvm.org.apache.hadoop.fs
    rename = getattr(files, "Options$Rename")
    options = context._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration()).rename(pending, target, options)


def forget_versions(spark: SparkSession, path: str, keep: Iterable[str]) -> None:
    """Deletes versions of a published table that are not in ``keep``."""
    folder, store = _hadoop(spark, f"{path.rstrip('/')}/{VERSIONS}")
    for entry in store.listStatus(folder):
        if entry.getPath().getName() not in keep:
            store.delete(entry.getPath(), True)


def publish_table(df: DataFrame, path: str, check: Callable[[], None] = lambda: None,
                  file_format: str = "parquet", partition_by: tuple[str, ...] = (),
                  versions: bool = False, rebalance: bool = True) -> DataFrame:
    """Write ``df`` once beside ``path``, then put it in its place.

    ``check`` runs once the rows are written; if it raises, they are removed and ``path`` stays as it was.

    Plain tables are folders any reader can open; replacing one is a deletion and a renaming, and a job
    that dies between the two leaves the rows in the folder beside. With ``versions`` there is no such
    moment: the rows become a new version below ``path``, and the pointer to it changes in one step at the
    end. Readers resolve the pointer (:func:`read_typed`, :func:`table_folder`). The version before the
    current one stays for readers that have begun with it; older ones go after the change. Of two writers at
    once the later pointer counts.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    pending = f"{root}/{VERSIONS}/{version}" if versions else f"{root}.pending-{version}"
    before = current_version(spark, path)
    write_table(df, pending, file_format, partition_by, rebalance)
    new, store = _hadoop(spark, pending)
    try:
        check()
    except Exception:
        store.delete(new, True)
        raise
    if versions:
        point_to(spark, path, version)
        forget_versions(spark, path, {version, before})
    else:
        old, _ = _hadoop(spark, root)
        store.delete(old, True)
        if not store.rename(new, old):
            raise OSError(f"checked rows stay in {pending}, {path} could not be written")
    return read_typed(spark, path, df.schema, file_format)


def write_report(lines: DataFrame, path: str) -> None:
    """Write report lines (section, line_no, line) as one text file, in order.

    A report has a line per month, product, channel and payment method, never
    per sale, so one file is one small task.
    """
    ordered = lines.orderBy("section", "line_no").select(F.col("line").alias("value"))
    ordered.coalesce(1).write.mode("overwrite").text(path)


def register_sales_view(engineered: DataFrame, name: str = "sales") -> None:
    """Expose engineered rows to SQL.

    Spark resolves names without regard to case, so ``Total_Spent`` finds
    ``total_spent``; the two calendar columns whose usual SQL spelling has no
    underscore get it here.
    """
    spelled = {"day_of_week": "DayOfWeek", "is_weekend": "IsWeekend"}
    engineered.withColumnsRenamed(spelled).createOrReplaceTempView(name)
