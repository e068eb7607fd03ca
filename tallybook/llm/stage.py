"""Intermediate tables of the corpus operators in the session's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.sources.staging import staging_path


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Writes ``df`` to a new path under the shared folder and reads it back."""
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more: all that came of them is stored."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
