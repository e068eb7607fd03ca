"""Getting this package, and texts, to the Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Rows that go to a Python worker at once have about so many bytes.
BATCH_BYTES = 4 << 20

_shipped: set[str] = set()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends texts to Python in batches of about ``BATCH_BYTES``; a longer text goes alone.

    Spark's own bound is 10,000 rows or 64 MB. A task holds a batch in buffers of the next power of two,
    beside its heap, and the worker holds two. Only jobs that start inside, like a stage's, are bound.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ship(spark: SparkSession) -> None:
    """Sends the library to the executors once per application, as ``addPyFile`` does."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallybook-code-"), "tallybook_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
