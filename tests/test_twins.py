"""Every registered query of the sales library against its SQL twin on the smallest tables."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as driver
import compare
from oracle import twins
from tallybook.plans import registry

ROOT = os.path.dirname(os.path.abspath(driver.__file__))


@pytest.fixture(scope="module")
def connection(small):
    return compare.connect(small)


@pytest.fixture
def compiled(spark):
    """Code that the JVM cannot compile is an error, not interpreted."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    yield
    spark.conf.unset("spark.sql.codegen.fallback")


def test_every_query_has_a_twin():
    assert registry.queries().keys() == twins.oracle_sql().keys()


@pytest.mark.parametrize("name", list(registry.queries()))
def test_twin(spark, small, connection, compiled, name):
    df = registry.queries()[name](spark, small)
    assert compare.difference(df, connection, twins.oracle_sql()[name]) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["section", "line_no", "line"] and df.count() > 100


@pytest.mark.parametrize("gone", [["tallybook/llm", "tests/llm"], ["tallybook/llm", "tests/llm", "corpus_pipeline.py"],
                                  ["corpus_pipeline.py"]])
def test_registry_without_the_corpus_files(folder, gone):
    copy = shutil.copytree(ROOT, f"{folder}/copy", ignore=shutil.ignore_patterns(".git", "__pycache__", *map(os.path.basename, gone)))
    code = "import __spark_entry__ as d; print(len(d.queries()), len(d.oracle_sql()), 'pipeline' in d.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    if "tallybook/llm" in gone:
        assert out == [str(len(registry.queries())), str(len(twins.oracle_sql())), "False"]
    else:
        assert int(out[0]) > len(registry.queries()) and out[2] == "False"
