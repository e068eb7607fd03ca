"""Registered corpus queries: SQL twins on the smallest tables, and what covers those without SQL."""

import pytest

import __spark_entry__ as driver
import compare
from tallybook.llm import queries

# Query -> the test that compares it, or its operator, with a brute-force version.
NO_SQL = {
    "op3_sharding": "test_operators.py::test_shards_follow_the_key",
    "op4_quality": "test_operators.py::test_classifier_on_held_out_labels",
    "op6_token_files": "test_operators.py::test_token_files_read_back",
    "op8_html": "test_operators.py::test_main_text",
    "op9_packing": "test_operators.py::test_packing_is_gapless_and_tight",
    "op10_lm": "test_operators.py::test_scores_have_exact_counts",
    "op11_spelling": "test_words.py::test_variants_equal_brute_force",
    "pipeline": "test_pipeline.py::test_stages_follow_each_other",
}


@pytest.fixture(scope="module")
def connection(small):
    return compare.connect(small)


def test_every_query_has_sql_or_a_test():
    assert queries.QUERIES.keys() | {"pipeline"} == queries.ORACLE_SQL.keys() | NO_SQL.keys()
    assert not queries.ORACLE_SQL.keys() & NO_SQL.keys()


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_twin(spark, small, connection, name):
    df = driver.queries()[name](spark, small)
    assert compare.difference(df, connection, driver.oracle_sql()[name]) is None
