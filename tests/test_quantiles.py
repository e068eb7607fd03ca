from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tallybook.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.2, 0.25, 0.5, 0.75, 1.0]


def quantiles(spark, values):
    rows = [("x", Decimal(str(v)), n) for v, n in values]
    df = spark.createDataFrame(rows, "series string, value decimal(18,6), n bigint")
    return {r.series: r.q for r in exact_quantiles(df, PROBABILITIES).collect()}.get("x")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(
    st.decimals(min_value=-10**6, max_value=10**6, places=3), st.integers(1, 4)), min_size=1,
    max_size=30))
def test_agrees_with_brute_force(spark, values):
    every = np.repeat([float(v) for v, _ in values], [n for _, n in values])
    assert quantiles(spark, values) == pytest.approx(list(np.quantile(every, PROBABILITIES)))


def test_wide_range_and_hot_value(spark):
    values = [(5, 10_000_000), ("0.000001", 3), (999_999_999_999, 2), (-7, 4)]
    got = quantiles(spark, values)
    assert got[0] == -7 and got[3] == 5 and got[-1] == 999_999_999_999


def test_nothing_to_measure(spark):
    assert quantiles(spark, []) is None


def test_series_are_independent(spark):
    df = spark.createDataFrame([("a", Decimal(1), 1), ("a", Decimal(2), 1), ("b", Decimal(9), 5)],
                               "series string, value decimal(18,6), n bigint")
    got = {r.series: r.q for r in exact_quantiles(df, [0.5]).collect()}
    assert got == {"a": [1.5], "b": [9.0]}
