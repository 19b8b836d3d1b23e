from unittest import mock

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnrisk.operators.quantiles import SKETCH_MARGIN, exact_percentiles
from txnrisk.session import staged


def percentiles(spark, values, fractions, **how):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return exact_percentiles(df, "x", fractions, **how)


BOTH = [{}, {"bins": 4}]


@pytest.mark.parametrize("how", BOTH)
def test_linear_interpolation(spark, how):
    got = percentiles(spark, [float(v) for v in range(1, 12)], [0.02, 0.10, 0.25], **how)
    assert got == pytest.approx([1.2, 2.0, 3.5], abs=1e-12)


@pytest.mark.parametrize("how", BOTH)
def test_ties_nulls_and_single_values(spark, how):
    assert percentiles(spark, [0.3] * 7 + [None], [0.02, 0.5, 1.0], **how) == [0.3] * 3
    assert percentiles(spark, [5.0], [0.25], **how) == [5.0]
    assert percentiles(spark, [None], [0.25], **how) == [None]


def test_heavy_tail_and_hot_value(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([-(10 ** rng.uniform(-9, 6, 2000)), np.full(1000, -0.25), [0.0]])
    fractions = [0.0, 0.02, 0.1, 0.25, 0.5, 0.999, 1.0]
    got = percentiles(spark, values.tolist(), fractions, bins=32)
    assert got == pytest.approx(np.quantile(values, fractions).tolist(), rel=1e-12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40),
    st.lists(st.floats(0, 1), min_size=1, max_size=3),
)
def test_equals_numpy(spark, values, fractions):
    got = percentiles(spark, values, fractions, bins=8)
    assert got == pytest.approx(np.quantile(values, fractions).tolist(), rel=1e-9, abs=1e-9)


def test_infinities_and_nan_stand_at_the_ends(spark):
    inf, nan = float("inf"), float("nan")
    values = [float(v) for v in range(1, 51)]
    assert percentiles(spark, [*values, nan], [0.0, 0.5, 0.98], bins=4) == [1.0, 26.0, 50.0]
    assert percentiles(spark, [*values, inf], [0.0, 0.5, 0.999], bins=4) == [1.0, 26.0, inf]
    assert percentiles(spark, [-inf, -inf, 1.0], [0.0, 0.4, 1.0]) == [-inf, -inf, 1.0]
    assert np.isnan(percentiles(spark, [nan, nan], [0.5])[0])


def test_span_beyond_a_double(spark):
    assert percentiles(spark, [-1.7e308, -1.0, 2.0, 1.7e308], [0.0, 1 / 3, 0.5, 1.0], bins=4) == [-1.7e308, -1.0, 0.5, 1.7e308]


def many(spark, n):
    """Values close to each other, far apart, and one that a third of the rows have."""
    i = F.col("id")
    spread = F.when(i % 3 == 0, -0.25).when(i % 3 == 1, (i * 7919 % 1_000_003).cast("double")).otherwise(1.0 / (i + 1))
    return spark.range(n, numPartitions=8).select(spread.alias("x"))


def test_the_column_is_scanned_twice(spark):
    rows, seen = many(spark, 60_000), spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def watched(x: pd.Series) -> pd.Series:
        seen.add(len(x))
        return x

    # Not deterministic, so that a scan calls it once per row, not once more for the filter on nulls.
    column = rows.select(watched.asNondeterministic()("x").alias("x"))
    got = exact_percentiles(column, "x", [0.02, 0.10, 0.25, 0.5, 0.9, 0.999], bins=16)
    assert seen.value == 2 * 60_000
    values = [r[0] for r in rows.collect()]
    assert got == pytest.approx(np.quantile(values, [0.02, 0.10, 0.25, 0.5, 0.9, 0.999]).tolist(), rel=1e-12)


def test_few_rows_are_written_aside(spark):
    rows = many(spark, 60_000).cache()
    asides = []

    def watched(df, label):
        asides.append(df.select(F.count("x")).first()[0])
        return staged(df, label)

    with mock.patch("txnrisk.operators.quantiles.staged", watched):
        exact_percentiles(rows, "x", [0.4, 0.8])
    rows.unpersist()
    # Two stretches of at most twice the margin each, and the sketch's error at their ends.
    assert len(asides) == 1 and asides[0] < 60_000 * 2 * 3 * SKETCH_MARGIN


def test_a_misleading_sketch_only_costs_another_scan(spark):
    rows = many(spark, 20_000)
    values = [r[0] for r in rows.collect()]
    wrong = mock.patch("txnrisk.operators.quantiles.SKETCH_MARGIN", 1e-6)
    with wrong:
        got = exact_percentiles(rows, "x", [0.37, 0.5, 0.83])
    assert got == pytest.approx(np.quantile(values, [0.37, 0.5, 0.83]).tolist(), rel=1e-12)
