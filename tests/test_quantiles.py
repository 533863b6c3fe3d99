"""Exact quantiles against numpy, also when the sort is not allowed to hold everything."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slowtide.operators.quantiles import exact_quantiles, quantiles_by
from slowtide.operators.sketch import fences

PS = [0.0, 0.1, 0.25, 0.5, 0.8, 0.9, 1.0]


def column(spark, values):
    rows = [(None if v is None else float(v),) for v in values]
    return spark.createDataFrame(rows, "x double").repartition(5)


def check(spark, values, limit):
    got = exact_quantiles(column(spark, values), {"x": (F.col("x"), PS)}, in_one_sort=limit)["x"]
    clean = [v for v in values if v is not None and not np.isnan(v)]
    np.testing.assert_allclose(got, np.quantile(clean, PS), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("limit", [1, 20, 10**6])
def test_distinct_values(spark, limit):
    check(spark, np.random.default_rng(0).normal(0, 1e3, 3000), limit)


@pytest.mark.parametrize("limit", [1, 20, 10**6])
def test_one_value_holds_a_third_of_the_rows(spark, limit):
    rng = np.random.default_rng(1)
    check(spark, np.concatenate([np.full(1000, 5.0), rng.exponential(10, 2000)]), limit)


@pytest.mark.parametrize("limit", [1, 10**6])
def test_few_values(spark, limit):
    check(spark, np.random.default_rng(2).integers(0, 4, 500), limit)


def test_far_outliers(spark):
    check(spark, np.concatenate([np.random.default_rng(3).random(2000), [1e300, -1e300]]), 3)


def test_single_value(spark):
    check(spark, [3.5], 1)


def test_nulls_and_nan_are_skipped(spark):
    got = exact_quantiles(column(spark, [1, 2, 3, 10, None, float("nan")]), {"x": (F.col("x"), [0.8])})
    assert got["x"] == [pytest.approx(5.8)]


def test_no_values(spark):
    assert exact_quantiles(column(spark, [None, None]), {"x": (F.col("x"), [0.5])})["x"] == [None]


def test_several_columns_at_once(spark):
    df = column(spark, range(101)).withColumn("y", F.col("x") * 2)
    got = exact_quantiles(df, {"a": (F.col("x"), [0.5]), "b": (F.when(F.col("y") > 100, F.col("y")), [0.5])}, in_one_sort=10)
    assert got == {"a": [50.0], "b": [151.0]}


def test_narrowed_equals_plain_on_skewed_partitions(spark):
    # Sorted input: every task sees another part of the value range.
    df = spark.range(0, 20_000, 1, 16).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    plain = exact_quantiles(df, {"x": (F.col("x"), PS)})
    assert exact_quantiles(df, {"x": (F.col("x"), PS)}, in_one_sort=50) == plain


def test_fences_follow_the_distribution(spark):
    df = spark.range(0, 100_000, 1, 16).select(F.col("id").cast("double").alias("x"))
    n, marks = fences(df, [F.col("x")], 100)[0]
    assert n == 100_000 and len(marks) == 101
    assert all(abs(m - i * 1000) < 2000 for i, m in enumerate(marks))


def keyed(spark, rows):
    return spark.createDataFrame([(k, None if x is None else float(x), float(y)) for k, x, y in rows], "k string, x double, y double").repartition(4)


@pytest.mark.parametrize("limit", [2, 40, 10**6])
def test_all_keys_at_once_equal_numpy(spark, limit):
    rng = np.random.default_rng(4)
    # One key holds most rows, one has a single value for half of them, one no value at all, one is null.
    rows = [("hot", x, x * 2) for x in rng.normal(0, 1, 6000)] + [("ties", x, -x) for x in np.concatenate([np.full(300, 7.0), rng.random(300)])]
    rows += [("none", None, 1.0), ("one", 5.0, 5.0)] + [(None, x, 0.0) for x in rng.integers(0, 9, 50)] + [(f"k{i}", i, i) for i in range(40)]
    got = {r["k"]: r for r in quantiles_by(keyed(spark, rows), ["k"], {"a": (F.col("x"), PS), "b": (F.col("y"), [0.5])}, in_one_sort=limit).collect()}
    assert set(got) == {k for k, _, _ in rows}
    for key, row in got.items():
        xs = [float(x) for k, x, _ in rows if k == key and x is not None]
        if not xs:
            assert row["a"] == [None] * len(PS)
        else:
            np.testing.assert_allclose(row["a"], np.quantile(xs, PS), rtol=1e-12, atol=1e-12)
        np.testing.assert_allclose(row["b"], np.quantile([y for k, _, y in rows if k == key], [0.5]), rtol=1e-12, atol=1e-12)


def read_times(spark, n, ask, margin):
    """How often the rows are read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield pa.RecordBatch.from_arrays(b.columns, names=["x"])

    df = spark.range(0, n, 1, 4).select(((F.col("id") * 7919) % n).cast("double").alias("x")).mapInArrow(count, "x double")
    got = ask(df, margin)
    return got, seen.value / n


def test_input_is_read_twice_and_three_times_when_a_sketch_is_off(spark):
    targets = {"a": (F.col("x"), [0.1, 0.5]), "b": (F.col("x") * 2, [0.9])}
    for margin, most in ((0.005, 2), (1e-9, 3)):
        got, times = read_times(spark, 50_000, lambda df, m: exact_quantiles(df, targets, margin=m), margin)
        assert got["a"] == pytest.approx([4999.9, 24999.5]) and got["b"] == pytest.approx([2 * 44999.1]) and times <= most
        rows, times = read_times(spark, 50_000, lambda df, m: quantiles_by(df.withColumn("k", F.floor(F.col("x") / 25_000)), ["k"], targets, margin=m).orderBy("k").collect(), margin)
        assert [r["a"][1] for r in rows] == pytest.approx([12499.5, 37499.5]) and times <= most
