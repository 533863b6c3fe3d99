"""Resampling, fills and windows against pandas, for several chunk sizes."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slowtide.functions import clock
from slowtide.operators.chunked import forward_fill, over_halo, rolling_mean, rolling_std
from slowtide.operators.series import bounds, fill_gaps, resample, spine

BASE = datetime(2024, 1, 1)
CHUNKS = [7, 100, 288]


def irregular(n: int = 400, seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    return pd.DataFrame(
        {
            "t": pd.to_datetime(BASE) + pd.to_timedelta(np.sort(rng.integers(0, 3 * 86400, n)), "s"),
            "x": np.where(rng.random(n) < 0.2, np.nan, rng.normal(50, 20, n).round(3)),
            "d": rng.integers(0, 2, n),
            "site": rng.choice(["a", "b"], n),
        }
    )


def to_spark(spark, pdf):
    rows = [(t.to_pydatetime(), None if np.isnan(x) else float(x), int(d), s) for t, x, d, s in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "t timestamp_ntz, x double, d int, site string")


AGGS = {"worst": ("max", "d"), "mean": ("mean", "x"), "total": ("sum", "d")}


def pandas_resample(pdf, step):
    return pdf.set_index("t").resample(f"{step}s").agg(worst=("d", "max"), mean=("x", "mean"), total=("d", "sum"))


def assert_same(got: pd.Series, want: pd.Series):
    np.testing.assert_allclose(got.astype(float).to_numpy(), want.astype(float).to_numpy(), rtol=1e-9, atol=1e-9, equal_nan=True)


def test_gap_case(spark):
    df = spark.createDataFrame([(BASE + timedelta(minutes=3), 1.0), (BASE + timedelta(minutes=14), 3.0)], "t timestamp_ntz, x double")
    rows = resample(df, {"s": ("sum", "x"), "m": ("mean", "x"), "h": ("max", "x")}, 300, ts="t").orderBy("bucket").collect()
    assert [r["bucket"] for r in rows] == [BASE + timedelta(minutes=m) for m in (0, 5, 10)]
    assert [(r["s"], r["m"], r["h"]) for r in rows] == [(1.0, 1.0, 1.0), (0.0, None, None), (3.0, 3.0, 3.0)]


@pytest.mark.parametrize("step", [300, 600])
def test_resample_equals_pandas(spark, step):
    pdf = irregular()
    got = resample(to_spark(spark, pdf), AGGS, step, ts="t").orderBy("bucket_id").toPandas()
    want = pandas_resample(pdf, step)
    assert list(pd.to_datetime(got["bucket"])) == list(want.index)
    for c in want:
        assert_same(got[c], want[c])


def test_resample_by_key_equals_pandas(spark):
    pdf = irregular()
    got = resample(to_spark(spark, pdf), AGGS, 300, ts="t", keys=["site"]).toPandas()
    for site, part in pdf.groupby("site"):
        mine = got[got["site"] == site].sort_values("bucket_id")
        want = pandas_resample(part, 300)
        assert len(mine) == len(want)
        for c in want:
            assert_same(mine[c], want[c])


def test_empty_input_gives_empty_series(spark):
    assert resample(to_spark(spark, irregular().iloc[:0]), AGGS, 300, ts="t").count() == 0


def test_null_times_are_left_out(spark):
    df = spark.createDataFrame([(BASE, 1.0), (None, 5.0)], "t timestamp_ntz, x double")
    assert [r["s"] for r in resample(df, {"s": ("sum", "x")}, 300, ts="t").collect()] == [1.0]


def test_buckets_before_1970_are_left_closed(spark):
    df = spark.createDataFrame([(datetime(1969, 12, 31, 23, 58),)], "t timestamp_ntz")
    row = df.select(clock.bucket_start(clock.bucket_of(F.col("t"), 300), 300).alias("b")).first()
    assert row["b"] == datetime(1969, 12, 31, 23, 55)


@pytest.mark.parametrize("chunk", [1, 7, 288])
def test_spine_has_no_gap(spark, chunk):
    limits = spark.createDataFrame([(-20, 300)], "lo bigint, hi bigint")
    assert sorted(r[0] for r in spine(limits, chunk=chunk).collect()) == list(range(-20, 301))


def dense(spark, n=500, seed=3, keys=False):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"bucket_id": np.arange(1000, 1000 + n), "x": np.where(rng.random(n) < 0.35, np.nan, rng.normal(0, 5, n)), "c": rng.integers(0, 5, n)})
    pdf.loc[: 30, "x"] = np.nan
    rows = [(int(b), None if np.isnan(x) else float(x), int(c)) for b, x, c in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(rows, "bucket_id bigint, x double, c int")


@pytest.mark.parametrize("chunk", CHUNKS)
def test_lag_lead_rolling_equal_pandas(spark, chunk):
    pdf, df = dense(spark)
    got = over_halo(
        df,
        lambda w: {
            "lag3": F.lag("x", 3).over(w),
            "lag24": F.lag("c", 24).over(w),
            "lead2": F.lead("x", 2).over(w),
            "mean6": rolling_mean("x", w, 6),
            "std6": rolling_std("x", w, 6),
            "mean12": rolling_mean("x", w, 12, 12),
            "std36": rolling_std("c", w, 36, 36),
        },
        back=35,
        forward=2,
        chunk=chunk,
    ).orderBy("bucket_id").toPandas()
    want = {
        "lag3": pdf["x"].shift(3), "lag24": pdf["c"].shift(24), "lead2": pdf["x"].shift(-2),
        "mean6": pdf["x"].rolling(6, min_periods=1).mean(), "std6": pdf["x"].rolling(6, min_periods=1).std(),
        "mean12": pdf["x"].rolling(12).mean(), "std36": pdf["c"].rolling(36).std(),
    }
    assert list(got["bucket_id"]) == list(pdf["bucket_id"])
    for c, series in want.items():
        assert_same(got[c], series)


def test_rolling_edge_case(spark):
    df = spark.createDataFrame(list(enumerate([None, 1.0, 2.0, None, 4.0])), "bucket_id bigint, x double")
    got = over_halo(df, lambda w: {"m": rolling_mean("x", w, 3), "s": rolling_std("x", w, 3)}, back=2, chunk=2).orderBy("bucket_id").collect()
    assert [r["m"] for r in got] == [None, 1.0, 1.5, 1.5, 3.0]
    assert [None if r["s"] is None else round(r["s"], 4) for r in got] == [None, None, 0.7071, 0.7071, 1.4142]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_forward_fill_equals_pandas(spark, chunk):
    pdf, df = dense(spark)
    got = forward_fill(df, ["x"], chunk=chunk).orderBy("bucket_id").toPandas()
    assert_same(got["x"], pdf["x"].ffill())
    assert list(got["c"]) == list(pdf["c"])


def test_forward_fill_crosses_empty_chunks(spark):
    rows = [(i, 5.0 if i == 2 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "bucket_id bigint, x double")
    got = [r["x"] for r in forward_fill(df, ["x"], chunk=7).orderBy("bucket_id").collect()]
    assert got == [None, None] + [5.0] * 58


@pytest.mark.parametrize("chunk", [7, 288])
def test_windows_by_key_equal_pandas(spark, chunk):
    pdf, df = dense(spark)
    both = df.withColumn("k", F.lit("a")).unionByName(df.withColumns({"k": F.lit("b"), "x": F.col("x") * 2}))
    got = over_halo(forward_fill(both, ["x"], ["k"], chunk), lambda w: {"m": rolling_mean("x", w, 6)}, back=5, keys=["k"], chunk=chunk).toPandas()
    for key, factor in (("a", 1), ("b", 2)):
        mine = got[got["k"] == key].sort_values("bucket_id")
        assert_same(mine["m"], (pdf["x"].ffill() * factor).rolling(6, min_periods=1).mean())


def test_no_row_passes_through_one_task(spark):
    _, df = dense(spark)
    plan = over_halo(df, lambda w: {"m": rolling_mean("x", w, 6)}, back=5)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_fill_gaps_uses_given_limits(spark):
    buckets = spark.createDataFrame([(10, 1)], "bucket_id bigint, n int")
    limits = spark.createDataFrame([(8, 12)], "lo bigint, hi bigint")
    assert sorted((r["bucket_id"], r["n"]) for r in fill_gaps(buckets, 300, zero=["n"], limits=limits).collect()) == [
        (8, 0), (9, 0), (10, 1), (11, 0), (12, 0)
    ]
    assert bounds(buckets).first().asDict() == {"lo": 10, "hi": 10}
