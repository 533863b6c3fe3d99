"""The full feature table against an independent pandas computation."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.operators.sequences import fit_scaler, latest_window, sequence_limits, sequences, window_weights
from slowtide.operators.slices import split_holdout, split_ordered
from slowtide.plans import features

BASE = datetime(2024, 1, 5, 20, 0)


def raw(n=600, seed=4, ram_from=0):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.integers(0, 30 * 3600, n))
    pdf = pd.DataFrame({"timestamp": pd.to_datetime(BASE) + pd.to_timedelta(t, "s")})
    pdf["response_time"] = rng.exponential(1200, n).round(2)
    pdf["CPU"] = np.where(rng.random(n) < 0.1, np.nan, rng.integers(0, 100, n))
    pdf["RAM"] = np.where((rng.random(n) < 0.2) | (np.arange(n) < ram_from), np.nan, rng.integers(0, 100, n))
    pdf["is_error"] = rng.integers(0, 2, n)
    return pdf


def to_spark(spark, pdf):
    rows = [
        (t.to_pydatetime(), r, *(None if np.isnan(v) else float(v) for v in (c, m)), int(e))
        for t, r, c, m, e in pdf.itertuples(index=False)
    ]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, response_time double, CPU double, RAM double, is_error int")


def expected(pdf, horizon, lags):
    pdf = pdf.assign(d=(pdf["response_time"] > 2000) * 1)
    s = pdf.set_index("timestamp").resample("300s").agg({"d": "max", "response_time": "mean", "CPU": "mean", "RAM": "mean", "is_error": "max"})
    out = pd.DataFrame(index=s.index)
    out["Delay_Detected"] = s["d"].fillna(0)
    out["CPU"], out["response_time"], out["is_error"] = s["CPU"].fillna(0), s["response_time"].fillna(0), s["is_error"].fillna(0)
    out["RAM"] = s["RAM"].ffill().fillna(s["RAM"].median())
    out["hour"], out["day_of_week"] = out.index.hour, out.index.dayofweek
    out["is_weekend"] = (out["day_of_week"] >= 5) * 1
    out["is_peak_hour"] = ((out["hour"] >= 9) & (out["hour"] < 18)) * 1
    for name, c in (("cpu", "CPU"), ("ram", "RAM"), ("response", "response_time")):
        out[f"{name}_rolling_mean"] = out[c].rolling(6, min_periods=1).mean()
        for k in lags:
            out[f"{name}_lag_{k}"] = out[c].shift(k)
    out["cpu_rolling_std"] = out["CPU"].rolling(6, min_periods=1).std()
    for name, c in (("high_cpu", "CPU"), ("high_ram", "RAM")):
        out[name] = (out[c].round(9) > round(out[c].quantile(0.8), 9)) * 1
    out["high_error_period"] = (out["is_error"] > 0) * 1
    out["future_delay"] = out["Delay_Detected"].shift(-horizon)
    out["target"] = out["future_delay"].fillna(0)
    return out


@pytest.mark.parametrize("horizon,lags,ram_from", [(1, (), 0), (2, (1, 2, 3), 0), (1, (), 90)])
def test_feature_table_equals_pandas(spark, horizon, lags, ram_from):
    pdf = raw(ram_from=ram_from)
    got = features.feature_series(to_spark(spark, pdf), horizon=horizon, lags=lags).orderBy("bucket").toPandas()
    want = expected(pdf, horizon, lags)
    assert list(pd.to_datetime(got["bucket"])) == list(want.index)
    assert set(want.columns) <= set(got.columns)
    for c in want:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-7, equal_nan=True, err_msg=c)


def test_feature_table_by_key_equals_each_key_alone(spark):
    parts = {"a": raw(seed=1), "b": raw(300, seed=2, ram_from=40)}
    both = None
    for key, pdf in parts.items():
        df = to_spark(spark, pdf).withColumn("site", F.lit(key))
        both = df if both is None else both.unionByName(df)
    got = features.feature_series(both, keys=["site"]).toPandas()
    for key, pdf in parts.items():
        mine, want = got[got["site"] == key].sort_values("bucket_id"), expected(pdf, 1, ())
        for c in want:
            np.testing.assert_allclose(mine[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-7, equal_nan=True, err_msg=c)


def test_nan_input_counts_as_missing(spark):
    df = to_spark(spark, raw()).withColumn("response_time", F.when(F.col("CPU").isNull(), float("nan")).otherwise(F.col("response_time")))
    flagged = features.flag_delays(df).where("isnan(response_time)").agg(F.max("Delay_Detected")).first()
    assert flagged[0] == 0


@pytest.fixture(scope="module")
def series(spark):
    return features.feature_series(to_spark(spark, raw())).checkpoint()


def test_sequences_equal_slices(spark, series):
    names = ["CPU", "RAM", "high_cpu"]
    pdf = series.orderBy("bucket_id").toPandas()
    got = sequences(series, names).orderBy("bucket_id").collect()
    assert len(got) == len(pdf) - 24
    for i, row in enumerate(got):
        assert row["bucket_id"] == pdf["bucket_id"][i + 24] and row["label"] == pdf["target"][i + 24]
        np.testing.assert_allclose(np.array(row["steps"]), pdf[names].iloc[i : i + 24].to_numpy(dtype=float))


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_scaler_equals_stacked_windows(spark, series, fit_on):
    names = [*schemas.FEATURES, "constant"]
    df = series.withColumn("constant", F.lit(0.1))
    pdf = df.orderBy("bucket_id").toPandas()[names].to_numpy(dtype=float)
    n = len(pdf) - 24
    if fit_on == "train":
        n -= int(np.ceil(n * 0.2))
    stacked = np.concatenate([pdf[i : i + 24] for i in range(n)])
    scaler = fit_scaler(df, names, fit_on=fit_on)
    np.testing.assert_allclose(scaler.mean, stacked.mean(axis=0))
    np.testing.assert_allclose(scaler.scale[:-1], stacked.std(axis=0)[:-1])
    assert scaler.scale[-1] == 1.0


def test_weights_add_up(spark, series):
    total = window_weights(series).agg(F.sum("weight")).first()[0]
    assert total == 24 * (series.count() - 24)


def test_short_series_has_no_sequences(spark, series):
    short = series.orderBy("bucket_id").limit(20)
    assert sequences(short, ["CPU"]).count() == 0
    with pytest.raises(ValueError, match="no sequences"):
        fit_scaler(short, ["CPU"])


@pytest.mark.parametrize("rows", [0, 1, 10, 24, 40])
def test_latest_window_is_padded_in_front(spark, series, rows):
    part = series.orderBy("bucket_id").limit(rows)
    values = [r["CPU"] for r in part.orderBy("bucket_id").collect()]
    steps = [s[0] for s in latest_window(part, ["CPU"]).first()["steps"]]
    want = [0.0] * 24 if not rows else [values[-1]] * (24 - rows) + values[-24:]
    assert steps == want


def test_ordered_split(spark, series):
    windows = sequences(series, ["CPU"])
    n = windows.count()
    for limits in (None, sequence_limits(series)):
        tagged = split_ordered(windows, limits=limits)
        assert tagged.where("is_validation = 1").count() == int(np.ceil(0.2 * n))
        assert tagged.where("is_validation = 0").agg(F.max("bucket_id")).first()[0] < tagged.where("is_validation = 1").agg(F.min("bucket_id")).first()[0]


def test_holdout_is_the_last_five(spark, series):
    held = [r[0] for r in split_holdout(series, 5).where("holdout = 1").select("bucket_id").orderBy("bucket_id").collect()]
    last = series.agg(F.max("bucket_id")).first()[0]
    assert held == list(range(last - 4, last + 1))
