"""Training on a planted signal; streams against batch."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from slowtide.functions import clock
from slowtide.operators import runs
from slowtide.plans import features, training
from slowtide.plans import jobs as jobs_plan
from slowtide.session import durable
from slowtide.sources import writers
from slowtide.streaming import jobs

BASE = datetime(2024, 1, 1)
RAW = "timestamp timestamp_ntz, response_time double, CPU double, RAM double, is_error int"


def planted(spark, hours=60):
    """Delays follow three buckets after CPU rises."""
    rng = np.random.default_rng(0)
    busy = np.repeat(rng.random(hours) < 0.5, 12)
    rows = []
    for b in range(hours * 12):
        slow = b >= 3 and busy[b - 3]
        for j in range(2):
            rows.append((BASE + timedelta(minutes=5 * b + j), 3000.0 if slow else 300.0, float(90 if busy[b] else 10) + float(rng.random()), 50.0, 0))
    return spark.createDataFrame(rows, RAW)


@pytest.fixture(scope="module")
def series(spark):
    return features.feature_series(planted(spark)).checkpoint()


@pytest.fixture(scope="module")
def model(series):
    return training.train(series, max_iter=20)


def test_model_beats_the_majority_class(series, model):
    share = model.metrics["positive_class_ratio"]
    majority = -(share * np.log(share) + (1 - share) * np.log(1 - share))
    assert model.metrics["val_loss"] < 0.6 * majority and model.metrics["final_f1"] > 0.85
    assert model.losses[-1] < model.losses[0]


def test_scores_are_probabilities(series, model):
    rows = training.score(model, series)
    assert rows.count() == series.count() - 24
    lo, hi = rows.agg(F.min("probability"), F.max("probability")).first()
    assert 0 <= lo <= hi <= 1


def test_latest_prediction_has_the_log_shape(series, model):
    row = training.predict_latest(model, series, clock.instant("2024-01-31 00:00:00")).first()
    assert row["prediction"] in (0, 1) and 0 <= row["probability"] <= 1 and row["answer"] in ("Yes", "No")
    assert row["timestamp"] == datetime(2024, 1, 31)
    assert training.predict_latest(model, series, clock.instant("2024-01-31 00:00:00"), threshold=1.0).first()["prediction"] == 0


def test_saved_model_scores_the_same(spark, series, model, tmp_path):
    training.save_model(model, str(tmp_path / "m"))
    back = training.load_model(spark, str(tmp_path / "m"))
    at = clock.instant("2024-01-31 00:00:00")
    assert back.threshold == model.threshold and back.features == model.features
    assert training.predict_latest(back, series, at).first() == training.predict_latest(model, series, at).first()


def test_jobs_gate_train_predict_and_report(spark, tmp_path):
    folder, at = str(tmp_path / "jobs"), clock.instant("2024-01-03 12:00:00")
    raw = planted(spark).checkpoint()
    assert jobs_plan.predict_job(spark, raw, folder, at) == "no_model"
    assert writers.read_predictions(spark, f"{folder}/predictions").count() == 0
    assert jobs_plan.train_job(spark, raw.limit(999), folder, at) == "insufficient_data"
    assert jobs_plan.train_job(spark, raw.limit(1200).drop("RAM"), folder, at) == "missing_columns"
    assert jobs_plan.train_job(spark, raw.orderBy("timestamp").limit(400).crossJoin(spark.range(3)).drop("id"), folder, at) == "insufficient_processed_data"
    assert jobs_plan.train_job(spark, raw, folder, at, max_iter=10) == "training_success"
    assert jobs_plan.predict_job(spark, raw.limit(99), folder, at) == "insufficient_data"
    later = clock.instant("2024-01-31 01:00:00")
    for when in (at, later, later):
        assert jobs_plan.predict_job(spark, raw, folder, when).startswith("prediction_success")
    # The repeated run replaced its row, and its drift numbers.
    log = writers.read_predictions(spark, f"{folder}/predictions")
    drift = spark.read.parquet(f"{folder}/drift")
    assert log.count() == 2 and drift.count() == 2 and drift.where("cpu_std > 0 AND pred_prob_std IS NOT NULL").count() == 2
    # The newest request is less than six hours old, times repeat nowhere, but two predictions in the hour are too few.
    assert jobs_plan.monitor_job(raw, log, runs.read_runs(spark, folder), folder, at) == "WARNING"
    assert spark.read.json(f"{folder}/reports").count() == 1


@pytest.mark.parametrize("weighting", ["asymmetric", None])
def test_other_weightings_train(series, weighting):
    assert training.train(series, features=["CPU", "RAM", "not there"], weighting=weighting, max_iter=3).features == ("CPU", "RAM")


def write_batches(df, folder, cuts):
    """One file per time range, so each micro-batch sees one of them."""
    edges = [None, *cuts, None]
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        part = df
        if lo is not None:
            part = part.where(F.col("timestamp") >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            part = part.where(F.col("timestamp") < F.lit(hi).cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").parquet(folder)


def closed_batch(df):
    newest = df.agg(F.max("timestamp")).first()[0] - timedelta(minutes=10)
    whole = features.health_series(df).drop("bucket_id")
    return whole.where((F.col("bucket") + F.expr("INTERVAL '5' MINUTE") <= F.lit(newest).cast("timestamp_ntz")) & F.col("response_time").isNotNull())


def same(got, want):
    def plain(df):
        return sorted((r["bucket"], r["Delay_Detected"], r["is_error"], *[None if r[c] is None else round(r[c], 6) for c in ("response_time", "CPU", "RAM")]) for r in df.collect())

    return plain(got) == plain(want)


def test_stream_equals_batch_on_closed_buckets(spark, tmp_path):
    df = planted(spark, hours=6)
    source = str(tmp_path / "in")
    write_batches(df, source, [BASE + timedelta(hours=2), BASE + timedelta(hours=4)])
    got = jobs.stream_series(jobs.read_stream(spark, source, df.schema, files_per_batch=1), str(tmp_path / "out"))
    assert got.count() > 50 and same(got, closed_batch(df))


def test_restart_goes_on_and_late_rows_merge(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    def rows(minutes):
        return spark.createDataFrame([(BASE + timedelta(minutes=m), 100.0 * m, 1.0, 2.0, 0) for m in minutes], RAW)

    def run():
        got = jobs.stream_series(jobs.read_stream(spark, source, rows([]).schema), sink)
        return {r["bucket"]: r["response_time"] for r in got.collect()}

    rows([1, 6, 30]).coalesce(1).write.mode("append").parquet(source)
    assert run() == {BASE: 100.0, BASE + timedelta(minutes=5): 600.0}
    # 00:03 comes long after its bucket was closed, and is part of it from then on.
    rows([3, 60]).coalesce(1).write.mode("append").parquet(source)
    assert run() == {BASE: 200.0, BASE + timedelta(minutes=5): 600.0, BASE + timedelta(minutes=30): 3000.0}


def test_many_batches_of_files_that_interleave_equal_the_batch(spark, tmp_path):
    df = durable(planted(spark, hours=6).repartition(8))
    df.withColumn("f", F.monotonically_increasing_id()).write.partitionBy("f").parquet(str(tmp_path / "in"))
    files = sorted((tmp_path / "in").glob("f=*/*.parquet"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "f=*"))
    got = jobs.stream_series(stream.select(*df.columns), str(tmp_path / "out"))
    assert len(files) > 120 and len(list((tmp_path / "out" / "parts").iterdir())) > 120
    assert same(got, closed_batch(df))


def test_a_repeated_batch_replaces_itself_and_bases_are_exact(spark, tmp_path):
    df = planted(spark, hours=3).withColumn("k", F.minute("timestamp") % 7)
    store = jobs.series_store(spark, str(tmp_path / "s"), compact=3).knowing(features.flag_delays(df))
    for k in range(7):
        for _ in range(2):
            store.add(features.flag_delays(df.where(F.col("k") == k)), k)
    assert [p.name for p in sorted((tmp_path / "s" / "base").iterdir())] == ["2", "5"]
    assert same(store.buckets(timedelta(minutes=10)), closed_batch(df))


def test_quality_stream_counts(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(BASE + timedelta(minutes=m), -1.0 if m == 5 else 100.0, 150.0 if m == 6 else 1.0, None if m == 7 else 2.0, m % 2) for m in (5, 6, 7, 200)]
    df = spark.createDataFrame(rows, RAW)
    df.coalesce(1).write.parquet(source)
    row = jobs.stream_quality(jobs.read_stream(spark, source, df.schema), sink).first()
    assert (row["records"], row["null_ram"], row["bad_cpu"], row["negative_response_time"], row["errors"]) == (3, 1, 1, 1, 2)


def batch_probability(model, raw, newest):
    """The prediction of the batch over the day before ``newest``, the end of the last closed bucket."""
    end = F.lit(newest).cast("timestamp_ntz")
    day = raw.where((F.col("timestamp") < end) & (F.col("timestamp") >= end - F.expr("INTERVAL '24' HOUR")))
    return training.predict_latest(model, features.feature_series(day), clock.instant("2024-01-31 00:00:00")).first()["probability"]


def test_stream_scores_equal_the_batch_over_the_last_day(spark, tmp_path, model):
    source, folder = str(tmp_path / "in"), str(tmp_path / "run")
    df = durable(planted(spark, hours=40))
    write_batches(df, source, [BASE + timedelta(hours=h) for h in (4, 20, 30)])
    jobs.run_scoring(jobs.read_stream(spark, source, df.schema, files_per_batch=1), model, folder)
    got = writers.read_predictions(spark, f"{folder}/predictions").orderBy("timestamp").collect()
    assert len(got) == 4
    for r in got:
        assert r["probability"] == pytest.approx(batch_probability(model, df, r["timestamp"]))


def test_scoring_reads_no_more_as_the_stream_goes_on(spark, tmp_path):
    # 50 batches of an hour: what a batch reads stays that of a day and the last parts.
    store = jobs.series_store(spark, str(tmp_path / "s"), keep=timedelta(hours=26), compact=5)
    df = features.flag_delays(planted(spark, hours=50))
    store.knowing(df)
    read = []
    for k in range(50):
        start = F.lit(BASE + timedelta(hours=k)).cast("timestamp_ntz")
        store.add(df.where((F.col("timestamp") >= start) & (F.col("timestamp") < start + F.expr("INTERVAL '1' HOUR"))), k)
        if k % 7 == 6:
            read.append(store._read().count())
    # The kept hours, one begun, and the parts since the last base.
    assert max(read) <= 12 * (26 + 1 + 5)
    assert store.buckets(timedelta(minutes=10), since=timedelta(hours=24)).count() == 288
