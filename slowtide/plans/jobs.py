"""The scheduled jobs as plain functions: merge logs, train, predict, monitor.

Each gate's answer is the returned status; a job that fails its gate changes nothing.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.functions import clock, flags
from slowtide.operators import columns, quality, runs
from slowtide.operators.asof import asof_join
from slowtide.operators.slices import split_holdout, tail
from slowtide.plans import features, training
from slowtide.plans.monitoring import health_report
from slowtide.session import durable
from slowtide.sources import writers


def merge_server_log(
    log: DataFrame,
    samples: DataFrame,
    tolerance: timedelta | None = timedelta(seconds=5),
    skip_day: int | None = 24,
    zone: str = "Asia/Kolkata",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Server log and host samples to one request table.

    The log's time is rebuilt from its UTC date and time texts and moved to ``zone``,
    the samples already being there; one day of the month can be left out on both sides.
    """
    utc = clock.from_date_and_time(F.col("log_date"), F.col("log_time"))
    timed = log.withColumn("timestamp", clock.shift_zone(utc, zone)).where(F.col("timestamp").isNotNull())
    if skip_day is not None:
        timed, samples = columns.without_day(timed, skip_day), columns.without_day(samples, skip_day)
    joined = asof_join(timed, samples, "timestamp", tolerance=tolerance)
    enriched = features.enrich(joined.withColumnsRenamed(schemas.HOST_TO_COMMON))
    return columns.keep_present(enriched, [*extra, *schemas.FINAL_COLUMNS])


def train_job(spark: SparkSession, raw: DataFrame, folder: str, now: Column, **options) -> str:
    """Gates, features, hold-out, fit, and a trial of the stored model; then its run record is stored.

    A model that fails its trial gets no record, so no job will score with it.
    """
    status = quality.training_readiness(raw).first()["status"]
    if status != "prerequisites_ok":
        return status
    series = durable(features.feature_series(raw))
    status = quality.training_readiness(raw, series).first()["status"]
    if status != "prerequisites_ok":
        return status
    kept = split_holdout(series, schemas.HOLDOUT_BUCKETS).where("holdout = 0").drop("holdout")
    model = training.train(kept, **options)
    run_id = uuid.uuid4().hex
    training.save_model(model, f"{folder}/models/{run_id}")
    row = runs.run_rows(
        spark.range(1),
        F.lit(run_id),
        now,
        {
            "window_size": F.lit(model.window),
            "features": F.lit(",".join(model.features)),
            "model_type": F.lit("logistic"),
            "best_f1_threshold": F.lit(model.threshold),
        },
        {name: F.lit(value) for name, value in model.metrics.items()},
    )
    checked = check_model(spark, f"{folder}/models/{run_id}", series, now)
    if checked != "validation_success":
        return checked
    runs.log_history(spark, folder, run_id, {"train_loss": model.losses})
    runs.log_run(spark, folder, row)
    low = model.metrics["final_f1"] < 0.1
    return "training_success_low_f1" if low else "training_success"


def check_model(spark: SparkSession, path: str, series: DataFrame, now: Column, rows: int = 100) -> str:
    """Load a stored model as scoring will, predict from the last ``rows`` buckets, and judge the answer."""
    answer = durable(training.predict_latest(training.load_model(spark, path), tail(series, rows, "bucket_id"), now))
    return quality.score_sanity(answer, predicted="prediction").first()["status"]


def predict_job(
    spark: SparkSession,
    raw: DataFrame,
    folder: str,
    now: Column,
    hours_back: float = 2,
    metric: str = "final_f1",
    hours_read: float = schemas.SCORING_HOURS,
) -> str:
    """Predict from the last hours with the best recorded model; log the answer and the drift numbers of the run.

    Only the last ``hours_read`` of ``raw`` are read for the features, their quantiles included. The run is named
    by ``now``; a repeated run replaces its rows.
    """
    raw = columns.since_latest(raw, hours_read, "timestamp")
    status = quality.scoring_readiness(raw).first()["status"]
    if status != "health_ok":
        return status
    best = runs.best_run(runs.read_runs(spark, folder), metric).first()
    if best is None:
        return "no_model"
    model = training.load_model(spark, f"{folder}/models/{best['run_id']}")
    series = durable(features.feature_series(raw))
    recent = columns.since_latest(series, hours_back, "bucket")
    answer = durable(training.predict_latest(model, recent, now))
    sane = quality.score_sanity(answer, predicted="prediction").first()["status"]
    if sane != "validation_success":
        return sane
    run = spark.range(1).select(F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).first()[0]
    writers.append_predictions(answer, f"{folder}/predictions", run)
    log = writers.read_predictions(spark, f"{folder}/predictions")
    writers.write_run(quality.drift_numbers(series, log, tie=["probability"]), f"{folder}/drift", run)
    alert = answer.agg(F.max(flags.flag(F.col("prediction") == 1))).first()[0]
    return "prediction_success_alert" if alert else "prediction_success"


def monitor_job(
    raw: DataFrame, predictions: DataFrame, run_table: DataFrame, folder: str, now: Column, strict: bool = False
) -> str:
    """Write the health report and return the overall status."""
    report = durable(health_report(raw, predictions, run_table, now, strict))
    writers.append_report(report, f"{folder}/reports", now)
    return report.first()["overall_status"]
