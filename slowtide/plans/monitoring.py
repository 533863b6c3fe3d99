"""One health report over the request log, the prediction log and the run table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.operators import quality


#: Status of a component that nobody looked at.
NOT_MONITORED = "not_monitored"


def health_report(
    requests: DataFrame | None, predictions: DataFrame | None, runs: DataFrame | None, now: Column, strict: bool = False
) -> DataFrame:
    """One row: every component's status, its main numbers and the overall status.

    A component without a table was not checked: it says so, has no numbers, and does not count overall.
    """
    checks = []
    if requests is not None:
        checks.append(_data(requests, now))
    if predictions is not None:
        checks.append(_activity(predictions, now))
    if runs is not None:
        checks.append(_model(runs, now))
    if not checks:
        raise ValueError("nothing to report on")
    found = reduce(DataFrame.unionByName, checks)
    # At most three rows become one.
    numbers = found.groupBy().pivot("component", ["data", "model", "predictions"]).agg(
        F.first("status").alias("status"), F.first("amount").alias("amount"), F.first("hours_old").alias("hours_old")
    )
    statuses = F.array_compact(F.array("data_status", "model_status", "predictions_status"))

    def status(component: str) -> Column:
        return F.coalesce(f"{component}_status", F.lit(NOT_MONITORED)).alias(f"{component}_status")

    return numbers.select(
        status("data"),
        F.col("data_amount").cast("bigint").alias("records"),
        F.col("data_hours_old").alias("hours_old"),
        status("model"),
        F.col("model_amount").cast("bigint").alias("model_age_days"),
        status("predictions"),
        F.col("predictions_amount").cast("bigint").alias("recent_predictions"),
        quality.overall_status(statuses, strict).alias("overall_status"),
    )


def _data(requests: DataFrame, now: Column) -> DataFrame:
    return quality.data_health(requests, now).select(
        F.lit("data").alias("component"), "status", F.col("records").cast("double").alias("amount"), "hours_old"
    )


def _activity(predictions: DataFrame, now: Column) -> DataFrame:
    return quality.prediction_activity(predictions, now).select(
        F.lit("predictions").alias("component"),
        "status",
        F.col("recent_count").cast("double").alias("amount"),
        F.lit(None).cast("double").alias("hours_old"),
    )


def _model(runs: DataFrame, now: Column) -> DataFrame:
    return quality.model_age(runs, now).select(
        F.lit("model").alias("component"),
        "status",
        F.col("age_days").cast("double").alias("amount"),
        F.lit(None).cast("double").alias("hours_old"),
    )
