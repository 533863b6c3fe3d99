"""Streams over the events table; their closed windows must equal the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slowtide import schemas
from slowtide.catalog.registry import query, rounded
from slowtide.plans import features, training
from slowtide.session import durable, fresh_folder
from slowtide.sources.testdata import as_requests, requests
from slowtide.sources.writers import read_predictions
from slowtide.streaming import jobs


def request_stream(spark: SparkSession, sf: str) -> DataFrame:
    return as_requests(jobs.read_stream(spark, f"{sf}/events.parquet", schemas.EVENTS))


_CLOSED = """{end} <= (SELECT max("timestamp") - INTERVAL 10 MINUTE FROM requests)"""


@query(
    "st1_stream_series",
    f"""SELECT bucket, "Delay_Detected", round(response_time, 6) AS response_time, round("CPU", 6) AS "CPU", round("RAM", 6) AS "RAM", is_error FROM series
        WHERE "Delay_Detected" IS NOT NULL AND {_CLOSED.format(end="bucket + INTERVAL 5 MINUTE")}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(jobs.stream_series(request_stream(spark, sf), fresh_folder(spark, "stream-series")))


@query(
    "st3_stream_quality_counters",
    f"""SELECT date_trunc('hour', "timestamp") AS bucket, count(*) AS records, count(*) FILTER ("CPU" IS NULL) AS null_cpu, count(*) FILTER ("RAM" IS NULL) AS null_ram,
               count(*) FILTER (response_time IS NULL) AS null_response_time, count(*) FILTER ("CPU" < 0 OR "CPU" > 100) AS bad_cpu,
               count(*) FILTER ("RAM" < 0 OR "RAM" > 100) AS bad_ram, count(*) FILTER (response_time < 0) AS negative_response_time,
               count(*) FILTER (is_error = 1) AS errors
        FROM requests WHERE {_CLOSED.format(end="date_trunc('hour', \"timestamp\") + INTERVAL 1 HOUR")} GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.stream_quality(request_stream(spark, sf), fresh_folder(spark, "stream-quality"))


@query("st2_stream_scores")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A model trained on the history scores the stream's newest closed window."""
    model = training.train(durable(features.feature_series(requests(spark, sf))))
    folder = fresh_folder(spark, "stream-scores")
    jobs.run_scoring(request_stream(spark, sf), model, folder)
    return read_predictions(spark, f"{folder}/predictions")
