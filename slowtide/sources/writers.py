"""Sinks; every one writes in parallel from the executors."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.sources.readers import NTZ_FORMAT, read_or_empty


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", NTZ_FORMAT).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def as_predictions(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.PREDICTIONS])


def append_predictions(df: DataFrame, path: str, run: str) -> None:
    """Add the rows of one run, named by its time or batch, to the prediction log; other runs' rows stay.

    A run has a folder of its own, which its repetition replaces, so a job that runs twice leaves one set of rows.
    """
    write_run(as_predictions(df), path, run)


def write_run(df: DataFrame, path: str, run: str) -> None:
    """The rows of one run of a table with a folder per run."""
    write_parquet(df, f"{path}/run={quote(run, safe='')}")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.PREDICTIONS).select(*schemas.PREDICTIONS.names)


def save_results(df: DataFrame, kind: str, options: Mapping[str, str], run: str) -> None:
    """Append one run's predictions by configuration: ``parquet`` or ``jdbc``."""
    if kind == "parquet":
        append_predictions(df, options["path"], run)
    elif kind == "jdbc":
        as_predictions(df).write.mode("append").format("jdbc").options(**{"dbtable": "predictions", **options}).save()
    else:
        raise ValueError(f"unknown sink kind: {kind}")


def write_split(tagged: DataFrame, train_path: str, holdout_path: str) -> None:
    """Train and hold-out part of a series tagged ``holdout``; the time column is kept."""
    for part, path in ((0, train_path), (1, holdout_path)):
        write_parquet(tagged.where(F.col("holdout") == part).drop("holdout"), path)


def append_report(report: DataFrame, path: str, now: Column) -> None:
    """JSON report rows, one folder per monitoring date."""
    (
        report.withColumn("monitoring_timestamp", now)
        .withColumn("monitoring_date", F.date_format(now, "yyyy-MM-dd"))
        .write.mode("append")
        .partitionBy("monitoring_date")
        .json(path)
    )
