"""Append-only record of training runs: parameters, metrics and per-step curves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowtide.sources.readers import read_or_empty

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts", T.TimestampNTZType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)
HISTORY = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def run_rows(df: DataFrame, run_id: Column, run_ts: Column, params: Mapping[str, Column], metrics: Mapping[str, Column]) -> DataFrame:
    """One run per row of ``df``, in the shape of the runs table."""
    def pairs(values: Mapping[str, Column], kind: str) -> Column:
        flat = [part for name, value in values.items() for part in (F.lit(name), value.cast(kind))]
        return F.create_map(*flat) if flat else F.create_map().cast(f"map<string,{kind}>")

    return df.select(
        run_id.cast("string").alias("run_id"),
        run_ts.cast("timestamp_ntz").alias("run_ts"),
        pairs(params, "string").alias("params"),
        pairs(metrics, "double").alias("metrics"),
    )


def log_run(spark: SparkSession, path: str, run: DataFrame) -> None:
    run.write.mode("append").parquet(f"{path}/runs")


def log_history(
    spark: SparkSession, path: str, run_id: str, curves: Mapping[str, Sequence[float]]
) -> None:
    """Per-step values of one training run (as many rows as it had steps)."""
    rows = [(run_id, step, name, float(v)) for name, values in curves.items() for step, v in enumerate(values)]
    spark.createDataFrame(rows, HISTORY).write.mode("append").parquet(f"{path}/run_history")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/runs", RUNS)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/run_history", HISTORY)


def best_run(runs: DataFrame, metric: str = "final_f1") -> DataFrame:
    """The run with the highest value of the metric; runs without it come last."""
    value = F.try_element_at("metrics", F.lit(metric))
    return runs.orderBy(value.desc_nulls_last(), F.col("run_id")).limit(1)
