"""The scheduled re-runs as streams: series, quality counters and scoring."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowtide import schemas
from slowtide.functions import clock, flags
from slowtide.operators.series import fill_gaps
from slowtide.plans.features import HEALTH_AGGS, add_features, flag_delays
from slowtide.plans.training import DelayModel, predict_latest
from slowtide.session import durable
from slowtide.sources.writers import append_predictions
from slowtide.streaming.store import COMPACT, Measures, PartStore

LATENESS = timedelta(minutes=10)
HOUR = 3600
#: What scoring looks back on: the history that the scheduled job reads.
HISTORY = timedelta(hours=schemas.SCORING_HOURS)


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table as a stream: a folder with its new files, or one file.

    All files that wait make one batch, or ``files_per_batch`` of them; the results below are the same.
    """
    reader = spark.readStream.schema(schema)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(where) and files.getFileStatus(where).isFile():
        # A stream needs a folder, so one file is the only one of its folder that it sees.
        reader, path = reader.option("pathGlobFilter", where.getName()), where.getParent().toString()
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def series_measures() -> Measures:
    """The health series, over requests with ``Delay_Detected``."""
    return {name: (kind, F.col(column)) for name, (kind, column) in HEALTH_AGGS.items()}


def quality_measures() -> Measures:
    """Rows, nulls and values out of range."""

    def where(condition: Column) -> tuple[str, Column]:
        return "count", F.when(condition, 1)

    def outside(c: str) -> Column:
        return (F.col(c) < 0) | (F.col(c) > 100)

    return {
        "records": ("count", F.lit(1)),
        "null_cpu": where(F.col("CPU").isNull()),
        "null_ram": where(F.col("RAM").isNull()),
        "null_response_time": where(F.col("response_time").isNull()),
        "bad_cpu": where(outside("CPU")),
        "bad_ram": where(outside("RAM")),
        "negative_response_time": where(F.col("response_time") < 0),
        "errors": where(F.col("is_error") == 1),
    }


def series_store(spark: SparkSession, folder: str, **options) -> PartStore:
    return PartStore(spark, folder, series_measures(), schemas.BUCKET_SECONDS, **options)


def quality_store(spark: SparkSession, folder: str, **options) -> PartStore:
    return PartStore(spark, folder, quality_measures(), HOUR, **options)


def run_available(stream: DataFrame, store: PartStore, then=None) -> None:
    """Add what has arrived to the store, batch by batch; ``then`` gets each batch's number after it.

    No row is dropped as late: it merges into its bucket whenever it comes.
    """
    store.knowing(stream)

    def handle(rows: DataFrame, batch: int) -> None:
        store.add(rows, batch)
        if then is not None:
            then(batch)

    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{store.folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_series(requests: DataFrame, folder: str, lateness: timedelta = LATENESS, **options) -> DataFrame:
    """Closed buckets of the health series, once all that has arrived is in the store at ``folder``."""
    store = series_store(requests.sparkSession, folder, **options)
    run_available(flag_delays(requests), store)
    return store.buckets(lateness).drop("bucket_id")


def stream_quality(requests: DataFrame, folder: str, lateness: timedelta = LATENESS, **options) -> DataFrame:
    """Per closed hour: rows, nulls and values out of range."""
    store = quality_store(requests.sparkSession, folder, **options)
    run_available(requests, store)
    return store.buckets(lateness).drop("bucket_id")


def run_scoring(requests: DataFrame, model: DelayModel, folder: str, lateness: timedelta = LATENESS, history: timedelta = HISTORY, compact: int = COMPACT) -> None:
    """After each batch, predict from the closed buckets of the last ``history`` and log it under the batch's number.

    The store keeps little more than that history, so a batch reads a bounded number of buckets however long the
    stream has run. The prediction is that of the batch job over the same hours.
    """
    spark = requests.sparkSession
    store = series_store(spark, f"{folder}/buckets", keep=history + lateness + timedelta(hours=1), compact=compact)

    def predict(batch: int) -> None:
        recent = durable(store.buckets(lateness, since=history))
        newest = recent.agg(F.max("bucket")).first()[0]
        if newest is None:
            return
        series = add_features(fill_gaps(recent.drop("bucket"), schemas.BUCKET_SECONDS))
        at = F.lit(newest).cast("timestamp_ntz") + clock.seconds(schemas.BUCKET_SECONDS)
        append_predictions(predict_latest(model, series, at), f"{folder}/predictions", f"batch-{batch}")

    run_available(flag_delays(requests), store, predict)
