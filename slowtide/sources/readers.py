"""Request logs from files or a database, all in one contract schema."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowtide import schemas
from slowtide.functions import clock

NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """CSV with header and declared types; a broken line gives nulls, never a failure."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_corrupt and CORRUPT not in schema.names else schema
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("timestampNTZFormat", NTZ_FORMAT)
        .csv(path)
    )


def recent_window(df: DataFrame, now: Column, hours_back: float = 24, ts: str = "datetime") -> DataFrame:
    """The metrics query: six columns, the last hours. Rows are not sorted, as all that follows groups them by time."""
    return df.select(ts, "time_taken", "CPU", "RAM", "sc_status", "is_error").where(F.col(ts) >= now - clock.seconds(hours_back * 3600))


def jdbc_options(
    url: str,
    table: str = "system_metrics",
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a database scan, read in parallel ranges of ``partition_column``."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partitioned scan needs lower and upper")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(partitions),
        }
    return options


def in_ranges(options: Mapping[str, str], newest: datetime, hours_back: float, partitions: int = 8) -> dict[str, str]:
    """``options`` of a scan of the hours before ``newest``, by default over ``partitions`` connections by time.

    Rows outside of the bounds are read too, by the first and last connection; the filter decides.
    """
    if "partitionColumn" in options:
        return dict(options)
    lower = newest - timedelta(hours=hours_back)
    return {
        **options,
        "partitionColumn": "datetime",
        "lowerBound": lower.isoformat(sep=" "),
        "upperBound": newest.isoformat(sep=" "),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, options: Mapping[str, str], now: Column, hours_back: float = 24) -> DataFrame:
    """Recent metrics from a database, over several connections; Spark sends the filter and column list along."""
    newest = spark.range(1).select(now.cast("timestamp_ntz")).first()[0]
    return recent_window(spark.read.format("jdbc").options(**in_ranges(options, newest, hours_back)).load(), now, hours_back)


def as_request_log(rows: DataFrame) -> DataFrame:
    """Rows under the database's or the contract's names in the contract schema; columns that the source lacks are null."""
    named = rows.withColumnsRenamed(schemas.SQL_SOURCE_TO_COMMON)
    there = set(named.columns)
    return named.select(
        *[(F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.REQUEST_LOG]
    )


def load(
    spark: SparkSession,
    kind: str,
    options: Mapping[str, str],
    now: Column | None = None,
    hours_back: float = 24,
) -> DataFrame:
    """Request log by configuration: ``csv``, ``parquet`` or ``jdbc``.

    All three give the same columns; the database names its own differently and has neither ids nor sites.
    """
    if kind == "csv":
        return read_csv(spark, options["path"], schemas.REQUEST_LOG)
    if kind == "parquet":
        return spark.read.schema(schemas.REQUEST_LOG).parquet(options["path"])
    if kind == "jdbc":
        if now is None:
            raise ValueError("a database source needs now")
        return as_request_log(read_jdbc(spark, options, now, hours_back))
    raise ValueError(f"unknown source kind: {kind}")


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table written by this engine."""
    return spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An append-only table; empty as long as nothing has been appended."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
