"""Request-log views over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.functions import clock, flags

# The status code that stands for each event type.
STATUS_OF_EVENT = {"error": 500, "signup": 404, "click": 302, "purchase": 201, "view": 200}
# The status code that stands for each order priority digit.
STATUS_OF_PRIORITY = {"1": 200, "2": 302, "3": 404, "4": 500, "5": 201}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(key: Column, values: dict[str, int]) -> Column:
    chain = F
    for name, value in values.items():
        chain = chain.when(key == name, F.lit(value))
    return chain


def load_percent(props: Column) -> Column:
    """The integer 0–99 in the flat JSON text of an event; a pattern reads it faster than a JSON parser."""
    return F.regexp_extract(props, r'"k":\s*(\d+)', 1).try_cast("int")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_requests(table(spark, sf_dir, "events"))


def as_requests(events: DataFrame) -> DataFrame:
    """One row per web request with host load beside it; ``events`` may be a stream."""
    k = F.col("k").cast("double")
    status = _lookup(F.col("event_type"), STATUS_OF_EVENT)
    return (
        events.withColumn("k", load_percent(F.col("props")))
        .select(
            "event_id",
            "user_id",
            F.col("ts").alias("timestamp"),
            (F.col("value") * 40).alias("response_time"),
            F.when(F.col("event_id") % 11 != 0, k).alias("CPU"),
            F.when(F.col("event_id") % 7 != 0, 100 - k).alias("RAM"),
            status.alias("status_code"),
            flags.is_error(status).alias("is_error"),
            F.concat(F.lit("site_"), (F.col("user_id") % 5).cast("string")).alias("site"),
            F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
            F.concat(F.lit("/api/"), F.col("event_type"), F.lit("/"), F.col("k").cast("string")).alias("url"),
            F.concat(
                F.lit("10.0."),
                clock.floor_div(F.col("user_id"), 256).cast("string"),
                F.lit("."),
                (F.col("user_id") % 256).cast("string"),
            ).alias("client_ip"),
        )
    )


def host_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CPU and RAM samples of the host."""
    k = load_percent(F.col("props")).cast("double")
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "view")
        .select(
            F.col("event_id").alias("sample_id"),
            F.col("ts").alias("timestamp"),
            k.alias("cpu_percent"),
            (100 - k).alias("ram_percent"),
            F.concat(F.lit("site_"), (F.col("user_id") % 5).cast("string")).alias("site"),
        )
    )


def server_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log whose time is split in a date text and a time text."""
    return requests(spark, sf_dir).select(
        "event_id",
        F.date_format("timestamp", "yyyy-MM-dd").alias("log_date"),
        F.date_format("timestamp", "HH:mm:ss").alias("log_time"),
        F.concat(F.lit("192.168.0."), (F.col("user_id") % 5).cast("string")).alias("server_ip"),
        "method", "url", "site", "client_ip", "status_code", "response_time", "timestamp",
    )


def w3c_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second request log, over ``orders``, with W3C-style column names."""
    digit = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("log_id"),
        F.when(F.col("o_orderstatus") == "F", "POST").otherwise("GET").alias("cs_method"),
        F.concat(F.lit("/orders/"), F.col("o_orderstatus"), F.lit("/"), F.col("o_orderkey").cast("string")).alias("cs_uri_stem"),
        F.concat(F.lit("192.168.10."), (F.col("o_custkey") % 5).cast("string")).alias("s_ip"),
        F.lit(443).alias("s_port"),
        F.concat(F.lit("10.1."), (F.col("o_custkey") % 256).cast("string")).alias("c_ip"),
        _lookup(digit, STATUS_OF_PRIORITY).alias("sc_status"),
        F.lit(0).alias("sc_substatus"),
        F.lit(0).alias("sc_win32_status"),
        (F.col("o_totalprice") / 100).alias("time_taken"),
        F.col("o_orderdate").alias("datetime"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with their true label."""
    p = load_percent(F.col("props")) / F.lit(100.0)
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.col("ts").alias("timestamp"),
        flags.flag(F.col("value") > 50).alias("true_label"),
        p.alias("probability"),
        flags.decision(p, 0.5).alias("predicted_label"),
    )


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", F.when(F.col("page_id") % 10 != 0, F.col("url")).alias("url")
    )
