"""As-of joins and the spine join."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.catalog.registry import query
from slowtide.operators.asof import asof_join
from slowtide.operators.chunked import forward_fill_rows
from slowtide.operators.series import bounds, bucket_aggregate, spine
from slowtide.functions import clock
from slowtide.session import durable
from slowtide.sources.testdata import host_samples, requests, table


def _asof_sql(choice: str, tolerance_us: int | None, by_site: bool = False) -> str:
    """Backward and forward matches side by side, then the choice of one of them."""
    on = "r.site = h.site AND " if by_site else ""
    limit = "" if tolerance_us is None else f" AND distance <= {tolerance_us}"
    pick = {
        "backward": "back_us",
        "forward": "ahead_us",
        "nearest": "CASE WHEN ahead_us IS NULL OR back_us <= ahead_us THEN back_us ELSE ahead_us END",
    }[choice]
    is_back = {"backward": "TRUE", "forward": "FALSE", "nearest": "(ahead_us IS NULL OR back_us <= ahead_us)"}[choice]
    return f"""
        WITH b AS (SELECT r.event_id, r."timestamp", epoch_us(r."timestamp") - epoch_us(h."timestamp") AS back_us,
                          h.sample_id, h.cpu_percent, h.ram_percent
                   FROM requests r ASOF LEFT JOIN host_samples h ON {on}r."timestamp" >= h."timestamp"),
             a AS (SELECT r.event_id, epoch_us(h."timestamp") - epoch_us(r."timestamp") AS ahead_us,
                          h.sample_id, h.cpu_percent, h.ram_percent
                   FROM requests r ASOF LEFT JOIN host_samples h ON {on}r."timestamp" <= h."timestamp"),
             p AS (SELECT event_id, b."timestamp", {pick} AS distance, {is_back} AS is_back,
                          b.sample_id AS bs, b.cpu_percent AS bc, b.ram_percent AS br,
                          a.sample_id AS fs, a.cpu_percent AS fc, a.ram_percent AS fr
                   FROM b JOIN a USING (event_id))
        SELECT event_id, "timestamp",
               CASE WHEN distance IS NOT NULL{limit} THEN CASE WHEN is_back THEN bs ELSE fs END END AS sample_id,
               CASE WHEN distance IS NOT NULL{limit} THEN CASE WHEN is_back THEN bc ELSE fc END END AS cpu_percent,
               CASE WHEN distance IS NOT NULL{limit} THEN CASE WHEN is_back THEN br ELSE fr END END AS ram_percent
        FROM p"""


def _asof(spark: SparkSession, sf: str, by: tuple[str, ...] = (), **options) -> DataFrame:
    samples = host_samples(spark, sf)
    right = samples if by else samples.drop("site")
    left = requests(spark, sf).select("event_id", "timestamp", *by)
    return asof_join(left, right, "timestamp", by=by, tie=["sample_id"], **options).select(
        "event_id", "timestamp", "sample_id", "cpu_percent", "ram_percent"
    )


@query("jn1_asof_nearest_5s", _asof_sql("nearest", 5_000_000))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _asof(spark, sf, tolerance=timedelta(seconds=5))


@query("jn1_asof_nearest_300s", _asof_sql("nearest", 300_000_000))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _asof(spark, sf, tolerance=timedelta(seconds=300))


@query("jn2_asof_nearest", _asof_sql("nearest", None))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _asof(spark, sf)


@query("jn2_asof_nearest_by_site", _asof_sql("nearest", None, by_site=True))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _asof(spark, sf, by=("site",))


@query("jn3_asof_backward_30s", _asof_sql("backward", 30_000_000))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _asof(spark, sf, direction="backward", tolerance=timedelta(seconds=30))


@query("jn3_asof_forward_30s", _asof_sql("forward", 30_000_000))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _asof(spark, sf, direction="forward", tolerance=timedelta(seconds=30))


@query(
    "jn2_asof_many_equal_times",
    """WITH item AS (SELECT l_shipdate AS t, l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem),
            lasts AS (SELECT * FROM item QUALIFY row_number() OVER (PARTITION BY t ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC) = 1),
            firsts AS (SELECT * FROM item QUALIFY row_number() OVER (PARTITION BY t ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) = 1),
            b AS (SELECT o.o_orderkey, o.o_orderdate, epoch_us(o.o_orderdate) - epoch_us(i.t) AS back_us, i.l_orderkey, i.l_linenumber, i.l_quantity
                  FROM orders o ASOF LEFT JOIN lasts i ON o.o_orderdate >= i.t),
            a AS (SELECT o.o_orderkey, epoch_us(i.t) - epoch_us(o.o_orderdate) AS ahead_us, i.l_orderkey, i.l_linenumber, i.l_quantity
                  FROM orders o ASOF LEFT JOIN firsts i ON o.o_orderdate <= i.t)
       SELECT o_orderkey, o_orderdate AS "timestamp",
              CASE WHEN a.ahead_us IS NULL OR b.back_us <= a.ahead_us THEN b.l_orderkey ELSE a.l_orderkey END AS l_orderkey,
              CASE WHEN a.ahead_us IS NULL OR b.back_us <= a.ahead_us THEN b.l_linenumber ELSE a.l_linenumber END AS l_linenumber,
              CASE WHEN a.ahead_us IS NULL OR b.back_us <= a.ahead_us THEN b.l_quantity ELSE a.l_quantity END AS l_quantity
       FROM b JOIN a USING (o_orderkey)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("timestamp"))
    items = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("timestamp"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    return asof_join(orders, items, "timestamp").drop("l_partkey")


@query(
    "jn2_merged_host_log",
    """WITH b AS (SELECT r.event_id, r."timestamp", r.response_time, epoch_us(r."timestamp") - epoch_us(h."timestamp") AS back_us, h.cpu_percent, h.ram_percent
                  FROM requests r ASOF LEFT JOIN host_samples h ON r."timestamp" >= h."timestamp"),
            a AS (SELECT r.event_id, epoch_us(h."timestamp") - epoch_us(r."timestamp") AS ahead_us, h.cpu_percent, h.ram_percent
                  FROM requests r ASOF LEFT JOIN host_samples h ON r."timestamp" <= h."timestamp")
       SELECT event_id, "timestamp" AS datetime, CAST(response_time AS FLOAT) AS response_time,
              CAST(CASE WHEN ahead_us IS NULL OR back_us <= ahead_us THEN b.cpu_percent ELSE a.cpu_percent END AS FLOAT) AS "CPU",
              CAST(CASE WHEN ahead_us IS NULL OR back_us <= ahead_us THEN b.ram_percent ELSE a.ram_percent END AS FLOAT) AS "RAM"
       FROM b JOIN a USING (event_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The offline merge: date and time text to a time, single precision, nearest sample."""
    from slowtide.operators.columns import halve_precision

    log = requests(spark, sf).select(
        "event_id",
        clock.from_date_and_time(
            F.date_format("timestamp", "yyyy-MM-dd"), F.date_format("timestamp", "HH:mm:ss.SSSSSS")
        ).alias("datetime"),
        "response_time",
    )
    export = host_samples(spark, sf).select(
        F.col("timestamp").alias("Date"), F.col("cpu_percent").alias("CPU"), F.col("ram_percent").alias("RAM")
    )
    samples = halve_precision(export.dropna().withColumnRenamed("Date", "datetime"))
    return asof_join(halve_precision(log.dropna()), samples, "datetime")


@query(
    "wn9_fill_merged_requests",
    """WITH h AS (SELECT "timestamp", CASE WHEN sample_id % 3 <> 0 THEN cpu_percent END AS c, CASE WHEN sample_id % 4 <> 0 THEN ram_percent END AS m FROM host_samples),
            b AS (SELECT r.event_id, r."timestamp", r.response_time, epoch_us(r."timestamp") - epoch_us(h."timestamp") AS back_us, h.c, h.m
                  FROM requests r ASOF LEFT JOIN h ON r."timestamp" >= h."timestamp"),
            a AS (SELECT r.event_id, epoch_us(h."timestamp") - epoch_us(r."timestamp") AS ahead_us, h.c, h.m
                  FROM requests r ASOF LEFT JOIN h ON r."timestamp" <= h."timestamp"),
            j AS (SELECT event_id, "timestamp", response_time,
                         CASE WHEN ahead_us IS NULL OR back_us <= ahead_us THEN b.c ELSE a.c END AS c,
                         CASE WHEN ahead_us IS NULL OR back_us <= ahead_us THEN b.m ELSE a.m END AS m
                  FROM b JOIN a USING (event_id))
       SELECT event_id, "timestamp", response_time, last_value(c IGNORE NULLS) OVER w AS "CPU", last_value(m IGNORE NULLS) OVER w AS "RAM"
       FROM j WINDOW w AS (ORDER BY "timestamp", event_id ROWS UNBOUNDED PRECEDING)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Requests with the nearest sample, some of whose readings are missing, then filled from the request before."""
    samples = host_samples(spark, sf).select(
        "timestamp",
        F.when(F.col("sample_id") % 3 != 0, F.col("cpu_percent")).alias("CPU"),
        F.when(F.col("sample_id") % 4 != 0, F.col("ram_percent")).alias("RAM"),
    )
    merged = asof_join(requests(spark, sf).select("event_id", "timestamp", "response_time"), samples, "timestamp")
    return forward_fill_rows(durable(merged), ["CPU", "RAM"], "timestamp", "event_id")


@query("jn4_spine_join", "SELECT bucket_id, bucket, CASE WHEN \"Delay_Detected\" IS NULL THEN 1 ELSE 0 END AS is_gap FROM series")
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = requests(spark, sf)
    buckets = bucket_aggregate(log, {"seen": ("max", F.lit(1))}, 300)
    limits = bounds(log.select(clock.bucket_of(F.col("timestamp"), 300).alias("bucket_id")))
    return spine(limits).join(buckets, "bucket_id", "left").select(
        "bucket_id",
        clock.bucket_start(F.col("bucket_id"), 300).alias("bucket"),
        F.col("seen").isNull().cast("int").alias("is_gap"),
    )
