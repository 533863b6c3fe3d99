"""Projection, renaming, casting and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.catalog.registry import now, plain, query, rounded
from slowtide.functions import clock
from slowtide.operators import columns, evaluation
from slowtide.plans.features import enrich
from slowtide.sources.testdata import host_samples, requests, scored, server_log, w3c_log


@query("prj1_drop_columns", "SELECT * EXCLUDE (url, client_ip, method) FROM requests")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return requests(spark, sf).drop("url", "client_ip", "method")


@query(
    "prj2_rename_site_map",
    """SELECT log_id, cs_method AS method, cs_uri_stem AS url, s_ip AS site, s_port, c_ip AS client_ip, sc_status AS status_code,
              sc_substatus, sc_win32_status, time_taken AS response_time, datetime AS "timestamp" FROM w3c_log""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return w3c_log(spark, sf).withColumnsRenamed(schemas.W3C_TO_SITE)


@query(
    "prj2_rename_server_map",
    """SELECT log_id, cs_method AS method, cs_uri_stem AS url, s_ip AS server_ip, s_port AS port, c_ip AS client_ip,
              sc_status AS status_code, sc_substatus AS sub_status, sc_win32_status AS win32_status,
              time_taken AS response_time, datetime AS "timestamp" FROM w3c_log""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return w3c_log(spark, sf).withColumnsRenamed(schemas.W3C_TO_SERVER)


@query(
    "prj2_rename_host_map",
    """SELECT sample_id, "timestamp" AS datetime, cpu_percent AS "CPU", ram_percent AS "RAM" FROM host_samples""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    export = host_samples(spark, sf).drop("site").withColumnRenamed("timestamp", "Date")
    return export.withColumnsRenamed({**schemas.HOST_TO_COMMON, **schemas.HOST_EXPORT_TO_COMMON})


@query(
    "prj3_select_existing",
    """SELECT date, time, method, url, site, client_ip, status_code, response_time, "timestamp", hour, day_of_week,
              request_path_depth, endpoint_base, service, is_error, is_success, is_peak_hour, "CPU", "RAM" FROM enriched""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(columns.keep_present(enrich(requests(spark, sf)), schemas.FINAL_COLUMNS))


@query(
    "prj4_select_strict",
    """SELECT date, time, method, url, site, client_ip, status_code, response_time, "timestamp", hour, day_of_week,
              request_path_depth, endpoint_base, service, is_error, is_success, is_peak_hour, "CPU", "RAM" FROM enriched""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(columns.keep_strict(enrich(requests(spark, sf)), schemas.COMMON_COLUMNS))


@query(
    "prj5_add_missing_columns",
    """SELECT event_id, log_date, log_time, server_ip, method, url, site, client_ip, status_code, response_time, "timestamp",
              CAST(NULL AS DOUBLE) AS "CPU", CAST(NULL AS DOUBLE) AS "RAM", CAST(NULL AS INTEGER) AS is_error FROM server_log""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    wanted = {"method": "string", "CPU": "double", "RAM": "double", "is_error": "int"}
    return columns.add_missing(server_log(spark, sf), wanted)


@query(
    "prj6_constant_tags",
    """SELECT event_id, 'api' AS service, 'unknown' AS origin FROM requests""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return requests(spark, sf).select("event_id", F.lit("api").alias("service"), F.lit("unknown").alias("origin"))


@query(
    "prj7_single_precision",
    """SELECT event_id, CAST(response_time AS FLOAT) AS response_time, CAST("CPU" AS FLOAT) AS "CPU", CAST("RAM" AS FLOAT) AS "RAM",
              status_code FROM requests""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return columns.halve_precision(requests(spark, sf).select("event_id", "response_time", "CPU", "RAM", "status_code"))


@query(
    "prj8_parse_timestamp_safe",
    """SELECT event_id, TRY_CAST(CASE WHEN event_id % 13 = 0 THEN 'n/a ' || log_time ELSE log_date || ' ' || log_time END AS TIMESTAMP) AS "timestamp"
       FROM server_log""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_id") % 13 == 0, F.concat_ws(" ", F.lit("n/a"), "log_time")).otherwise(
        F.concat_ws(" ", "log_date", "log_time")
    )
    return server_log(spark, sf).select("event_id", clock.parse_timestamp(text).alias("timestamp"))


@query(
    "prj8_parse_timestamp_strict",
    """SELECT event_id, CAST(log_date || ' ' || log_time AS TIMESTAMP) AS "timestamp" FROM server_log""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat_ws(" ", "log_date", "log_time")
    return server_log(spark, sf).select("event_id", clock.parse_timestamp(text, strict=True).alias("timestamp"))


@query(
    "flt1_drop_day_of_month",
    """SELECT 'request' AS side, event_id AS id, "timestamp" FROM requests WHERE day("timestamp") <> 24
       UNION ALL SELECT 'sample', sample_id, "timestamp" FROM host_samples WHERE day("timestamp") <> 24""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    left = columns.without_day(requests(spark, sf), 24).select(F.lit("request").alias("side"), F.col("event_id").alias("id"), "timestamp")
    right = columns.without_day(host_samples(spark, sf), 24).select(F.lit("sample").alias("side"), F.col("sample_id").alias("id"), "timestamp")
    return left.unionByName(right)


@query(
    "flt2_since_latest_3h",
    """SELECT event_id, "timestamp", response_time FROM requests WHERE "timestamp" >= (SELECT max("timestamp") FROM requests) - INTERVAL 3 HOUR""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return columns.since_latest(requests(spark, sf).select("event_id", "timestamp", "response_time"), 3)


@query(
    "flt2_since_latest_2h",
    """SELECT event_id, "timestamp", response_time FROM requests WHERE "timestamp" >= (SELECT max("timestamp") FROM requests) - INTERVAL 2 HOUR""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return columns.since_latest(requests(spark, sf).select("event_id", "timestamp", "response_time"), 2)


@query(
    "flt3_since_now",
    """SELECT 24 AS hours, event_id, "timestamp" FROM scored WHERE "timestamp" >= TIMESTAMP '2024-01-30 00:00:00'
       UNION ALL SELECT 1, event_id, "timestamp" FROM scored WHERE "timestamp" >= TIMESTAMP '2024-01-30 23:00:00'""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = scored(spark, sf).select("event_id", "timestamp")
    parts = [columns.since(log, now(), h).select(F.lit(h).alias("hours"), "event_id", "timestamp") for h in (24, 1)]
    return parts[0].unionByName(parts[1])


@query("flt4_null_rows", """SELECT event_id, "timestamp", "RAM" FROM requests WHERE "CPU" IS NULL""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return columns.where_null(requests(spark, sf), "CPU").select("event_id", "timestamp", "RAM")


@query(
    "flt5_drop_nulls",
    """SELECT 'any' AS rule, event_id FROM requests WHERE "CPU" IS NOT NULL AND "RAM" IS NOT NULL
       UNION ALL SELECT 'CPU only', event_id FROM requests WHERE "CPU" IS NOT NULL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = requests(spark, sf)
    strict = log.dropna().select(F.lit("any").alias("rule"), "event_id")
    return strict.unionByName(log.dropna(subset=["CPU"]).select(F.lit("CPU only").alias("rule"), "event_id"))


@query(
    "flt6_class_and_range_slices",
    """SELECT true_label, count(*) AS n, round(avg(probability), 6) AS mean_probability,
              count(*) FILTER (probability >= 0.4 AND probability < 0.6) AS undecided FROM scored GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.class_slice(scored(spark, sf)))
