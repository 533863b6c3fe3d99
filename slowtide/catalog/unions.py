"""Stacking of the two request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.catalog.registry import plain, query
from slowtide.operators import columns, unions
from slowtide.plans.features import enrich, flag_delays
from slowtide.sources.testdata import requests, server_log, w3c_log

_COMMON = """date, time, method, url, site, client_ip, status_code, response_time, "timestamp", hour, day_of_week,
             request_path_depth, endpoint_base, service, is_error, is_success, is_peak_hour, "CPU", "RAM\""""


def _w3c_common(spark: SparkSession, sf: str) -> DataFrame:
    renamed = w3c_log(spark, sf).withColumnsRenamed(schemas.W3C_TO_SITE)
    load = {"CPU": "double", "RAM": "double"}
    return columns.add_missing(enrich(renamed, service="w3c"), load)


@query("set1_union_same_schema", "SELECT event_id, response_time FROM requests UNION ALL SELECT log_id, time_taken FROM w3c_log")
def _(spark: SparkSession, sf: str) -> DataFrame:
    other = w3c_log(spark, sf).select(F.col("log_id").alias("event_id"), F.col("time_taken").alias("response_time"))
    return unions.union_same(requests(spark, sf).select("event_id", "response_time"), other)


@query("set2_union_strict_schema", f"SELECT {_COMMON} FROM w3c_enriched UNION ALL SELECT {_COMMON} FROM enriched")
def _(spark: SparkSession, sf: str) -> DataFrame:
    merged = unions.union_strict(_w3c_common(spark, sf), enrich(requests(spark, sf)), schemas.COMMON_COLUMNS)
    return plain(merged).orderBy("timestamp", "url")


@query(
    "set3_union_target_schema",
    """SELECT NULL::VARCHAR AS date, NULL::VARCHAR AS time, cs_method AS method, cs_uri_stem AS url, s_ip AS site, c_ip AS client_ip, sc_status AS status_code,
              time_taken AS response_time, TRY_CAST(CASE WHEN log_id % 17 = 0 THEN 'unknown' ELSE strftime(datetime, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS "timestamp",
              NULL::INTEGER AS hour, NULL::INTEGER AS day_of_week, NULL::INTEGER AS request_path_depth, NULL::VARCHAR AS endpoint_base,
              NULL::VARCHAR AS service, NULL::INTEGER AS is_error, NULL::INTEGER AS is_success, NULL::INTEGER AS is_peak_hour,
              NULL::DOUBLE AS "CPU", NULL::DOUBLE AS "RAM" FROM w3c_log
       UNION ALL
       SELECT NULL, NULL, method, url, site, client_ip, status_code, response_time, "timestamp", NULL, NULL, NULL, NULL, NULL, is_error, NULL, NULL, "CPU", "RAM" FROM requests""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("log_id") % 17 == 0, "unknown").otherwise(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    first = w3c_log(spark, sf).withColumn("datetime", text).withColumnsRenamed(schemas.W3C_TO_SITE)
    return plain(unions.union_on_schema(first, requests(spark, sf), schemas.COMMON_TYPES))


@query(
    "set4_union_all_columns",
    """SELECT log_id, cs_method AS method, cs_uri_stem AS url, s_port AS port, c_ip AS client_ip, sc_status AS status_code, sc_substatus AS sub_status,
              sc_win32_status AS win32_status, time_taken AS response_time, datetime AS "timestamp", s_ip AS server_ip,
              NULL::BIGINT AS event_id, NULL::VARCHAR AS log_date, NULL::VARCHAR AS log_time, NULL::VARCHAR AS site,
              CASE WHEN time_taken > 2000 THEN 1 ELSE 0 END AS "Delay_Detected" FROM w3c_log
       UNION ALL
       SELECT NULL, method, url, NULL, client_ip, status_code, NULL, NULL, response_time, "timestamp", server_ip, event_id, log_date, log_time, site,
              CASE WHEN response_time > 2000 THEN 1 ELSE 0 END FROM server_log""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    renamed = w3c_log(spark, sf).withColumnsRenamed(schemas.W3C_TO_SERVER)
    return flag_delays(unions.union_all_columns(renamed, server_log(spark, sf)))


@query(
    "set5_loose_union_with_tag",
    """SELECT 'unknown' AS site, cs_method AS method, status_code, response_time, datetime AS "timestamp", s_port, NULL::BIGINT AS event_id,
              NULL::DOUBLE AS "CPU" FROM (SELECT *, sc_status AS status_code, time_taken AS response_time FROM w3c_log)
       UNION ALL SELECT site, method, status_code, response_time, "timestamp", NULL, event_id, "CPU" FROM requests""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _tagged_union(spark, sf)[2]


def _tagged_union(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    first = (
        w3c_log(spark, sf)
        .select("cs_method", "sc_status", "time_taken", "datetime", "s_port")
        .withColumnsRenamed(schemas.W3C_SHORT)
        .withColumn("site", F.lit("unknown"))
    )
    second = requests(spark, sf).select("event_id", "method", "status_code", "response_time", "timestamp", "site", "CPU")
    return first, second, unions.union_all_columns(first, second)


@query(
    "set5_union_count_check",
    """SELECT (SELECT count(*) FROM orders) AS n_first, (SELECT count(*) FROM events) AS n_second,
              (SELECT count(*) FROM orders) + (SELECT count(*) FROM events) AS n_merged, 1 AS complete""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return unions.union_counts(*_tagged_union(spark, sf))


@query(
    "set6_missing_columns",
    """SELECT 'requests' AS source, count(*) AS n_rows, '' AS missing_columns FROM events
       UNION ALL SELECT 'orders', count(*), 'timestamp,response_time,CPU,RAM,is_error' FROM orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        df.groupBy()
        .agg(F.count("*").alias("n_rows"))
        .select(
            F.lit(name).alias("source"),
            "n_rows",
            F.lit(",".join(columns.missing(df, schemas.REQUIRED_TO_TRAIN))).alias("missing_columns"),
        )
        for name, df in (("requests", requests(spark, sf)), ("orders", w3c_log(spark, sf)))
    ]
    return parts[0].unionByName(parts[1])
