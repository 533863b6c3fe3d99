"""Registration of queries, and the SQL text shared by their checks."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.functions import clock

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NOW_TEXT = "2024-01-31 00:00:00"


def now() -> Column:
    return clock.instant(NOW_TEXT)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the views below, which are put in front of it."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as the order of additions differs between engines."""
    new = {c: F.round(c, digits) for c, t in df.dtypes if t == "double"}
    return df.withColumns(new) if new else df


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, which every client shows alike."""
    new = {c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"}
    return df.withColumns(new) if new else df


# Each view may use the ones above it.
VIEWS: dict[str, str] = {
    "ev": """SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events""",
    "requests": """
        SELECT event_id, user_id, ts AS "timestamp", value * 40 AS response_time,
               CASE WHEN event_id % 11 <> 0 THEN CAST(k AS DOUBLE) END AS "CPU",
               CASE WHEN event_id % 7 <> 0 THEN CAST(100 - k AS DOUBLE) END AS "RAM",
               CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 WHEN 'click' THEN 302
                               WHEN 'purchase' THEN 201 WHEN 'view' THEN 200 END AS status_code,
               CASE WHEN event_type IN ('error', 'signup') THEN 1 ELSE 0 END AS is_error,
               'site_' || (user_id % 5) AS site,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
               '/api/' || event_type || '/' || k AS url,
               '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS client_ip
        FROM ev""",
    "host_samples": """
        SELECT event_id AS sample_id, ts AS "timestamp", CAST(k AS DOUBLE) AS cpu_percent,
               CAST(100 - k AS DOUBLE) AS ram_percent, 'site_' || (user_id % 5) AS site
        FROM ev WHERE event_type = 'view'""",
    "server_log": """
        SELECT event_id, strftime("timestamp", '%Y-%m-%d') AS log_date, strftime("timestamp", '%H:%M:%S') AS log_time,
               '192.168.0.' || (user_id % 5) AS server_ip, method, url, site, client_ip, status_code,
               response_time, "timestamp"
        FROM requests""",
    "w3c_log": """
        SELECT o_orderkey AS log_id, CASE WHEN o_orderstatus = 'F' THEN 'POST' ELSE 'GET' END AS cs_method,
               '/orders/' || o_orderstatus || '/' || o_orderkey AS cs_uri_stem,
               '192.168.10.' || (o_custkey % 5) AS s_ip, 443 AS s_port, '10.1.' || (o_custkey % 256) AS c_ip,
               CASE o_orderpriority[1] WHEN '1' THEN 200 WHEN '2' THEN 302 WHEN '3' THEN 404
                                       WHEN '4' THEN 500 WHEN '5' THEN 201 END AS sc_status,
               0 AS sc_substatus, 0 AS sc_win32_status, o_totalprice / 100 AS time_taken, o_orderdate AS datetime
        FROM orders""",
    "scored": """
        SELECT event_id, user_id, ts AS "timestamp", CASE WHEN value > 50 THEN 1 ELSE 0 END AS true_label,
               k / 100.0::DOUBLE AS probability, CASE WHEN k / 100.0::DOUBLE > 0.5 THEN 1 ELSE 0 END AS predicted_label
        FROM ev""",
    "urls": "SELECT page_id, CASE WHEN page_id % 10 <> 0 THEN url END AS url FROM pages",
    "enriched": """
        SELECT *, CASE WHEN response_time > 2000 THEN 1 ELSE 0 END AS "Delay_Detected",
               strftime("timestamp", '%Y-%m-%d') AS date, strftime("timestamp", '%H:%M:%S') AS time,
               CAST(hour("timestamp") AS INTEGER) AS hour, CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
               CAST(length(coalesce(url, '')) - length(replace(coalesce(url, ''), '/', '')) AS INTEGER) AS request_path_depth,
               split_part(coalesce(url, ''), '/', -1) AS endpoint_base, 'api' AS service,
               CASE WHEN status_code >= 200 AND status_code < 400 THEN 1 ELSE 0 END AS is_success,
               CASE WHEN hour("timestamp") >= 9 AND hour("timestamp") < 18 THEN 1 ELSE 0 END AS is_peak_hour
        FROM requests""",
    "w3c_enriched": """
        SELECT *, strftime("timestamp", '%Y-%m-%d') AS date, strftime("timestamp", '%H:%M:%S') AS time,
               CAST(hour("timestamp") AS INTEGER) AS hour, CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
               CAST(length(url) - length(replace(url, '/', '')) AS INTEGER) AS request_path_depth,
               split_part(url, '/', -1) AS endpoint_base, 'w3c' AS service,
               CASE WHEN response_time > 2000 THEN 1 ELSE 0 END AS "Delay_Detected",
               CASE WHEN status_code >= 400 THEN 1 ELSE 0 END AS is_error,
               CASE WHEN status_code >= 200 AND status_code < 400 THEN 1 ELSE 0 END AS is_success,
               CASE WHEN hour("timestamp") >= 9 AND hour("timestamp") < 18 THEN 1 ELSE 0 END AS is_peak_hour,
               CAST(NULL AS DOUBLE) AS "CPU", CAST(NULL AS DOUBLE) AS "RAM"
        FROM (SELECT log_id, cs_method AS method, cs_uri_stem AS url, s_ip AS site, c_ip AS client_ip, s_port,
                     sc_status AS status_code, sc_substatus, sc_win32_status, time_taken AS response_time,
                     datetime AS "timestamp" FROM w3c_log)""",
    "series": """
        SELECT bucket_id, make_timestamp(bucket_id * 300000000) AS bucket, "Delay_Detected", response_time, "CPU", "RAM", is_error
        FROM (SELECT unnest(generate_series(min(epoch_us("timestamp") // 300000000), max(epoch_us("timestamp") // 300000000))) AS bucket_id
              FROM requests)
        LEFT JOIN (SELECT epoch_us("timestamp") // 300000000 AS bucket_id,
                          max(CASE WHEN response_time > 2000 THEN 1 ELSE 0 END) AS "Delay_Detected",
                          avg(response_time) AS response_time, avg("CPU") AS "CPU", avg("RAM") AS "RAM", max(is_error) AS is_error
                   FROM requests GROUP BY 1) USING (bucket_id)""",
    "counts5": """
        SELECT bucket_id, make_timestamp(bucket_id * 300000000) AS bucket,
               CAST(coalesce("Delay_Detected", 0) AS BIGINT) AS "Delay_Detected", response_time, "CPU", "RAM", status_code,
               CAST(coalesce(is_error, 0) AS BIGINT) AS is_error
        FROM (SELECT unnest(generate_series(min(epoch_us("timestamp") // 300000000), max(epoch_us("timestamp") // 300000000))) AS bucket_id
              FROM requests)
        LEFT JOIN (SELECT epoch_us("timestamp") // 300000000 AS bucket_id,
                          sum(CASE WHEN response_time > 2000 THEN 1 ELSE 0 END) AS "Delay_Detected",
                          avg(response_time) AS response_time, avg("CPU") AS "CPU", avg("RAM") AS "RAM",
                          avg(status_code) AS status_code, sum(is_error) AS is_error
                   FROM requests GROUP BY 1) USING (bucket_id)""",
    "counts10": """
        SELECT bucket_id, make_timestamp(bucket_id * 600000000) AS bucket,
               CAST(coalesce("Delay_Detected", 0) AS BIGINT) AS "Delay_Detected", response_time, "CPU", "RAM", status_code,
               CAST(coalesce(is_error, 0) AS BIGINT) AS is_error
        FROM (SELECT unnest(generate_series(min(epoch_us("timestamp") // 600000000), max(epoch_us("timestamp") // 600000000))) AS bucket_id
              FROM requests)
        LEFT JOIN (SELECT epoch_us("timestamp") // 600000000 AS bucket_id,
                          sum(CASE WHEN response_time > 2000 THEN 1 ELSE 0 END) AS "Delay_Detected",
                          avg(response_time) AS response_time, avg("CPU") AS "CPU", avg("RAM") AS "RAM",
                          avg(status_code) AS status_code, sum(is_error) AS is_error
                   FROM requests GROUP BY 1) USING (bucket_id)""",
    "filled": """
        SELECT bucket_id, bucket, coalesce("Delay_Detected", 0) AS "Delay_Detected", coalesce(response_time, 0) AS response_time,
               coalesce("CPU", 0) AS "CPU",
               coalesce(last_value("RAM" IGNORE NULLS) OVER (ORDER BY bucket_id ROWS UNBOUNDED PRECEDING),
                        (SELECT quantile_cont("RAM", 0.5) FROM series)) AS "RAM",
               coalesce(is_error, 0) AS is_error
        FROM series""",
    "features": """
        SELECT *, CAST(hour(bucket) AS INTEGER) AS hour, CAST(isodow(bucket) - 1 AS INTEGER) AS day_of_week,
               CASE WHEN isodow(bucket) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN hour(bucket) >= 9 AND hour(bucket) < 18 THEN 1 ELSE 0 END AS is_peak_hour,
               avg("CPU") OVER w6 AS cpu_rolling_mean, stddev_samp("CPU") OVER w6 AS cpu_rolling_std,
               avg("RAM") OVER w6 AS ram_rolling_mean, avg(response_time) OVER w6 AS response_rolling_mean,
               CASE WHEN round("CPU", 9) > (SELECT round(quantile_cont("CPU", 0.8), 9) FROM filled) THEN 1 ELSE 0 END AS high_cpu,
               CASE WHEN round("RAM", 9) > (SELECT round(quantile_cont("RAM", 0.8), 9) FROM filled) THEN 1 ELSE 0 END AS high_ram,
               CASE WHEN is_error > 0 THEN 1 ELSE 0 END AS high_error_period,
               lead("Delay_Detected", 1) OVER (ORDER BY bucket_id) AS future_delay,
               coalesce(lead("Delay_Detected", 1) OVER (ORDER BY bucket_id), 0) AS target
        FROM filled WINDOW w6 AS (ORDER BY bucket_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    "train_part": "SELECT * FROM features WHERE bucket_id <= (SELECT max(bucket_id) - 5 FROM features)",
}


def with_views(sql: str) -> str:
    """Put the views that ``sql`` names, and those they name, in front of it."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name, body in VIEWS.items():
            if name not in needed and _mentions(text, name):
                needed.add(name)
                pending.append(body)
    if not needed:
        return sql
    views = ",\n".join(f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed)
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {views},\n{text[5:]}"
    return f"WITH {views}\n{text}"


def _mentions(text: str, name: str) -> bool:


    return re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text, re.IGNORECASE) is not None
