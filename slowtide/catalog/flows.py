"""Whole jobs, from raw logs to their stored result."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.catalog.registry import now, plain, query
from slowtide.functions import clock
from slowtide.operators import runs
from slowtide.plans import jobs
from slowtide.session import durable, fresh_folder
from slowtide.sources import writers
from slowtide.sources.testdata import host_samples, requests, server_log


@query(
    "flow_merge_server_log",
    """WITH l AS (SELECT *, strptime(log_date || ' ' || log_time, '%Y-%m-%d %H:%M:%S') + INTERVAL 330 MINUTE AS t FROM server_log),
            lk AS (SELECT * FROM l WHERE day(t) <> 24),
            h AS (SELECT * REPLACE ("timestamp" + INTERVAL 330 MINUTE AS "timestamp") FROM host_samples),
            hk AS (SELECT * FROM h WHERE day("timestamp") <> 24),
            b AS (SELECT lk.*, epoch_us(lk.t) - epoch_us(hk."timestamp") AS back_us, hk.cpu_percent, hk.ram_percent
                  FROM lk ASOF LEFT JOIN hk ON lk.t >= hk."timestamp"),
            a AS (SELECT lk.event_id, epoch_us(hk."timestamp") - epoch_us(lk.t) AS ahead_us, hk.cpu_percent, hk.ram_percent
                  FROM lk ASOF LEFT JOIN hk ON lk.t <= hk."timestamp"),
            j AS (SELECT b.*, CASE WHEN ahead_us IS NULL OR back_us <= ahead_us THEN back_us ELSE ahead_us END AS distance,
                         CASE WHEN ahead_us IS NULL OR back_us <= ahead_us THEN b.cpu_percent ELSE a.cpu_percent END AS c,
                         CASE WHEN ahead_us IS NULL OR back_us <= ahead_us THEN b.ram_percent ELSE a.ram_percent END AS r
                  FROM b JOIN a USING (event_id))
       SELECT event_id, strftime(t, '%Y-%m-%d') AS date, strftime(t, '%H:%M:%S') AS time, server_ip, method, url, site, client_ip, status_code, response_time,
              t AS "timestamp", CAST(hour(t) AS INTEGER) AS hour, CAST(isodow(t) - 1 AS INTEGER) AS day_of_week,
              CAST(length(url) - length(replace(url, '/', '')) AS INTEGER) AS request_path_depth, split_part(url, '/', -1) AS endpoint_base, 'api' AS service,
              CASE WHEN status_code >= 400 THEN 1 ELSE 0 END AS is_error, CASE WHEN status_code >= 200 AND status_code < 400 THEN 1 ELSE 0 END AS is_success,
              CASE WHEN hour(t) >= 9 AND hour(t) < 18 THEN 1 ELSE 0 END AS is_peak_hour,
              CASE WHEN distance <= 300000000 THEN c END AS "CPU", CASE WHEN distance <= 300000000 THEN r END AS "RAM" FROM j""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    samples = host_samples(spark, sf).select(
        clock.shift_zone(F.col("timestamp")).alias("timestamp"), "cpu_percent", "ram_percent"
    )
    return plain(jobs.merge_server_log(server_log(spark, sf), samples, timedelta(seconds=300), extra=("event_id",)))


@query("flow_train_predict_monitor")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Train, predict and monitor over one folder; a row per job with its status."""
    folder = fresh_folder(spark, "jobs")
    raw = requests(spark, sf)
    statuses = [("train", jobs.train_job(spark, raw, folder, now()))]
    if statuses[0][1].startswith("training_success"):
        statuses.append(("predict", jobs.predict_job(spark, raw, folder, now())))
        log = writers.read_predictions(spark, f"{folder}/predictions")
        statuses.append(("monitor", jobs.monitor_job(raw, log, runs.read_runs(spark, folder), folder, now())))
    return spark.createDataFrame(statuses, "job string, status string")
