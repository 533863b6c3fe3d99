"""Sources and sinks: what is written must read back the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.catalog.registry import now, query, rounded
from slowtide.functions import flags
from slowtide.operators import evaluation
from slowtide.operators.slices import split_holdout
from slowtide.plans.features import feature_series
from slowtide.plans.monitoring import health_report
from slowtide.session import durable, fresh_folder
from slowtide.sources import readers, writers
from slowtide.sources.testdata import requests, scored

CONTRACT = schemas.REQUEST_LOG.names
_CONTRACT_SQL = """SELECT event_id, "timestamp", response_time, "CPU", "RAM", status_code, is_error, site FROM requests"""


@query("src1_snk1_csv_round_trip", _CONTRACT_SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "csv")
    writers.write_csv(requests(spark, sf).select(*CONTRACT), path)
    return readers.read_csv(spark, path, schemas.REQUEST_LOG)


@query(
    "src2_recent_window",
    """SELECT "timestamp" AS datetime, response_time AS time_taken, "CPU", "RAM", status_code AS sc_status, is_error
       FROM requests WHERE "timestamp" >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return readers.recent_window(sql_rows(spark, sf), now(), 24)


def sql_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Requests under the column names of the database table."""
    names = {new: old for old, new in schemas.SQL_SOURCE_TO_COMMON.items()}
    return requests(spark, sf).withColumnsRenamed(names)


@query(
    "src3_source_switch",
    """SELECT kind, count(*) AS n, round(sum(response_time), 2) AS total_ms, count("CPU") AS with_cpu, max("timestamp") AS newest
       FROM requests, (VALUES ('csv'), ('parquet')) AS kinds(kind) GROUP BY kind""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = requests(spark, sf).select(*CONTRACT)
    paths = {kind: fresh_folder(spark, kind) for kind in ("csv", "parquet")}
    writers.write_csv(log, paths["csv"])
    writers.write_parquet(log, paths["parquet"])
    parts = [
        readers.load(spark, kind, {"path": path})
        .groupBy(F.lit(kind).alias("kind"))
        .agg(
            F.count("*").alias("n"),
            F.round(F.sum("response_time"), 2).alias("total_ms"),
            F.count("CPU").alias("with_cpu"),
            F.max("timestamp").alias("newest"),
        )
        for kind, path in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "snk2_append_predictions",
    """SELECT "timestamp", predicted_label AS prediction, probability,
              CASE WHEN abs(probability - 0.5) > 0.3 THEN 'High' WHEN abs(probability - 0.5) > 0.1 THEN 'Medium' ELSE 'Low' END AS confidence
       FROM scored""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "predictions")
    log = prediction_log(spark, sf)
    # The last run is repeated and replaces its own rows.
    for label in (0, 1, 1):
        writers.append_predictions(log.where(F.col("prediction") == label), path, f"label {label}")
    return writers.read_predictions(spark, path)


def prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select(
        "timestamp",
        F.col("predicted_label").alias("prediction"),
        "probability",
        flags.confidence_label(F.col("probability")).alias("confidence"),
    )


@query(
    "snk3_split_sink",
    """SELECT bucket, CASE WHEN bucket_id > (SELECT max(bucket_id) - 5 FROM features) THEN 'holdout' ELSE 'train' END AS part,
              round("CPU", 6) AS "CPU", round("RAM", 6) AS "RAM", target FROM features""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    train, held = fresh_folder(spark, "train"), fresh_folder(spark, "holdout")
    writers.write_split(durable(split_holdout(feature_series(requests(spark, sf)), schemas.HOLDOUT_BUCKETS)), train, held)
    back = spark.read.parquet(train).withColumn("part", F.lit("train")).unionByName(
        spark.read.parquet(held).withColumn("part", F.lit("holdout"))
    )
    return rounded(back.select("bucket", "part", "CPU", "RAM", "target"))


@query(
    "snk4_report_json",
    """SELECT 'CRITICAL' AS overall_status, count(*) AS records, '2024-01-31' AS monitoring_date,
              count(*) FILTER ("timestamp" >= TIMESTAMP '2024-01-30 00:00:00') AS recent_predictions
       FROM requests""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "report")
    # A report taken without any recorded run: the missing model makes it critical.
    empty_runs = scored(spark, sf).where(F.lit(False)).select(F.col("timestamp").alias("run_ts"))
    report = health_report(requests(spark, sf), prediction_log(spark, sf), empty_runs, now())
    writers.append_report(report, path, now())
    back = spark.read.schema(
        "overall_status string, records bigint, recent_predictions bigint, monitoring_date string"
    ).json(path)
    return back.select("overall_status", "records", "monitoring_date", "recent_predictions")


@query(
    "snk5_run_sidecars",
    """WITH c AS (SELECT probability AS t, count(*) AS n, sum(true_label) AS pos FROM scored GROUP BY 1),
            r AS (SELECT t, sum(pos) OVER w AS tp, sum(n) OVER w AS predicted, sum(pos) OVER () AS positives FROM c
                  WINDOW w AS (ORDER BY t DESC ROWS UNBOUNDED PRECEDING)),
            f AS (SELECT t, 2 * (tp / predicted) * (tp / positives) / (tp / predicted + tp / positives + 1e-12) AS f1 FROM r)
       SELECT t AS threshold, 'CPU,RAM,response_time,cpu_rolling_mean,ram_rolling_mean,response_rolling_mean,high_cpu,high_ram,is_peak_hour' AS features
       FROM f ORDER BY round(f1, 12) DESC, t LIMIT 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from slowtide.operators import runs

    path = fresh_folder(spark, "runs")
    best = evaluation.best_threshold(evaluation.pr_curve(scored(spark, sf)))
    row = runs.run_rows(
        best,
        F.lit("run-1"),
        now(),
        {"features": F.lit(",".join(schemas.FEATURES))},
        {"best_f1_threshold": F.col("best_f1_threshold")},
    )
    runs.log_run(spark, path, row)
    return runs.read_runs(spark, path).select(
        F.col("metrics")["best_f1_threshold"].alias("threshold"), F.col("params")["features"].alias("features")
    )
