"""Table checks and the health report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.catalog.registry import now, query, rounded
from slowtide.catalog.scalars import DIRTY_SQL, dirty
from slowtide.catalog.slices import run_table
from slowtide.catalog.source_sink import prediction_log
from slowtide.operators import evaluation, quality
from slowtide.plans import features
from slowtide.plans.monitoring import health_report
from slowtide.sources.testdata import requests, scored

_NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def _validation(df: DataFrame, name: str) -> DataFrame:
    checked = quality.validate(df)
    shares = F.col("null_percentages")
    return checked.select(
        F.lit(name).alias("source"),
        "total_records",
        F.concat_ws("; ", "issues").alias("issues"),
        F.col("is_valid").cast("int").alias("is_valid"),
        *[F.round(shares[c], 6).alias(f"null_{c}") for c in ("CPU", "RAM", "response_time")],
    )


def _validation_sql(name: str, source: str, gone: str = "") -> str:
    missing = f"'{gone}'" if gone else "NULL"
    return f"""
        SELECT '{name}' AS source, n AS total_records, issues, CASE WHEN issues = '' THEN 1 ELSE 0 END AS is_valid,
               round(nc / n, 6) AS "null_CPU", round(nr / n, 6) AS "null_RAM", round(nt / n, 6) AS null_response_time
        FROM (SELECT *, concat_ws('; ', {missing}, CASE WHEN bc > 0 THEN 'Invalid CPU values: ' || bc || ' records' END,
                                  CASE WHEN br > 0 THEN 'Invalid RAM values: ' || br || ' records' END,
                                  CASE WHEN bt > 0 THEN 'Negative response times: ' || bt || ' records' END,
                                  CASE WHEN nc > n * 0.1::DOUBLE OR nr > n * 0.1::DOUBLE THEN 'High null percentage in: [' ||
                                       concat_ws(', ', CASE WHEN nc / n > 0.1 THEN '''CPU''' END, CASE WHEN nr / n > 0.1 THEN '''RAM''' END) || ']' END) AS issues
              FROM (SELECT count(*) AS n, count(*) FILTER ("CPU" < 0 OR "CPU" > 100) AS bc, count(*) FILTER ("RAM" < 0 OR "RAM" > 100) AS br,
                           count(*) FILTER (response_time < 0) AS bt, count(*) FILTER ("CPU" IS NULL) AS nc, count(*) FILTER ("RAM" IS NULL) AS nr,
                           count(*) FILTER (response_time IS NULL) AS nt FROM {source}))"""


@query(
    "qc1_validate",
    _validation_sql("requests", "requests") + " UNION ALL " + _validation_sql("dirty", DIRTY_SQL, "Missing columns: [''timestamp'']"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = requests(spark, sf).select(*schemas.REQUIRED_TO_TRAIN)
    return _validation(log, "requests").unionByName(_validation(dirty(spark, sf).drop("timestamp", "event_id"), "dirty"))


@query(
    "qc2_clean",
    f"""SELECT event_id, "timestamp", is_error, round(CASE WHEN "CPU" IS NULL THEN 0 ELSE least(greatest("CPU", 0), 100) END, 6) AS "CPU",
               round(least(greatest(coalesce("RAM", (SELECT quantile_cont("RAM", 0.5) FROM {DIRTY_SQL})), 0), 100), 6) AS "RAM",
               round(CASE WHEN response_time IS NULL THEN 0 ELSE greatest(response_time, 0) END, 6) AS response_time FROM {DIRTY_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.clean(dirty(spark, sf)))


_HEALTH_SQL = f"""
    SELECT CASE WHEN hours_old > 24 THEN 'critical_stale_data' WHEN issues <> '' THEN 'data_quality_issues' WHEN hours_old > 2 THEN 'data_warning' ELSE 'data_healthy' END AS status,
           records, round(hours_old, 6) AS hours_old, data_span_days, issues AS quality_issues
    FROM (SELECT *, concat_ws('; ', CASE WHEN nc > records * 0.1::DOUBLE THEN 'Too many missing values in CPU: ' || nc END,
                              CASE WHEN nr > records * 0.1::DOUBLE THEN 'Too many missing values in RAM: ' || nr END,
                              CASE WHEN dup > 0 THEN 'Duplicate timestamps: ' || dup END,
                              CASE WHEN hours_old > 6 THEN 'Data is stale: ' || printf('%.1f', hours_old) || ' hours old' END) AS issues
          FROM (SELECT count(*) AS records, (epoch_us({{now}}) - epoch_us(max("timestamp"))) / 3600000000.0::DOUBLE AS hours_old,
                       (epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) // 86400000000 AS data_span_days,
                       count(*) FILTER ("CPU" IS NULL) AS nc, count(*) FILTER ("RAM" IS NULL) AS nr,
                       count(*) - count(DISTINCT "timestamp") AS dup FROM requests))"""


@query(
    "qc3_data_health",
    " UNION ALL ".join(
        f"SELECT '{at}' AS as_of, * FROM ({_HEALTH_SQL.format(now=f'TIMESTAMP {chr(39)}{at}{chr(39)}')})"
        for at in ("2024-01-31 00:00:00", "2024-01-31 09:30:00", "2024-02-02 00:00:00")
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from slowtide.functions.clock import instant

    merged = None
    for at in ("2024-01-31 00:00:00", "2024-01-31 09:30:00", "2024-02-02 00:00:00"):
        row = quality.data_health(requests(spark, sf), instant(at)).select(
            F.lit(at).alias("as_of"), "status", "records", "hours_old", "data_span_days",
            F.concat_ws("; ", "quality_issues").alias("quality_issues"),
        )
        merged = row if merged is None else merged.unionByName(row)
    return rounded(merged)


_ACTIVITY_SQL = f"""
    SELECT CASE WHEN recent_count = 0 THEN 'no_recent_predictions' WHEN hourly_count < 6 THEN 'low_activity' WHEN recent_count < 201.6 THEN 'reduced_activity'
                ELSE 'normal_activity' END AS status, *
    FROM (SELECT count(*) FILTER (d) AS recent_count, count(*) FILTER (h) AS hourly_count, round(avg(predicted_label) FILTER (d) * 100, 6) AS delay_prediction_rate,
                 288::BIGINT AS expected_daily, count(*) FILTER (d) AS actual_daily, round(avg(probability) FILTER (d), 6) AS avg_probability,
                 count(*) FILTER (d AND probability > 0.7) AS high_confidence_predictions, count(*) FILTER (d AND probability < 0.3) AS low_confidence_predictions
          FROM (SELECT *, "timestamp" >= {{now}} - INTERVAL 24 HOUR AS d, "timestamp" >= {{now}} - INTERVAL 1 HOUR AS h FROM scored))"""


@query(
    "qc4_prediction_activity",
    " UNION ALL ".join(
        f"SELECT '{at}' AS as_of, * FROM ({_ACTIVITY_SQL.format(now=f'TIMESTAMP {chr(39)}{at}{chr(39)}')})"
        for at in ("2024-01-31 00:00:00", "2024-01-31 12:00:00", "2024-02-02 00:00:00")
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from slowtide.functions.clock import instant

    merged = None
    for at in ("2024-01-31 00:00:00", "2024-01-31 12:00:00", "2024-02-02 00:00:00"):
        row = quality.prediction_activity(prediction_log(spark, sf), instant(at)).withColumn("as_of", F.lit(at))
        merged = row if merged is None else merged.unionByName(row)
    return rounded(merged)


@query(
    "qc5_training_readiness",
    """SELECT CASE WHEN raw < 1000 THEN 'insufficient_data' WHEN buckets < 500 THEN 'insufficient_processed_data' ELSE 'prerequisites_ok' END AS status,
              raw AS raw_rows, buckets, CASE WHEN f1 < 0.1 THEN 1 ELSE 0 END AS low_f1_warning
       FROM (SELECT count(*) AS raw FROM requests), (SELECT count(*) AS buckets FROM series),
            (SELECT 2 * count(*) FILTER (true_label = 1 AND predicted_label = 1) / (count(*) FILTER (true_label = 1) + count(*) FILTER (predicted_label = 1)) AS f1 FROM scored)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = requests(spark, sf)
    f1 = evaluation.scores(evaluation.confusion(scored(spark, sf))).select("f1_score").scalar()
    return quality.training_readiness(log, features.health_series(log), f1)


@query(
    "qc6_scoring_readiness",
    "SELECT CASE WHEN count(*) < 100 THEN 'insufficient_data' ELSE 'health_ok' END AS status, count(*) AS raw_rows FROM requests",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.scoring_readiness(requests(spark, sf))


@query(
    "qc7_score_sanity",
    """SELECT 'scored' AS source, count(*) FILTER (probability < 0 OR probability > 1) AS bad_probabilities, count(*) FILTER (predicted_label NOT IN (0, 1)) AS bad_classes,
              'validation_success' AS status FROM scored
       UNION ALL SELECT 'doubled', count(*) FILTER (probability * 2 > 1), 0, CASE WHEN count(*) FILTER (probability * 2 > 1) > 0 THEN 'invalid_prediction_range' ELSE 'validation_success' END FROM scored""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf)
    parts = {"scored": rows, "doubled": rows.withColumn("probability", F.col("probability") * 2)}
    checks = [quality.score_sanity(df).withColumn("source", F.lit(name)) for name, df in parts.items()]
    return checks[0].unionByName(checks[1])


@query(
    "qc8_model_age",
    f"""SELECT as_of, CASE WHEN age > 45 THEN 'model_very_old' WHEN age > 30 THEN 'model_old' ELSE 'model_healthy' END AS status, age AS age_days
        FROM (SELECT as_of, (epoch_us(CAST(as_of AS TIMESTAMP)) - (SELECT epoch_us(max("timestamp")) FROM scored)) // 86400000000 AS age
              FROM (VALUES ('2024-01-31 00:00:00'), ('2024-03-05 00:00:00'), ('2024-03-31 00:00:00')) AS t(as_of))""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from slowtide.functions.clock import instant

    merged = None
    for at in ("2024-01-31 00:00:00", "2024-03-05 00:00:00", "2024-03-31 00:00:00"):
        row = quality.model_age(run_table(spark, sf), instant(at)).withColumn("as_of", F.lit(at))
        merged = row if merged is None else merged.unionByName(row)
    return merged


@query(
    "qc9_health_report",
    f"""SELECT h.status AS data_status, h.records, h.hours_old, 'model_healthy' AS model_status,
               (SELECT (epoch_us({_NOW}) - epoch_us(max("timestamp"))) // 86400000000 FROM scored) AS model_age_days,
               a.status AS predictions_status, a.recent_count AS recent_predictions,
               CASE WHEN h.status = 'critical_stale_data' THEN 'CRITICAL' WHEN h.status = 'data_quality_issues' OR a.status = 'low_activity' THEN 'WARNING' ELSE 'HEALTHY' END AS overall_status
        FROM ({_HEALTH_SQL.format(now=_NOW)}) h, ({_ACTIVITY_SQL.format(now=_NOW)}) a""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(health_report(requests(spark, sf), prediction_log(spark, sf), run_table(spark, sf), now()))


@query(
    "qc10_input_drift",
    """SELECT (SELECT round(stddev_pop(probability), 6) FROM scored) AS pred_prob_std,
              (SELECT round(stddev_pop(probability), 6) FROM (SELECT probability FROM scored ORDER BY "timestamp" DESC, event_id DESC LIMIT 50)) AS rolling_pred_std,
              round(stddev_pop("CPU"), 6) AS cpu_std, round(stddev_pop("RAM"), 6) AS ram_std FROM (SELECT * FROM filled ORDER BY bucket_id DESC LIMIT 100)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from slowtide.session import fresh_folder
    from slowtide.sources.writers import append_report

    path = fresh_folder(spark, "drift")
    numbers = quality.drift_numbers(
        features.feature_series(requests(spark, sf)), scored(spark, sf), tie=["event_id"]
    )
    append_report(rounded(numbers), path, now())
    names = ["pred_prob_std", "rolling_pred_std", "cpu_std", "ram_std"]
    return spark.read.schema(", ".join(f"{n} double" for n in names) + ", monitoring_date string").json(path).select(*names)
