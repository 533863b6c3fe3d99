"""Scaling, weights, input windows, training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.catalog.registry import now, query, rounded
from slowtide.catalog.windows import train_part
from slowtide.operators import columns, runs
from slowtide.operators.sequences import asymmetric_losses, class_weights, fit_scaler, latest_window, sequence_limits, sequences
from slowtide.operators.slices import split_ordered
from slowtide.plans import features, training
from slowtide.session import durable, fresh_folder
from slowtide.sources.testdata import requests, scored

_IN_WINDOWS = """SELECT f.* FROM train_part f, (SELECT unnest(generate_series(1, 24)) AS k),
                        (SELECT min(bucket_id) AS lo, max(bucket_id) AS hi FROM train_part)
                 WHERE f.bucket_id + k BETWEEN lo + 24 AND {last}"""
_LAST_TRAIN = "lo + 23 + (hi - lo + 1 - 24) - CAST(ceil((hi - lo + 1 - 24) * 0.2::DOUBLE) AS BIGINT)"


def _scaler_sql(part: str, last: str) -> str:
    names = ", ".join(f"('{f}')" for f in schemas.FEATURES)
    means = " ".join(f"WHEN '{f}' THEN avg(\"{f}\")" for f in schemas.FEATURES)
    stds = " ".join(
        f"WHEN '{f}' THEN CASE WHEN min(\"{f}\") = max(\"{f}\") THEN 1 ELSE stddev_pop(\"{f}\") END" for f in schemas.FEATURES
    )
    return f"""SELECT '{part}' AS fit_on, feature, round(CASE feature {means} END, 6) AS mean, round(CASE feature {stds} END, 6) AS scale
               FROM ({_IN_WINDOWS.format(last=last)}), (VALUES {names}) AS n(feature) GROUP BY feature"""


@query("ml1_window_scaler", _scaler_sql("all", "hi") + " UNION ALL " + _scaler_sql("train", _LAST_TRAIN))
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = durable(train_part(spark, sf))
    rows = []
    for part in ("all", "train"):
        s = fit_scaler(series, schemas.FEATURES, fit_on=part)
        rows += [(part, f, m, d) for f, m, d in zip(s.features, s.mean, s.scale)]
    return rounded(spark.createDataFrame(rows, "fit_on string, feature string, mean double, scale double"))


@query(
    "ml2_balanced_class_weights",
    f"""WITH y AS (SELECT target AS label FROM train_part, (SELECT min(bucket_id) AS lo, max(bucket_id) AS hi FROM train_part)
                   WHERE bucket_id >= lo + 24 AND bucket_id <= {_LAST_TRAIN})
        SELECT label, count(*) AS n, round((SELECT count(*) FROM y) / (2.0::DOUBLE * count(*)), 6) AS weight FROM y GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = durable(train_part(spark, sf).select("bucket_id", "bucket", "CPU", "target"))
    windows = split_ordered(sequences(series, ["CPU"]), limits=sequence_limits(series))
    return rounded(class_weights(windows.where("is_validation = 0")))


_LATEST_FEATURES = ["CPU", "RAM", "response_time", "is_error", "hour", "high_cpu"]
_LATEST_SQL = ", ".join(f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in _LATEST_FEATURES)


def _unfold(window: DataFrame, names: list[str]) -> DataFrame:
    steps = window.select(F.posexplode("steps").alias("step", "x"))
    return rounded(steps.select("step", *[F.col("x")[i].alias(n) for i, n in enumerate(names)]))


@query(
    "ml3_latest_window",
    f"""SELECT CAST(row_number() OVER (ORDER BY bucket_id) - 1 AS INTEGER) AS step, {_LATEST_SQL}
        FROM (SELECT * FROM features ORDER BY bucket_id DESC LIMIT 24)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _unfold(latest_window(features.feature_series(requests(spark, sf)), _LATEST_FEATURES), _LATEST_FEATURES)


@query(
    "ml3_padded_window",
    f"""WITH h AS (SELECT *, row_number() OVER (ORDER BY bucket_id DESC) AS back, count(*) OVER () AS n FROM features
                   WHERE bucket >= (SELECT max(bucket) - INTERVAL 1 HOUR FROM features))
        SELECT CAST(24 - back AS INTEGER) AS step, {_LATEST_SQL} FROM h
        UNION ALL SELECT CAST(s AS INTEGER), {_LATEST_SQL} FROM h, (SELECT unnest(range(24)) AS s) WHERE back = 1 AND s < 24 - n""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = durable(features.feature_series(requests(spark, sf)))
    return _unfold(latest_window(columns.since_latest(series, 1, "bucket"), _LATEST_FEATURES), _LATEST_FEATURES)


@query(
    "ml6_ud2_asymmetric_loss",
    """SELECT true_label, count(*) AS n, CASE WHEN true_label = 1 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
              round(avg(CASE WHEN true_label = 1 THEN -3 * ln(least(greatest(probability, 1e-7), 1 - 1e-7))
                             ELSE -ln(1 - least(greatest(probability, 1e-7), 1 - 1e-7)) END), 6) AS mean_loss FROM scored GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(asymmetric_losses(scored(spark, sf)))


@query("ml4_ml7_train_delay_classifier")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """One training run, read back from the run table: its metrics and its loss curve."""
    model = training.train(train_part(spark, sf))
    path = fresh_folder(spark, "runs")
    record = spark.createDataFrame([(1,)], "one int").select(F.lit("run-1").alias("run_id"))
    runs.log_run(
        spark,
        path,
        runs.run_rows(
            record,
            F.col("run_id"),
            now(),
            {"features": F.lit(",".join(model.features)), "window_size": F.lit(model.window), "model_type": F.lit("logistic")},
            {name: F.lit(value) for name, value in model.metrics.items()},
        ),
    )
    runs.log_history(spark, path, "run-1", {"train_loss": model.losses})
    metrics = runs.read_runs(spark, path).select("run_id", F.lit(-1).alias("step"), F.explode("metrics").alias("metric", "value"))
    return metrics.unionByName(runs.read_history(spark, path))


@query("ml5_score_latest_and_batch")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all windows by label, and the prediction for the newest one."""
    series = durable(features.feature_series(requests(spark, sf)))
    model = training.train(series)
    batch = training.score(model, series).groupBy(F.concat(F.lit("label "), F.col("label").cast("string")).alias("part")).agg(
        F.count("*").alias("n"), F.avg("probability").alias("probability"), F.sum("predicted_label").alias("positives")
    )
    latest = training.predict_latest(model, series, now()).select(
        F.lit("latest").alias("part"), F.lit(1).cast("bigint").alias("n"), "probability", F.col("prediction").cast("bigint").alias("positives")
    )
    return batch.unionByName(latest)
