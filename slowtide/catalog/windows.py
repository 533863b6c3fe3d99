"""Look-back, look-ahead, rolling and fill columns on the gap-free series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.catalog.registry import query, rounded
from slowtide.catalog.source_sink import sql_rows
from slowtide.functions import flags
from slowtide.operators import evaluation
from slowtide.operators.chunked import forward_fill, over_halo, rolling_mean, rolling_std
from slowtide.operators.quantiles import exact_quantiles
from slowtide.operators.sequences import sequences
from slowtide.operators.slices import split_holdout
from slowtide.plans import features
from slowtide.session import durable
from slowtide.sources.testdata import requests, scored

_LAGS = ", ".join(
    f'round(lag("{c}", {k}) OVER w, 6) AS {short}_lag_{k}'
    for k in (1, 2, 3)
    for short, c in (("cpu", "CPU"), ("ram", "RAM"), ("response", "response_time"))
)
_FEATURE_COLUMNS = """bucket_id, bucket, "Delay_Detected", round(response_time, 6) AS response_time, round("CPU", 6) AS "CPU", round("RAM", 6) AS "RAM",
       is_error, hour, day_of_week, is_weekend, is_peak_hour, high_cpu, high_ram, high_error_period,
       round(cpu_rolling_mean, 6) AS cpu_rolling_mean, round(cpu_rolling_std, 6) AS cpu_rolling_std,
       round(ram_rolling_mean, 6) AS ram_rolling_mean, round(response_rolling_mean, 6) AS response_rolling_mean,
       future_delay, target"""


@query("wn_full_feature_table", f"SELECT {_FEATURE_COLUMNS} FROM features")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.feature_series(requests(spark, sf)))


@query(
    "wn_full_feature_table_by_site",
    """WITH b AS (SELECT site, epoch_us("timestamp") // 300000000 AS bucket_id, max(CASE WHEN response_time > 2000 THEN 1 ELSE 0 END) AS d,
                         avg("CPU") AS c, avg("RAM") AS r FROM requests GROUP BY ALL),
            s AS (SELECT site, unnest(generate_series(min(bucket_id), max(bucket_id))) AS bucket_id FROM b GROUP BY site),
            j AS (SELECT site, bucket_id, coalesce(d, 0) AS d, coalesce(c, 0) AS c, r FROM s LEFT JOIN b USING (site, bucket_id)),
            m AS (SELECT site, quantile_cont(r, 0.5) AS med, quantile_cont(c, 0.8) AS pc FROM j GROUP BY site),
            f AS (SELECT site, bucket_id, d, c, pc, coalesce(last_value(r IGNORE NULLS) OVER (PARTITION BY site ORDER BY bucket_id ROWS UNBOUNDED PRECEDING), med) AS r
                  FROM j JOIN m USING (site)),
            q AS (SELECT site, quantile_cont(r, 0.8) AS pr FROM f GROUP BY site)
       SELECT site, bucket_id, round(c, 6) AS "CPU", round(r, 6) AS "RAM", CASE WHEN round(c, 9) > round(pc, 9) THEN 1 ELSE 0 END AS high_cpu,
              CASE WHEN round(r, 9) > round(pr, 9) THEN 1 ELSE 0 END AS high_ram,
              round(avg(c) OVER (PARTITION BY site ORDER BY bucket_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS cpu_rolling_mean,
              coalesce(lead(d) OVER (PARTITION BY site ORDER BY bucket_id), 0) AS target
       FROM f JOIN q USING (site)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    table = features.feature_series(requests(spark, sf), keys=["site"])
    return rounded(table.select("site", "bucket_id", "CPU", "RAM", "high_cpu", "high_ram", "cpu_rolling_mean", "target"))


@query("wn1_lags_1_2_3", f"SELECT bucket_id, {_LAGS} FROM filled WINDOW w AS (ORDER BY bucket_id)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    table = features.feature_series(requests(spark, sf), lags=(1, 2, 3))
    return rounded(table.select("bucket_id", *[c for c in table.columns if "_lag_" in c]))


_COUNT_LAGS = ", ".join(f'lag("Delay_Detected", {k}) OVER w AS delay_lag_{k}' for k in (2, 4, 6, 12))


@query(
    "wn2_delay_count_features",
    f"""SELECT bucket, "Delay_Detected", round(response_time, 6) AS time_taken, round("CPU", 6) AS "CPU", round("RAM", 6) AS "RAM",
               round(status_code, 6) AS sc_status, is_error, {_COUNT_LAGS},
               CASE WHEN count(*) OVER w12 >= 12 THEN round(avg("Delay_Detected") OVER w12, 6) END AS delay_rolling_avg_1h,
               CASE WHEN count(*) OVER w36 >= 36 THEN round(stddev_samp("Delay_Detected") OVER w36, 6) END AS delay_rolling_std_3h,
               CASE WHEN lead("Delay_Detected", 2) OVER w > 0 THEN 1 ELSE 0 END AS target,
               CAST(minute(bucket) AS INTEGER) AS minute, CAST(hour(bucket) AS INTEGER) AS hour, CAST(isodow(bucket) - 1 AS INTEGER) AS day_of_week,
               CASE WHEN isodow(bucket) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN round(is_error, 9) > (SELECT round(quantile_cont(CAST(is_error AS DOUBLE), 0.9), 9) FROM counts5) THEN 1 ELSE 0 END AS high_error_period
        FROM counts5 WINDOW w AS (ORDER BY bucket_id), w12 AS (ORDER BY bucket_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
                            w36 AS (ORDER BY bucket_id ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.count_features(sql_rows(spark, sf)).drop("bucket_id"))


@query(
    "wn2_long_lags",
    'SELECT bucket, ' + ", ".join(f'lag("Delay_Detected", {k}) OVER w AS delay_lag_{k}' for k in (6, 12, 18, 24))
    + " FROM counts5 WINDOW w AS (ORDER BY bucket_id)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = features.count_series(requests(spark, sf), 300)
    lags = (6, 12, 18, 24)
    return over_halo(
        series, lambda w: {f"delay_lag_{k}": F.lag("Delay_Detected", k).over(w) for k in lags}, back=max(lags)
    ).select("bucket", *[f"delay_lag_{k}" for k in lags])


@query(
    "wn3_lead_1_target",
    """SELECT bucket_id, "Delay_Detected", future_delay, target FROM features""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = features.health_series(requests(spark, sf)).fillna(0, ["Delay_Detected"])
    led = over_halo(series, lambda w: {"future_delay": F.lead("Delay_Detected", 1).over(w)}, forward=1)
    return led.select("bucket_id", "Delay_Detected", "future_delay", F.coalesce("future_delay", F.lit(0)).alias("target"))


@query(
    "wn4_lead_2_targets",
    """SELECT bucket_id, coalesce(lead(CASE WHEN "Delay_Detected" > 0 THEN 1 ELSE 0 END, 2) OVER w, 0) AS target,
              CASE WHEN lead("Delay_Detected", 1) OVER w > 0 THEN 1 ELSE 0 END AS target_1,
              CASE WHEN lead("Delay_Detected", 2) OVER w > 0 THEN 1 ELSE 0 END AS target_2,
              CASE WHEN lead("Delay_Detected", 6) OVER w > 0 THEN 1 ELSE 0 END AS target_6
       FROM counts5 WINDOW w AS (ORDER BY bucket_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = features.count_series(requests(spark, sf), 300).withColumn("any_delay", flags.flag(F.col("Delay_Detected") > 0))
    return over_halo(
        series,
        lambda w: {
            "target": F.coalesce(F.lead("any_delay", 2).over(w), F.lit(0)),
            **{f"target_{h}": flags.flag(F.lead("Delay_Detected", h).over(w) > 0) for h in (1, 2, 6)},
        },
        forward=6,
    ).select("bucket_id", "target", "target_1", "target_2", "target_6")


@query(
    "wn5_wn6_rolling_with_gaps",
    """SELECT bucket_id, round(avg("CPU") OVER w, 6) AS cpu_mean, round(stddev_samp("CPU") OVER w, 6) AS cpu_std,
              round(avg("RAM") OVER w, 6) AS ram_mean, round(avg(response_time) OVER w, 6) AS response_mean
       FROM series WINDOW w AS (ORDER BY bucket_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = features.health_series(requests(spark, sf))
    n = schemas.ROLLING_BUCKETS
    rolled = over_halo(
        series,
        lambda w: {
            "cpu_mean": rolling_mean("CPU", w, n),
            "cpu_std": rolling_std("CPU", w, n),
            "ram_mean": rolling_mean("RAM", w, n),
            "response_mean": rolling_mean("response_time", w, n),
        },
        back=n - 1,
    )
    return rounded(rolled.select("bucket_id", "cpu_mean", "cpu_std", "ram_mean", "response_mean"))


@query(
    "wn7_full_window_rolling",
    """SELECT bucket_id, CASE WHEN count("CPU") OVER w12 >= 12 THEN round(avg("CPU") OVER w12, 6) END AS cpu_mean_12,
              CASE WHEN count("CPU") OVER w36 >= 36 THEN round(stddev_samp("CPU") OVER w36, 6) END AS cpu_std_36
       FROM series WINDOW w12 AS (ORDER BY bucket_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
                          w36 AS (ORDER BY bucket_id ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rolled = over_halo(
        features.health_series(requests(spark, sf)),
        lambda w: {"cpu_mean_12": rolling_mean("CPU", w, 12, 12), "cpu_std_36": rolling_std("CPU", w, 36, 36)},
        back=35,
    )
    return rounded(rolled.select("bucket_id", "cpu_mean_12", "cpu_std_36"))


@query(
    "wn8_fill_then_median",
    """SELECT bucket_id, round("RAM", 6) AS "RAM",
              round(coalesce(last_value("CPU" IGNORE NULLS) OVER w, (SELECT quantile_cont("CPU", 0.5) FROM series)), 6) AS "CPU"
       FROM (SELECT s.bucket_id, s."CPU", f."RAM" FROM series s JOIN filled f USING (bucket_id))
       WINDOW w AS (ORDER BY bucket_id ROWS UNBOUNDED PRECEDING)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = features.health_series(requests(spark, sf))
    middle = exact_quantiles(series, {c: (F.col(c), [0.5]) for c in ("CPU", "RAM")})
    filled = forward_fill(series, ["CPU", "RAM"])
    return rounded(
        filled.select("bucket_id", *[F.coalesce(c, F.lit(middle[c][0]).cast("double")).alias(c) for c in ("RAM", "CPU")])
    )


@query(
    "wn9_forward_fill",
    """SELECT bucket_id, round(last_value("CPU" IGNORE NULLS) OVER w, 6) AS "CPU", round(last_value("RAM" IGNORE NULLS) OVER w, 6) AS "RAM",
              round(coalesce(last_value(status_code IGNORE NULLS) OVER w, 200), 6) AS status_code
       FROM counts5 WINDOW w AS (ORDER BY bucket_id ROWS UNBOUNDED PRECEDING)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = features.count_series(requests(spark, sf), 300)
    filled = forward_fill(series, ["CPU", "RAM", "status_code"])
    return rounded(filled.select("bucket_id", "CPU", "RAM", F.coalesce("status_code", F.lit(200.0)).alias("status_code")))


@query(
    "wn10_zero_fill",
    """SELECT bucket_id, round("CPU", 6) AS "CPU", round(response_time, 6) AS response_time, is_error, "Delay_Detected" FROM filled""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["CPU", "response_time", "is_error", "Delay_Detected"]
    return rounded(features.health_series(requests(spark, sf)).fillna(0, columns).select("bucket_id", *columns))


@query(
    "wn11_sequences",
    """SELECT e.bucket_id, e.target AS label, CAST(24 - k AS INTEGER) AS step, round(f."CPU", 6) AS "CPU", round(f."RAM", 6) AS "RAM",
              round(f.response_rolling_mean, 6) AS response_rolling_mean, CAST(f.high_ram AS DOUBLE) AS high_ram
       FROM train_part e, (SELECT unnest(generate_series(1, 24)) AS k), train_part f
       WHERE f.bucket_id = e.bucket_id - k AND e.bucket_id >= (SELECT min(bucket_id) + 24 FROM train_part)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    names = ["CPU", "RAM", "response_rolling_mean", "high_ram"]
    cut = sequences(train_part(spark, sf), names)
    steps = cut.select("bucket_id", "label", F.posexplode("steps").alias("step", "x"))
    return rounded(steps.select("bucket_id", "label", "step", *[F.col("x")[i].alias(n) for i, n in enumerate(names)]))


def train_part(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table without its last five buckets."""
    tagged = split_holdout(durable(features.feature_series(requests(spark, sf))), schemas.HOLDOUT_BUCKETS)
    return tagged.where("holdout = 0").drop("holdout")


@query(
    "wn12_first_maximum",
    """WITH c AS (SELECT probability AS t, count(*) AS n, sum(true_label) AS pos FROM scored GROUP BY 1),
            r AS (SELECT t, sum(pos) OVER w AS tp, sum(n) OVER w AS predicted, sum(pos) OVER () AS positives FROM c
                  WINDOW w AS (ORDER BY t DESC ROWS UNBOUNDED PRECEDING))
       SELECT t AS threshold, round(2.0 * tp / (predicted + positives), 6) AS f1 FROM r ORDER BY round(2.0 * tp / (predicted + positives), 12) DESC, t LIMIT 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    best = evaluation.best_threshold(evaluation.pr_curve(scored(spark, sf)))
    return rounded(best.select(F.col("best_f1_threshold").alias("threshold"), F.col("best_f1_score").alias("f1")))
