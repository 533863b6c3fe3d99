"""From requests to model input: enrichment, series, fills, look-back and label columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.functions import clock, flags
from slowtide.operators.chunked import forward_fill, over_halo, rolling_mean, rolling_std
from slowtide.operators.quantiles import exact_quantiles, quantiles_by
from slowtide.operators.series import resample
from slowtide.session import durable

HEALTH_AGGS = {
    "Delay_Detected": ("max", "Delay_Detected"),
    "response_time": ("mean", "response_time"),
    "CPU": ("mean", "CPU"),
    "RAM": ("mean", "RAM"),
    "is_error": ("max", "is_error"),
}
HEALTH_STATUS_AGGS = {**HEALTH_AGGS, "status_code": ("mean", "status_code")}
COUNT_AGGS = {
    "Delay_Detected": ("sum", "Delay_Detected"),
    "response_time": ("mean", "response_time"),
    "CPU": ("mean", "CPU"),
    "RAM": ("mean", "RAM"),
    "status_code": ("mean", "status_code"),
    "is_error": ("sum", "is_error"),
}
SQL_COUNT_AGGS = {
    "Delay_Detected": ("sum", "Delay_Detected"),
    "time_taken": ("mean", "time_taken"),
    "CPU": ("mean", "CPU"),
    "RAM": ("mean", "RAM"),
    "sc_status": ("mean", "sc_status"),
    "is_error": ("sum", "is_error"),
}
# Flags compare values rounded to this many digits: the last bits of a distributed
# mean depend on the order of the additions and must not decide a flag.
DIGITS = 9


def above(x: Column, threshold: Column | float | None) -> Column:
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold).cast("double")
    return flags.flag(F.round(x, DIGITS) > F.round(limit, DIGITS))


def flag_delays(requests: DataFrame, limit: float = schemas.RESPONSE_LIMIT_MS, column: str = "response_time") -> DataFrame:
    return requests.withColumn("Delay_Detected", flags.is_delayed(F.col(column), limit))


def enrich(requests: DataFrame, service: str = "api") -> DataFrame:
    """Per-request columns from time, URL and status."""
    ts, hour = F.col("timestamp"), F.hour("timestamp")
    return requests.withColumns(
        {
            "Delay_Detected": flags.is_delayed(F.col("response_time")),
            "date": F.to_date(ts),
            "time": clock.time_of_day(ts),
            "hour": hour,
            "day_of_week": clock.day_of_week(ts),
            "request_path_depth": flags.path_depth(F.col("url")),
            "endpoint_base": flags.last_segment(F.col("url")),
            "service": F.lit(service),
            "is_error": flags.is_error(F.col("status_code")),
            "is_success": flags.is_success(F.col("status_code")),
            "is_peak_hour": clock.is_peak_hour(hour),
        }
    )


def health_series(requests: DataFrame, keys: Sequence[str] = (), step: int = schemas.BUCKET_SECONDS) -> DataFrame:
    """Gap-free series: any delay, any error, mean response time, CPU and RAM."""
    return resample(flag_delays(requests), HEALTH_AGGS, step, keys=keys)


def feature_series(
    requests: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 1,
    lags: Sequence[int] = (),
    step: int = schemas.BUCKET_SECONDS,
) -> DataFrame:
    """The full feature table of the delay model, straight from requests."""
    return add_features(health_series(requests, keys, step), keys, horizon, lags)


def add_features(
    series: DataFrame, keys: Sequence[str] = (), horizon: int = 1, lags: Sequence[int] = ()
) -> DataFrame:
    """Fills, calendar, rolling statistics, load flags, optional lags and the label.

    Order matters: the RAM median is that of the unfilled series, the CPU quantile
    counts empty buckets as 0, the RAM quantile and all rolling columns follow the fill.
    """
    filled = durable(forward_fill(series.withColumn("_seen", F.col("RAM")), ["RAM"], keys))
    zero_cpu = F.coalesce("CPU", F.lit(0.0))
    if keys:
        middle = quantiles_by(filled, keys, {"_median": (F.col("_seen"), [0.5]), "_cpu": (zero_cpu, [0.8])})
        full = filled.join(middle, [*keys], "left").withColumn("RAM", F.coalesce("RAM", F.get("_median", F.lit(0))))
        full = full.join(quantiles_by(full, keys, {"_ram": (F.col("RAM"), [0.8])}), [*keys], "left")
        cpu_limit, ram_limit = F.get("_cpu", F.lit(0)), F.get("_ram", F.lit(0))
    else:
        found = exact_quantiles(
            filled,
            {
                "median": (F.col("_seen"), [0.5]),
                "cpu": (zero_cpu, [0.8]),
                "ram": (F.col("RAM"), [0.8]),
                "any_gap": (F.col("RAM").isNull().cast("int"), [1.0]),
            },
        )
        full = filled.withColumn("RAM", F.coalesce("RAM", F.lit(found["median"][0]).cast("double")))
        cpu_limit, ram_limit = found["cpu"][0], found["ram"][0]
        if found["any_gap"][0]:
            # The series starts without RAM, so the median fill shifts its quantile.
            ram_limit = exact_quantiles(full, {"ram": (F.col("RAM"), [0.8])})["ram"][0]
    hour = F.hour("bucket")
    ready = full.withColumns(
        {
            "CPU": zero_cpu,
            "response_time": F.coalesce("response_time", F.lit(0.0)),
            "is_error": F.coalesce("is_error", F.lit(0)),
            "Delay_Detected": F.coalesce("Delay_Detected", F.lit(0)),
            "hour": hour,
            "day_of_week": clock.day_of_week(F.col("bucket")),
            "is_weekend": clock.is_weekend(F.col("bucket")),
            "is_peak_hour": clock.is_peak_hour(hour),
        }
    ).withColumns(
        {
            "high_cpu": above(F.col("CPU"), cpu_limit),
            "high_ram": above(F.col("RAM"), ram_limit),
            "high_error_period": flags.flag(F.col("is_error") > 0),
        }
    )
    n = schemas.ROLLING_BUCKETS

    def looking(w: WindowSpec) -> dict[str, Column]:
        return {
            **{
                f"{short}_lag_{k}": F.lag(c, k).over(w)
                for k in lags
                for short, c in (("cpu", "CPU"), ("ram", "RAM"), ("response", "response_time"))
            },
            "cpu_rolling_mean": rolling_mean("CPU", w, n),
            "cpu_rolling_std": rolling_std("CPU", w, n),
            "ram_rolling_mean": rolling_mean("RAM", w, n),
            "response_rolling_mean": rolling_mean("response_time", w, n),
            "future_delay": F.lead("Delay_Detected", horizon).over(w),
        }

    return (
        over_halo(ready, looking, back=max([n - 1, *lags]), forward=horizon, keys=keys)
        .withColumn("target", F.coalesce("future_delay", F.lit(0)).cast("int"))
        .drop("_seen", "_median", "_cpu", "_ram")
    )


def count_series(requests: DataFrame, step: int, keys: Sequence[str] = ()) -> DataFrame:
    """Gap-free series of delay and error counts with mean load and status."""
    return resample(flag_delays(requests), COUNT_AGGS, step, keys=keys)


def count_features(
    sql_rows: DataFrame,
    lags: Sequence[int] = (2, 4, 6, 12),
    horizon: int = 2,
    mean_rows: int = 12,
    std_rows: int = 36,
) -> DataFrame:
    """Feature table on delay counts, from rows with the database's column names."""
    flagged = flag_delays(sql_rows, column="time_taken")
    series = resample(flagged, SQL_COUNT_AGGS, schemas.BUCKET_SECONDS, ts="datetime")
    errors = exact_quantiles(series, {"p90": (F.col("is_error"), [0.9])})["p90"][0]

    def looking(w: WindowSpec) -> dict[str, Column]:
        return {
            **{f"delay_lag_{k}": F.lag("Delay_Detected", k).over(w) for k in lags},
            "delay_rolling_avg_1h": rolling_mean("Delay_Detected", w, mean_rows, mean_rows),
            "delay_rolling_std_3h": rolling_std("Delay_Detected", w, std_rows, std_rows),
            "target": flags.flag(F.lead("Delay_Detected", horizon).over(w) > 0),
        }

    bucket = F.col("bucket")
    return over_halo(series, looking, back=max([mean_rows - 1, std_rows - 1, *lags]), forward=horizon).withColumns(
        {
            "minute": F.minute(bucket),
            "hour": F.hour(bucket),
            "day_of_week": clock.day_of_week(bucket),
            "is_weekend": clock.is_weekend(bucket),
            "high_error_period": above(F.col("is_error"), errors),
        }
    )
