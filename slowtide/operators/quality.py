"""Table checks: validity, freshness, activity, readiness; each is one reduced row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.functions import clock, flags
from slowtide.operators.columns import missing
from slowtide.operators.profile import prediction_std, recent_std, repeated
from slowtide.operators.quantiles import exact_quantiles

# The statuses that decide the report.
CRITICAL = ["critical_stale_data", "no_model", "critical_low_disk", "monitoring_failed"]
WARNING = ["data_quality_issues", "model_old", "low_activity", "low_disk_space"]
# Statuses in neither list that still mean trouble; a strict report treats them as warnings.
OVERLOOKED = [
    "no_data", "data_warning", "model_very_old", "reduced_activity", "no_recent_predictions",
    "no_predictions", "disk_nearly_full",
]

# Texts of the issues.
MISSING_COLUMNS = "Missing columns: "
INVALID_VALUES = ("Invalid ", " values: ", " records")
NEGATIVE_TIMES = ("Negative response times: ", " records")
HIGH_NULLS = ("High null percentage in: [", "]")
MANY_NULLS = "Too many missing values in "
DUPLICATE_TIMES = "Duplicate timestamps: "
STALE = ("Data is stale: ", " hours old")


def _issues(*texts: Column) -> Column:
    return F.filter(F.array(*texts), lambda text: text.isNotNull())


def _message(condition: Column, *parts: Column | str) -> Column:
    return F.when(condition, F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))


def validate(df: DataFrame, required: Sequence[str] = schemas.REQUIRED_TO_VALIDATE) -> DataFrame:
    """One row: ``total_records, issues, is_valid, null_percentages``."""
    have = df.columns
    n = F.count("*").alias("n")
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in have]
    out_of_range = [
        F.count_if((F.col(c) < 0) | (F.col(c) > 100)).alias(f"bad_{c}") for c in ("CPU", "RAM") if c in have
    ]
    negative = [F.count_if(F.col("response_time") < 0).alias("bad_response_time")] if "response_time" in have else []
    counted = df.agg(n, *nulls, *out_of_range, *negative)

    gone = missing(df, required)
    share = {c: F.try_divide(F.col(f"null_{c}"), F.col("n")) for c in have}
    sparse = F.concat_ws(", ", *[F.when(share[c] > 0.1, F.lit(f"'{c}'")) for c in have])
    texts = [F.lit(f"{MISSING_COLUMNS}{gone}") if gone else F.lit(None).cast("string")]
    for c in ("CPU", "RAM"):
        if c in have:
            before, middle, after = INVALID_VALUES
            texts.append(_message(F.col(f"bad_{c}") > 0, f"{before}{c}{middle}", F.col(f"bad_{c}"), after))
    if negative:
        bad = F.col("bad_response_time")
        texts.append(_message(bad > 0, NEGATIVE_TIMES[0], bad, NEGATIVE_TIMES[1]))
    texts.append(_message(F.length(sparse) > 0, HIGH_NULLS[0], sparse, HIGH_NULLS[1]))
    pairs = [part for c in have for part in (F.lit(c), share[c])]
    return counted.select(
        F.col("n").alias("total_records"),
        _issues(*texts).alias("issues"),
        (F.size(_issues(*texts)) == 0).alias("is_valid"),
        F.create_map(*pairs).alias("null_percentages"),
    )


def clean(df: DataFrame) -> DataFrame:
    """Clip CPU and RAM to 0–100 and response time to ≥ 0, and fill their nulls.

    CPU and response time fill with 0 after clipping, RAM with the median of the raw
    column before clipping.
    """
    new: dict[str, Column] = {}
    if "CPU" in df.columns:
        new["CPU"] = F.coalesce(flags.clip(F.col("CPU"), 0, 100), F.lit(0.0))
    if "RAM" in df.columns:
        middle = exact_quantiles(df, {"RAM": (F.col("RAM"), [0.5])})["RAM"][0]
        new["RAM"] = flags.clip(F.coalesce(F.col("RAM"), F.lit(middle).cast("double")), 0, 100)
    if "response_time" in df.columns:
        new["response_time"] = F.coalesce(flags.clip(F.col("response_time"), 0), F.lit(0.0))
    return df.withColumns(new)


def data_health(
    df: DataFrame, now: Column, required: Sequence[str] = schemas.REQUIRED_TO_TRAIN, ts: str = "timestamp"
) -> DataFrame:
    """One row: ``status, records, hours_old, data_span_days, quality_issues``."""
    checked = [c for c in ("CPU", "RAM", "response_time") if c in df.columns]
    counted = df.agg(
        F.count("*").alias("records"),
        F.min(ts).alias("oldest"),
        F.max(ts).alias("newest"),
        repeated(ts).alias("duplicates"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in checked],
    ).withColumns(
        {
            "hours_old": clock.hours_between(now, F.col("newest")),
            "data_span_days": clock.whole_days_between(F.col("newest"), F.col("oldest")),
        }
    )
    gone = missing(df, required)
    hours = F.col("hours_old")
    issues = _issues(
        F.lit(f"{MISSING_COLUMNS}{gone}") if gone else F.lit(None).cast("string"),
        *[
            _message(
                F.col(f"null_{c}") > F.col("records") * F.lit(0.1), f"{MANY_NULLS}{c}: ", F.col(f"null_{c}")
            )
            for c in checked
        ],
        _message(F.col("duplicates") > 0, DUPLICATE_TIMES, F.col("duplicates")),
        _message(hours > 6, STALE[0], F.format_string("%.1f", hours), STALE[1]),
    )
    status = (
        F.when(F.col("records") == 0, "no_data")
        .when(hours > 24, "critical_stale_data")
        .when(F.size("quality_issues") > 0, "data_quality_issues")
        .when(hours > 2, "data_warning")
        .otherwise("data_healthy")
    )
    return counted.withColumn("quality_issues", issues).select(
        status.alias("status"), "records", "hours_old", "data_span_days", "quality_issues"
    )


def prediction_activity(df: DataFrame, now: Column, ts: str = "timestamp", per_hour: int = 12) -> DataFrame:
    """One row on the last day and hour of the prediction log, against the schedule."""
    if ts not in df.columns:
        return df.agg(F.lit("invalid_predictions_format").alias("status"), F.count("*").alias("total_count"))
    day = F.col(ts) >= now - clock.seconds(24 * 3600)
    hour = F.col(ts) >= now - clock.seconds(3600)
    p = F.col("probability") if "probability" in df.columns else F.lit(None).cast("double")
    per_day = 24 * per_hour
    counted = df.agg(
        F.count("*").alias("total_count"),
        F.count_if(day).alias("recent_count"),
        F.count_if(hour).alias("hourly_count"),
        (F.avg(F.when(day, F.col("prediction"))) * 100).alias("delay_prediction_rate"),
        F.avg(F.when(day, p)).alias("avg_probability"),
        F.count_if(day & (p > 0.7)).alias("high_confidence_predictions"),
        F.count_if(day & (p < 0.3)).alias("low_confidence_predictions"),
    )
    status = (
        F.when(F.col("total_count") == 0, "no_predictions")
        .when(F.col("recent_count") == 0, "no_recent_predictions")
        .when(F.col("hourly_count") < per_hour * 0.5, "low_activity")
        .when(F.col("recent_count") < per_day * 0.7, "reduced_activity")
        .otherwise("normal_activity")
    )
    return counted.select(
        status.alias("status"),
        "recent_count",
        "hourly_count",
        "delay_prediction_rate",
        F.lit(per_day).cast("bigint").alias("expected_daily"),
        F.col("recent_count").alias("actual_daily"),
        "avg_probability",
        "high_confidence_predictions",
        "low_confidence_predictions",
    )


def training_readiness(
    raw: DataFrame, series: DataFrame | None = None, f1: Column | None = None, min_raw: int = 1000,
    min_buckets: int = 500, min_f1: float = 0.1,
) -> DataFrame:
    """One row: size of both tables and the first gate that fails."""
    gone = missing(raw, schemas.REQUIRED_TO_TRAIN)
    buckets = F.lit(None).cast("bigint") if series is None else series.agg(F.count("*")).scalar()
    score = F.lit(None).cast("double") if f1 is None else f1
    status = (
        F.when(F.col("raw_rows") == 0, "no_training_data")
        .when(F.col("raw_rows") < min_raw, "insufficient_data")
        .when(F.lit(bool(gone)), "missing_columns")
        .when(F.col("buckets") < min_buckets, "insufficient_processed_data")
        .otherwise("prerequisites_ok")
    )
    return (
        raw.agg(F.count("*").alias("raw_rows"))
        .withColumn("buckets", buckets)
        .withColumn("f1_score", score)
        .select(
            status.alias("status"), "raw_rows", "buckets", flags.flag(F.col("f1_score") < min_f1).alias("low_f1_warning")
        )
    )


def scoring_readiness(raw: DataFrame, min_raw: int = 100) -> DataFrame:
    return raw.agg(F.count("*").alias("raw_rows")).select(
        F.when(F.col("raw_rows") == 0, "no_data_file")
        .when(F.col("raw_rows") < min_raw, "insufficient_data")
        .otherwise("health_ok")
        .alias("status"),
        "raw_rows",
    )


def score_sanity(df: DataFrame, p: str = "probability", predicted: str = "predicted_label") -> DataFrame:
    """Rows with a probability outside 0–1 or a class other than 0 and 1."""
    x, y = F.col(p), F.col(predicted)
    bad_p = F.count_if((x < 0) | (x > 1) | F.isnan(x) | x.isNull())
    bad_y = F.count_if(~F.coalesce(y.isin(0, 1), F.lit(False)))
    return df.agg(bad_p.alias("bad_probabilities"), bad_y.alias("bad_classes")).withColumn(
        "status",
        F.when(F.col("bad_probabilities") > 0, "invalid_prediction_range")
        .when(F.col("bad_classes") > 0, "invalid_prediction_class")
        .otherwise("validation_success"),
    )


def model_age(runs: DataFrame, now: Column, run_ts: str = "run_ts") -> DataFrame:
    """Status by the age in whole days of the newest run."""
    days = F.col("age_days")
    return (
        runs.agg(F.max(run_ts).alias("newest"))
        .select(clock.whole_days_between(now, F.col("newest")).alias("age_days"))
        .select(
            F.when(days.isNull(), "no_model")
            .when(days > 45, "model_very_old")
            .when(days > 30, "model_old")
            .otherwise("model_healthy")
            .alias("status"),
            "age_days",
        )
    )


def overall_status(statuses: Column, strict: bool = False) -> Column:
    """CRITICAL, WARNING or HEALTHY from an array of component statuses.

    Statuses in neither list count as healthy unless ``strict``.
    """
    warning = WARNING + (OVERLOOKED if strict else [])
    return (
        F.when(F.exists(statuses, lambda s: s.isin(CRITICAL)), "CRITICAL")
        .when(F.exists(statuses, lambda s: s.isin(warning)), "WARNING")
        .otherwise("HEALTHY")
    )


def roll_up(checks: DataFrame, strict: bool = False) -> DataFrame:
    """One row from rows of (component, status)."""
    # The distinct statuses are at most as many as there are status names.
    return checks.agg(F.collect_set("status").alias("statuses")).select(
        overall_status(F.col("statuses"), strict).alias("overall_status"), F.array_sort("statuses").alias("statuses")
    )


def drift_numbers(series: DataFrame, predictions: DataFrame, ts: str = "timestamp", tie: Sequence[str] = ()) -> DataFrame:
    """Spread of recent input and of the predictions, for one scoring run."""
    load = recent_std(series, ["CPU", "RAM"], 100, "bucket_id").select(F.struct("CPU_std", "RAM_std")).scalar()
    return prediction_std(predictions, "probability", ts, tie).withColumns(
        {"cpu_std": load["CPU_std"], "ram_std": load["RAM_std"]}
    )
