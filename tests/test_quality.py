"""Checks, ladders and clean-up rules."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from slowtide.functions import clock, flags
from slowtide.operators import columns, profile, quality, slices, unions
from slowtide.plans.monitoring import health_report

NOW = datetime(2024, 1, 31)
RAW = "timestamp timestamp_ntz, response_time double, CPU double, RAM double, is_error int"


def now():
    return clock.instant("2024-01-31 00:00:00")


def log(spark, ages_h, cpu=50.0, ram=50.0, response=100.0):
    return spark.createDataFrame([(NOW - timedelta(hours=h), response, cpu, ram, 0) for h in ages_h], RAW)


@pytest.mark.parametrize(
    "ages,status,issues",
    [
        ([1, 2], "data_healthy", []),
        ([3, 4], "data_warning", []),
        ([7, 50], "data_quality_issues", ["Data is stale: 7.0 hours old"]),
        ([25, 50], "critical_stale_data", ["Data is stale: 25.0 hours old"]),
        ([1, 1, 1, 2], "data_quality_issues", ["Duplicate timestamps: 2"]),
        ([], "no_data", []),
    ],
)
def test_data_health_ladder(spark, ages, status, issues):
    row = quality.data_health(log(spark, ages), now()).first()
    assert row["status"] == status and row["quality_issues"] == issues and row["records"] == len(ages)


def test_data_health_reports_missing_columns_and_nulls(spark):
    df = log(spark, [1, 2], cpu=None).drop("is_error")
    row = quality.data_health(df, now()).first()
    assert row["quality_issues"] == ["Missing columns: ['is_error']", "Too many missing values in CPU: 2"]


def test_span_is_whole_days(spark):
    row = profile.time_span(log(spark, [1, 47.5]), now()).first()
    assert row["span_days"] == 1 and row["hours_old"] == 1.0


def test_repeated_counts_nulls_as_one_value(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "timestamp int")
    assert df.agg(profile.repeated().alias("r")).first()["r"] == 3


def test_validate(spark):
    df = spark.createDataFrame(
        [(NOW, -1.0, 150.0, None), (NOW, 5.0, -3.0, 40.0)], "timestamp timestamp_ntz, response_time double, CPU double, RAM double"
    )
    row = quality.validate(df).first()
    assert row["issues"] == [
        "Invalid CPU values: 2 records", "Negative response times: 1 records", "High null percentage in: ['RAM']"
    ]
    assert row["is_valid"] is False and row["null_percentages"]["RAM"] == 0.5
    gone = quality.validate(df.drop("CPU", "RAM")).first()["issues"][0]
    assert gone == "Missing columns: ['CPU', 'RAM']"


def test_clean_clips_then_fills(spark):
    df = spark.createDataFrame(
        [(-5.0, 150.0, -1.0), (150.0, 20.0, None), (None, None, 7.0), (50.0, 160.0, 8.0)], "CPU double, RAM double, response_time double"
    )
    rows = quality.clean(df).collect()
    assert [r["CPU"] for r in rows] == [0, 100, 0, 50]
    assert [r["RAM"] for r in rows] == [100, 20, 100, 100]  # the raw median is 150
    assert [r["response_time"] for r in rows] == [0, 0, 7, 8]


def predictions(spark, minutes):
    rows = [(NOW - timedelta(minutes=m), 1 if i % 2 else 0, 0.9 if i % 2 else 0.1) for i, m in enumerate(minutes)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, prediction int, probability double")


@pytest.mark.parametrize(
    "minutes,status",
    [
        ([], "no_predictions"),
        ([2000], "no_recent_predictions"),
        ([5, 100], "low_activity"),
        (list(range(0, 60, 5)), "reduced_activity"),
        (list(range(0, 1440, 5)), "normal_activity"),
    ],
)
def test_activity_ladder(spark, minutes, status):
    assert quality.prediction_activity(predictions(spark, minutes), now()).first()["status"] == status


def test_activity_without_probability(spark):
    row = quality.prediction_activity(predictions(spark, [5, 100]).drop("probability"), now()).first()
    assert row["recent_count"] == 2 and row["avg_probability"] is None and row["delay_prediction_rate"] == 50.0


def test_activity_without_time_column(spark):
    row = quality.prediction_activity(predictions(spark, [1]).drop("timestamp"), now()).first()
    assert row["status"] == "invalid_predictions_format" and row["total_count"] == 1


@pytest.mark.parametrize("days,status", [(10, "model_healthy"), (31, "model_old"), (46, "model_very_old"), (None, "no_model")])
def test_model_age(spark, days, status):
    rows = [] if days is None else [(NOW - timedelta(days=days, hours=1),), (NOW - timedelta(days=400),)]
    assert quality.model_age(spark.createDataFrame(rows, "run_ts timestamp_ntz"), now()).first()["status"] == status


@pytest.mark.parametrize(
    "statuses,plain,strict",
    [
        (["data_healthy", "model_healthy"], "HEALTHY", "HEALTHY"),
        (["data_healthy", "no_model", "low_activity"], "CRITICAL", "CRITICAL"),
        (["data_quality_issues", "model_healthy"], "WARNING", "WARNING"),
        (["reduced_activity", "model_very_old"], "HEALTHY", "WARNING"),
    ],
)
def test_roll_up(spark, statuses, plain, strict):
    checks = spark.createDataFrame(list(enumerate(statuses)), "component int, status string")
    assert quality.roll_up(checks).first()["overall_status"] == plain
    assert quality.roll_up(checks, strict=True).first()["overall_status"] == strict


def test_components_without_a_table_are_not_monitored(spark):
    runs = spark.createDataFrame([], "run_id string, run_ts timestamp_ntz")
    row = health_report(log(spark, []), None, None, now()).first()
    assert (row["model_status"], row["predictions_status"], row["recent_predictions"]) == ("not_monitored", "not_monitored", None)
    assert row["data_status"] != "not_monitored"
    row = health_report(None, None, runs, now()).first()
    assert (row["data_status"], row["model_status"], row["overall_status"]) == ("not_monitored", "no_model", "CRITICAL")
    with pytest.raises(ValueError, match="nothing to report"):
        health_report(None, None, None, now())


def test_health_report_of_nothing(spark):
    runs = spark.createDataFrame([], "run_ts timestamp_ntz")
    row = health_report(log(spark, []), predictions(spark, []), runs, now()).first()
    assert row["overall_status"] == "CRITICAL" and row["data_status"] == "no_data" and row["model_status"] == "no_model"


@pytest.mark.parametrize("n,status", [(0, "no_training_data"), (999, "insufficient_data"), (1000, "prerequisites_ok")])
def test_training_gate(spark, n, status):
    raw = spark.range(n).select(*[F.lit(None).cast("double").alias(c) for c in ("timestamp", "response_time", "CPU", "RAM", "is_error")])
    assert quality.training_readiness(raw).first()["status"] == status
    if n == 1000:
        assert quality.training_readiness(raw.drop("RAM")).first()["status"] == "missing_columns"
        row = quality.training_readiness(raw, spark.range(499), F.lit(0.05)).first()
        assert row["status"] == "insufficient_processed_data" and row["low_f1_warning"] == 1


def test_scoring_gate(spark):
    assert [quality.scoring_readiness(spark.range(n)).first()["status"] for n in (0, 99, 100)] == ["no_data_file", "insufficient_data", "health_ok"]


def test_score_sanity(spark):
    df = spark.createDataFrame([(0.5, 1), (1.5, 0), (None, 2)], "probability double, predicted_label int")
    row = quality.score_sanity(df).first()
    assert (row["bad_probabilities"], row["bad_classes"], row["status"]) == (2, 1, "invalid_prediction_range")


def test_look_up_takes_six_from_an_exact_time_and_five_after_another(spark):
    df = log(spark, range(20, 0, -1))
    def found(target):
        return [r["timestamp"] for r in slices.look_up(df, F.lit(target).cast("timestamp_ntz")).orderBy("timestamp").collect()]

    exact = NOW - timedelta(hours=10)
    assert found(exact) == [exact + timedelta(hours=h) for h in range(6)]
    assert found(exact - timedelta(minutes=1)) == [exact + timedelta(hours=h) for h in range(5)]
    assert found(NOW - timedelta(hours=2)) == [NOW - timedelta(hours=2), NOW - timedelta(hours=1)]
    assert found(NOW) == []


def test_since_latest_includes_the_cutoff(spark):
    assert columns.since_latest(log(spark, [1, 3, 4, 5]), 3).count() == 3


def test_union_on_schema(spark):
    a = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("bad", 2)], "timestamp string, n int")
    b = spark.createDataFrame([(NOW, "x")], "timestamp timestamp_ntz, site string")
    rows = unions.union_on_schema(a, b, {"timestamp": "timestamp_ntz", "n": "int", "site": "string"}).collect()
    assert [r["timestamp"] for r in rows] == [datetime(2024, 1, 1), None, NOW]
    assert [r["site"] for r in rows] == [None, None, "x"]
    with pytest.raises(ValueError, match="Missing columns"):
        unions.union_strict(a, b, ["timestamp", "n"])
    assert unions.union_counts(a, b, unions.union_all_columns(a.drop("timestamp"), b)).first()["complete"] == 1


def test_null_flags_and_clip(spark):
    row = spark.createDataFrame([(None, None)], "x double, u string").select(
        flags.is_delayed(F.col("x")).alias("d"), flags.is_error(F.col("x")).alias("e"), flags.clip(F.col("x"), 0, 100).alias("c"),
        flags.path_depth(F.col("u")).alias("p"), flags.last_segment(F.col("u")).alias("s"), flags.confidence_score(F.lit(0.2)).alias("k"),
    ).first()
    assert (row["d"], row["e"], row["c"], row["p"], row["s"], row["k"]) == (0, 0, None, 0, "", 0.8)


def test_time_functions(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 6, 23, 59, 59),)], "t timestamp_ntz")
    t = F.col("t")
    row = df.select(
        clock.day_of_week(t).alias("dow"), clock.is_weekend(t).alias("w"), clock.shift_zone(t).alias("ist"), clock.time_of_day(t).alias("s"),
        clock.is_peak_hour(F.hour(t)).alias("p"), clock.from_date_and_time(F.lit("2024-02-30"), F.lit("00:00:00")).alias("bad"),
        clock.from_date_and_time(F.lit("2024-02-29"), F.lit("01:02:03")).alias("good"),
    ).first()
    assert row["dow"] == 5 and row["w"] == 1 and row["ist"] == datetime(2024, 1, 7, 5, 29, 59) and row["s"] == "23:59:59"
    assert row["p"] == 0 and row["bad"] is None and row["good"] == datetime(2024, 2, 29, 1, 2, 3)


def test_histogram_matches_numpy(spark):
    import numpy as np

    xs = [0.0, 0.1, 0.2, 0.3, 0.6, 0.7, 0.7, 0.9, 1.0, 1.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for bins in (3, 7, 10, 50):
        counts, edges = np.histogram(xs, bins=bins)
        rows = profile.histogram(df, "x", bins).orderBy("bin").collect()
        assert [r["n"] for r in rows] == list(counts)
        np.testing.assert_allclose([r["bin_low"] for r in rows], edges[:-1])
    assert [r["n"] for r in profile.histogram(df.where("x = 1.0"), "x", 4).orderBy("bin").collect()] == list(np.histogram([1.0, 1.0], bins=4)[0])
    assert [r["n"] for r in profile.histogram(df.where("x > 5"), "x", 4).collect()] == [0, 0, 0, 0]


def test_density_integrates_to_one(spark):
    import numpy as np

    xs = np.random.default_rng(0).normal(10, 3, 500)
    df = spark.createDataFrame([(float(x), 4.0) for x in xs], "x double, constant double")
    rows = profile.density(df, ["x", "constant"]).orderBy("point").collect()
    assert len(rows) == 200 and {r["column_name"] for r in rows} == {"x"}
    at, y = np.array([r["at"] for r in rows]), np.array([r["density"] for r in rows])
    assert abs(np.trapezoid(y, at) - 1) < 0.01
    h = xs.std(ddof=1) * 500 ** -0.2
    want = np.exp(-0.5 * ((at[:, None] - xs[None, :]) / h) ** 2).sum(axis=1) / (500 * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(y, want, rtol=1e-9)
