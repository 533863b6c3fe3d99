"""Sources, sinks, run records, session folder."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.functions import clock
from slowtide.operators import columns, runs
from slowtide.session import fresh_folder, shared_folder
from slowtide.sources import readers, writers


def test_broken_csv_lines_become_nulls(spark, tmp_path):
    (tmp_path / "log.csv").write_text(
        "event_id,timestamp,response_time,CPU,RAM,status_code,is_error,site\n"
        "1,2024-01-01T00:00:00.123456,10.5,1,2,200,0,a\n"
        "2,not a time,abc,,,200,0,b\n"
    )
    rows = readers.read_csv(spark, str(tmp_path / "log.csv"), schemas.REQUEST_LOG, keep_corrupt=True).orderBy("event_id").collect()
    assert rows[0]["timestamp"] == datetime(2024, 1, 1, 0, 0, 0, 123456) and rows[0]["_corrupt_record"] is None
    assert rows[1]["timestamp"] is None and rows[1]["response_time"] is None and rows[1]["_corrupt_record"].startswith("2,not")


def test_jdbc_options():
    options = readers.jdbc_options("jdbc:x", partition_column="datetime", lower="2024-01-01", upper="2024-02-01", partitions=16)
    assert options["numPartitions"] == "16" and options["dbtable"] == "system_metrics" and options["partitionColumn"] == "datetime"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", partition_column="datetime")


def test_database_scans_run_in_ranges_of_time_by_default():
    newest = datetime(2024, 1, 31)
    options = readers.in_ranges(readers.jdbc_options("jdbc:x"), newest, 24)
    assert (options["partitionColumn"], options["numPartitions"]) == ("datetime", "8")
    assert (options["lowerBound"], options["upperBound"]) == ("2024-01-30 00:00:00", "2024-01-31 00:00:00")
    own = readers.jdbc_options("jdbc:x", partition_column="id", lower="0", upper="9", partitions=2)
    assert readers.in_ranges(own, newest, 24) == own


def test_all_kinds_of_source_give_one_schema(spark, tmp_path):
    sql = "datetime timestamp_ntz, time_taken double, CPU double, RAM double, sc_status int, is_error int"
    database = spark.createDataFrame([(datetime(2024, 1, 30, 12), 5.0, 1.0, 2.0, 200, 0), (datetime(2024, 1, 1), 5.0, 1.0, 2.0, 200, 0)], sql)
    recent = readers.recent_window(database, clock.instant("2024-01-31 00:00:00"), 24)
    rows = readers.as_request_log(recent)
    writers.write_csv(rows, str(tmp_path / "c"))
    writers.write_parquet(rows, str(tmp_path / "p"))
    kinds = [readers.load(spark, kind, {"path": str(tmp_path / kind[0])}) for kind in ("csv", "parquet")]
    assert all(k.dtypes == rows.dtypes for k in kinds) and rows.columns == schemas.REQUEST_LOG.names
    for got in (rows, *kinds):
        assert [tuple(r) for r in got.collect()] == [(None, datetime(2024, 1, 30, 12), 5.0, 1.0, 2.0, 200, 0, None)]
    assert "Sort" not in recent._jdf.queryExecution().executedPlan().toString()


def test_results_go_where_the_configuration_says(spark, tmp_path):
    row = spark.createDataFrame([(datetime(2024, 1, 1), 1, 0.9, "High")], schemas.PREDICTIONS)
    writers.save_results(row, "parquet", {"path": str(tmp_path / "p")}, "r")
    assert writers.read_predictions(spark, str(tmp_path / "p")).count() == 1
    with pytest.raises(ValueError, match="unknown sink"):
        writers.save_results(row, "pigeon", {}, "r")


def test_unknown_source_is_refused(spark):
    with pytest.raises(ValueError, match="unknown source"):
        readers.load(spark, "carrier pigeon", {})


def test_recent_window_prunes_and_filters_in_the_scan(spark, tmp_path):
    df = spark.range(100).select(
        (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.col("id") * F.expr("INTERVAL '1' HOUR")).alias("datetime"),
        *[F.lit(1.0).alias(c) for c in ("time_taken", "CPU", "RAM")], F.lit(200).alias("sc_status"), F.lit(0).alias("is_error"), F.lit("x").alias("extra"),
    )
    writers.write_parquet(df, str(tmp_path / "m"))
    recent = readers.recent_window(spark.read.parquet(str(tmp_path / "m")), clock.instant("2024-01-05 03:00:00"), 24)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(datetime" in plan and "extra" not in plan
    assert recent.count() == 25


def test_appending_keeps_earlier_predictions(spark, tmp_path):
    path = str(tmp_path / "p")
    row = spark.createDataFrame([(datetime(2024, 1, 1), 1, 0.9, "High")], schemas.PREDICTIONS)
    for run in ("2024-01-31T00:00:00", "b/c", "b/c"):
        writers.append_predictions(row, path, run)
    assert readers.read_written(spark, path).count() == 2 and writers.read_predictions(spark, path).schema == schemas.PREDICTIONS


def test_reports_are_kept_by_date(spark, tmp_path):
    path = str(tmp_path / "r")
    report = spark.createDataFrame([("HEALTHY",)], "overall_status string")
    for day in ("2024-01-30 10:00:00", "2024-01-31 10:00:00"):
        writers.append_report(report, path, clock.instant(day))
    got = spark.read.schema("overall_status string, monitoring_date string").json(path)
    assert sorted(r["monitoring_date"] for r in got.collect()) == ["2024-01-30", "2024-01-31"]


def test_runs_and_history(spark, tmp_path):
    path = str(tmp_path / "runs")
    for name, f1 in (("a", 0.4), ("b", 0.6), ("c", 0.6), ("d", None)):
        one = spark.createDataFrame([(name, f1)], "id string, f1 double")
        runs.log_run(spark, path, runs.run_rows(one, F.col("id"), clock.instant("2024-01-01 00:00:00"), {"epochs": F.lit(10)}, {"final_f1": F.col("f1")}))
    assert runs.best_run(runs.read_runs(spark, path)).first()["run_id"] == "b"
    assert runs.best_run(runs.read_runs(spark, path), "unheard_of").first()["run_id"] == "a"
    runs.log_history(spark, path, "a", {"train_loss": [0.7, 0.5], "val_loss": [0.8]})
    assert [(r["metric"], r["step"], r["value"]) for r in runs.read_history(spark, path).orderBy("metric", "step").collect()] == [
        ("train_loss", 0, 0.7), ("train_loss", 1, 0.5), ("val_loss", 0, 0.8)
    ]


def test_label_must_not_leak(spark):
    df = spark.createDataFrame([(1, 2)], "CPU int, Delay_Detected int")
    assert columns.available_features(df, ["CPU", "RAM"]) == ["CPU"]
    with pytest.raises(ValueError, match="leak"):
        columns.available_features(df, ["CPU", "Delay_Detected"])
    with pytest.raises(ValueError, match="none of the features"):
        columns.available_features(df, ["RAM"])


def test_fresh_folders_lie_in_the_named_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert named is None or folder == named.rstrip("/")
    assert fresh_folder(spark, "x").startswith(folder) and fresh_folder(spark, "x") != fresh_folder(spark, "x")
