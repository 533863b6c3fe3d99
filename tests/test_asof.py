"""As-of join against pandas.merge_asof and the hand-made edge cases."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slowtide.operators.asof import asof_join

BASE = datetime(2024, 1, 1)


def at(minute: float, second: float = 0) -> datetime:
    return BASE + timedelta(minutes=minute, seconds=second)


def frames(spark, left, right):
    l = spark.createDataFrame(left, "id int, t timestamp_ntz")
    r = spark.createDataFrame(right, "n int, t timestamp_ntz, v double")
    return l, r


def one(spark, left_time, right, **options):
    l, r = frames(spark, [(1, left_time)], [(i, t, v) for i, (t, v) in enumerate(right)])
    rows = asof_join(l, r, "t", tie=["n"], **options).collect()
    assert len(rows) == 1
    return rows[0]["v"]


def test_tie_in_distance_takes_the_last_earlier_row(spark):
    assert one(spark, at(0, 10), [(at(0, 5), 1.0), (at(0, 5), 2.0), (at(0, 15), 3.0)]) == 2.0


def test_forward_duplicates_take_the_first(spark):
    assert one(spark, at(0, 10), [(at(0, 15), 7.0), (at(0, 15), 8.0)]) == 7.0


def test_exact_duplicates_take_the_last(spark):
    assert one(spark, at(0, 20), [(at(0, 20), 4.0), (at(0, 20), 5.0)]) == 5.0


def test_exact_duplicates_looking_ahead_take_the_first(spark):
    assert one(spark, at(0, 20), [(at(0, 20), 4.0), (at(0, 20), 5.0)], direction="forward") == 4.0


def test_out_of_tolerance_is_null_and_limit_is_inclusive(spark):
    right = [(at(0, 20), 1.0)]
    assert one(spark, at(0, 40), right, tolerance=timedelta(seconds=5)) is None
    assert one(spark, at(0, 25), right, tolerance=timedelta(seconds=5)) == 1.0


def test_null_payload_stays_null(spark):
    assert one(spark, at(0, 20), [(at(0, 20), None), (at(0, 21), 9.0)]) is None


def test_null_left_time_is_an_error(spark):
    l, r = frames(spark, [(1, None)], [(1, at(0), 1.0)])
    with pytest.raises(Exception, match="as-of join: null"):
        asof_join(l, r, "t").collect()


def test_shared_names_get_suffixes(spark):
    l = spark.createDataFrame([(1, at(0), 5.0)], "id int, t timestamp_ntz, v double")
    r = spark.createDataFrame([(at(0), 6.0)], "t timestamp_ntz, v double")
    assert asof_join(l, r, "t").columns == ["id", "t", "v_x", "v_y"]


def test_empty_right_side_keeps_left_rows(spark):
    l, r = frames(spark, [(1, at(0)), (2, at(1))], [])
    assert [row["v"] for row in asof_join(l, r, "t").collect()] == [None, None]


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 3])
@pytest.mark.parametrize("rows_per_segment", [3, 40, 10**6])
def test_equals_pandas(spark, direction, tolerance, rows_per_segment):
    rng = np.random.default_rng(5)
    # Few distinct seconds, so equal times and equal distances are common; a third of the left rows share one time.
    seconds = np.concatenate([rng.integers(0, 120, 120), np.full(60, 77)])
    left = pd.DataFrame({"id": range(180), "t": pd.to_datetime(BASE) + pd.to_timedelta(seconds, "s")})
    left = left.sort_values(["t", "id"]).reset_index(drop=True)
    right = pd.DataFrame({"t": pd.to_datetime(BASE) + pd.to_timedelta(np.sort(rng.integers(20, 100, 30)), "s")})
    right["n"] = range(30)
    right["v"] = np.where(right["n"] % 5 == 0, np.nan, right["n"] * 1.5)
    limit = None if tolerance is None else pd.Timedelta(seconds=tolerance)
    want = pd.merge_asof(left, right, on="t", direction=direction, tolerance=limit).set_index("id")["n"]
    l, r = frames(
        spark,
        [(int(i), t.to_pydatetime()) for i, t in zip(left["id"], left["t"])],
        [(int(n), t.to_pydatetime(), None if np.isnan(v) else float(v)) for n, t, v in zip(right["n"], right["t"], right["v"])],
    )
    joined = asof_join(
        l, r, "t", direction=direction, tolerance=None if tolerance is None else timedelta(seconds=tolerance),
        tie=["n"], rows_per_segment=rows_per_segment,
    )
    got = {row["id"]: row["n"] for row in joined.collect()}
    assert len(got) == 180 and joined.count() == 180
    assert got == {i: None if np.isnan(n) else int(n) for i, n in want.items()}


@pytest.mark.parametrize("rows_per_segment", [4, 10**6])
def test_keys_equal_pandas(spark, rows_per_segment):
    rng = np.random.default_rng(8)
    left = pd.DataFrame({"id": range(150), "t": pd.to_datetime(BASE) + pd.to_timedelta(np.sort(rng.integers(0, 200, 150)), "s"), "site": rng.choice(["a", "a", "b", "c"], 150)})
    right = pd.DataFrame({"t": pd.to_datetime(BASE) + pd.to_timedelta(np.sort(rng.integers(0, 200, 40)), "s"), "site": rng.choice(["a", "b"], 40), "n": range(40)})
    want = pd.merge_asof(left, right, on="t", by="site", direction="nearest").set_index("id")["n"]
    l = spark.createDataFrame([(int(a), b.to_pydatetime(), c) for a, b, c in left.itertuples(index=False)], "id int, t timestamp_ntz, site string")
    r = spark.createDataFrame([(a.to_pydatetime(), b, int(c)) for a, b, c in right.itertuples(index=False)], "t timestamp_ntz, site string, n int")
    got = {row["id"]: row["n"] for row in asof_join(l, r, "t", by=["site"], tie=["n"], rows_per_segment=rows_per_segment).collect()}
    assert got == {i: None if np.isnan(n) else int(n) for i, n in want.items()}


def test_no_pairwise_join_in_the_plan(spark):
    l = spark.range(1000).select(F.col("id").cast("int"), (F.lit(BASE).cast("timestamp_ntz") + F.col("id") * F.expr("INTERVAL '1' SECOND")).alias("t"))
    plan = asof_join(l, l.withColumnRenamed("id", "n"), "t", rows_per_segment=100)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan.split("Window")[0]


def test_hot_time_is_split_in_the_last_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        second = F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("id") % 5000)
        left = spark.range(0, 120_000, 1, 8).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"),
            (F.lit(BASE).cast("timestamp_ntz") + second * F.expr("INTERVAL '1' SECOND")).alias("t"),
        )
        right = spark.range(5000).select(
            F.col("id").alias("n"), (F.lit(BASE).cast("timestamp_ntz") + F.col("id") * F.expr("INTERVAL '1' SECOND")).alias("t")
        )
        done = asof_join(left, right, "t").selectExpr("count(*) AS rows", "max(hash(id, payload, n)) AS h")
        assert done.collect()[0]["rows"] == 120_000
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
