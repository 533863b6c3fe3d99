"""Ranges of any number, and what they hand on."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slowtide.functions import clock
from slowtide.operators import evaluation
from slowtide.operators.asof import asof_join, neighbours
from slowtide.operators.chunked import forward_fill_rows
from slowtide.operators.segments import build_index, handed_on, summed_above

BASE = datetime(2024, 1, 1)


def numbers(spark, values, ties=None):
    ties = range(len(values)) if ties is None else ties
    return spark.createDataFrame([(None if x is None else float(x), float(t)) for x, t in zip(values, ties, strict=True)], "x double, t double").repartition(4)


@pytest.mark.parametrize("first_level", [1024, 16, 2])
def test_ranges_are_balanced_and_ordered(spark, first_level):
    values = np.random.default_rng(1).exponential(100, 6000)
    df = numbers(spark, values)
    index = build_index(df, "x", 20, first_level=first_level)
    assert (index.finer is not None) == (first_level < 300) and len(index.cuts) < first_level
    rows = index.place(df).groupBy("_segment").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("_segment").collect()
    assert max(r["n"] for r in rows) <= 60 and len(rows) > 200
    assert all(a["hi"] < b["lo"] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("first_level", [1024, 8])
def test_a_hot_value_is_cut_by_its_tie(spark, first_level):
    rng = np.random.default_rng(2)
    values = np.concatenate([np.full(2000, 50.0), np.full(900, 0.0), rng.integers(0, 100, 3000)])
    df = numbers(spark, rng.permutation(values))
    index = build_index(df, "x", 50, tie="t", first_level=first_level)
    placed = index.place(df)
    assert placed.columns == ["x", "t", "_coarse", "_segment"]
    rows = placed.groupBy("_segment").agg(
        F.count("*").alias("n"), F.min(F.struct("x", "t")).alias("lo"), F.max(F.struct("x", "t")).alias("hi")
    ).orderBy("_segment").collect()
    assert max(r["n"] for r in rows) <= 250
    assert all(tuple(a["hi"]) < tuple(b["lo"]) for a, b in zip(rows, rows[1:]) if a["hi"][0] == b["lo"][0] and a["n"] + b["n"] > 300)
    assert all(a["hi"][0] <= b["lo"][0] for a, b in zip(rows, rows[1:]))
    # Without a tie the value stays whole.
    whole = build_index(df, "x", 50, first_level=first_level).place(df)
    assert whole.where("x = 50").select("_segment").distinct().count() == 1


def test_one_range_and_nulls(spark):
    index = build_index(numbers(spark, [3, 1, None]), "x", 10)
    assert index.single and index.place(numbers(spark, [5, None])).select("_segment").distinct().collect() == [(0,)]
    assert build_index(numbers(spark, []), "x", 1).single


@pytest.mark.parametrize("first_level", [64, 4])
def test_sums_and_values_pass_over_ranges(spark, first_level):
    rng = np.random.default_rng(3)
    df = numbers(spark, rng.random(500).round(3)).withColumn("k", F.when(F.col("t") % 5 != 0, F.col("t") % 3))
    index = build_index(df, "x", 20, first_level=first_level)
    placed = index.place(df).toPandas()
    totals = index.place(df).groupBy("_coarse", "_segment").agg(F.count("*").alias("n"))
    got = {r["_segment"]: r["above_n"] for r in summed_above(totals, ["n"], index).collect()}
    assert got == {s: int((placed["_segment"] > s).sum()) for s in placed["_segment"].unique()}
    edges = index.place(df).groupBy("k", "_coarse", "_segment").agg(F.max("t").alias("tail"), F.when(F.count("*") > 1, F.min("t")).alias("head"))
    rows = {(r["k"], r["_segment"]): (r["tail"], r["head"]) for r in edges.collect()}
    passed = {(r["k"], r["_segment"]): (r["tail"], r["head"]) for r in handed_on(edges, ["k"], {"tail": False, "head": True}, index).collect()}
    for (k, s), got in passed.items():
        own = sorted((x, v) for (key, x), v in rows.items() if key == k)
        assert got[0] == next((v[0] for x, v in reversed(own) if x < s), None)
        assert got[1] == next((v[1] for x, v in own if x > s and v[1] is not None), None)
    assert set(passed) == set(rows)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_asof_with_a_tiny_first_level_equals_pandas(spark, direction):
    rng = np.random.default_rng(4)
    left = pd.DataFrame({"id": range(400), "t": pd.to_datetime(BASE) + pd.to_timedelta(np.sort(rng.integers(0, 900, 400)), "s"), "site": rng.choice(list("aabc"), 400)})
    right = pd.DataFrame({"t": pd.to_datetime(BASE) + pd.to_timedelta(np.sort(rng.integers(300, 600, 60)), "s"), "site": rng.choice(list("ab"), 60), "n": range(60)})
    l = spark.createDataFrame([(int(a), b.to_pydatetime(), c) for a, b, c in left.itertuples(index=False)], "id int, t timestamp_ntz, site string")
    r = spark.createDataFrame([(a.to_pydatetime(), b, int(c)) for a, b, c in right.itertuples(index=False)], "t timestamp_ntz, site string, n int")
    for by in ([], ["site"]):
        want = pd.merge_asof(left, right.drop(columns=[] if by else ["site"]), on="t", by=by or None, direction=direction).set_index("id")["n"]
        joined = asof_join(l, r if by else r.drop("site"), "t", by=by, tie=["n"], direction=direction, rows_per_segment=9, first_level=4)
        assert {x["id"]: x["n"] for x in joined.collect()} == {i: None if np.isnan(n) else int(n) for i, n in want.items()}


def test_keys_hand_on_no_more_rows_than_they_have(spark):
    # 10,000 keys over some hundred ranges: keys times ranges would be millions of rows.
    rows = spark.range(20_000).select(
        (F.col("id") % 10_000).alias("k"), (F.hash("id") % 100_000).cast("long").alias("at"), (F.col("id") % 2).cast("int").alias("side")
    )
    index = build_index(rows, "at", 50, first_level=64)
    cut = index.place(rows.withColumns({"back": F.struct("at"), "ahead": F.struct("at")}))
    assert index.place(rows).select("_segment").distinct().count() > 200
    assert neighbours(cut, ["k"], index).count() <= 20_000


@pytest.mark.parametrize("first_level", [1024, 4])
@pytest.mark.parametrize("rows_per_segment", [25, 10**6])
def test_fill_over_irregular_times_equals_pandas(spark, rows_per_segment, first_level):
    rng = np.random.default_rng(6)
    n = 600
    # A third of the rows share one time, and long stretches have no value.
    seconds = np.concatenate([np.full(200, 500.0), rng.exponential(400, n - 200).round()])
    frame = pd.DataFrame({"id": rng.permutation(n), "t": seconds, "site": rng.choice(["a", "b", None], n)})
    frame["cpu"] = np.where(rng.random(n) < 0.9, np.nan, rng.random(n).round(3))
    frame["ram"] = np.where(frame["t"] < 200, np.nan, np.where(rng.random(n) < 0.5, np.nan, 7.0))
    df = spark.createDataFrame(
        [(int(i), BASE + timedelta(seconds=t), s, None if np.isnan(c) else c, None if np.isnan(r) else r) for i, t, s, c, r in frame.itertuples(index=False)],
        "id long, t timestamp_ntz, site string, cpu double, ram double",
    ).repartition(3)
    ordered = frame.sort_values(["t", "id"])
    for keys in ([], ["site"]):
        part = ordered.groupby("site", dropna=False) if keys else ordered
        want = {i: v for i, v in zip(ordered["id"], part[["cpu", "ram"]].ffill().itertuples(index=False), strict=True)}
        got = forward_fill_rows(df, ["cpu", "ram"], "t", "id", keys, rows_per_segment=rows_per_segment, first_level=first_level)
        assert got.columns == df.columns
        for r in got.collect():
            assert (r["cpu"], r["ram"]) == tuple(None if np.isnan(v) else v for v in want[r["id"]])


def test_rows_per_task_of_a_fill_are_bounded(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id")).alias("s")).select(
        "id", (F.lit(BASE).cast("timestamp_ntz") + F.col("s") * F.expr("INTERVAL '1' SECOND")).alias("t")
    )
    at = df.withColumn("at", clock.epoch_micros(F.col("t")))
    placed = build_index(at, "at", 100, tie="id", first_level=32).place(at)
    assert placed.groupBy("_segment").count().agg(F.max("count")).first()[0] <= 400


def test_rows_without_a_time_or_any_row(spark):
    df = spark.createDataFrame([(1, BASE, 5.0), (2, None, None), (3, None, 6.0), (4, None, None)], "id long, t timestamp_ntz, v double")
    got = {r["id"]: r["v"] for r in forward_fill_rows(df, ["v"], "t", "id", rows_per_segment=1).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: 6.0, 4: 6.0}
    assert forward_fill_rows(df.limit(0), ["v"], "t", "id").count() == 0


def test_curve_with_a_tiny_first_level(spark):
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(int(y), float(p)) for y, p in zip(rng.integers(0, 2, 800), rng.random(800).round(4), strict=True)], "true_label int, probability double")
    plain = evaluation.pr_curve(df).toPandas().sort_values("threshold").reset_index(drop=True)
    cut = evaluation.pr_curve(df, rows_per_segment=10, first_level=4).toPandas().sort_values("threshold").reset_index(drop=True)
    pd.testing.assert_frame_equal(plain, cut)
