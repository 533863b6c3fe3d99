"""Curves, thresholds, calibration and reports against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from slowtide.functions import flags
from slowtide.operators import evaluation


def scored(spark, labels, ps):
    rows = [(int(y), float(p)) for y, p in zip(labels, ps)]
    df = spark.createDataFrame(rows, "true_label int, probability double")
    return evaluation.predict_at(df, 0.5)


def brute_curve(y, p):
    y, p = np.asarray(y), np.asarray(p)
    points = {}
    for t in np.unique(p):
        hit = p >= t
        points[t] = (y[hit].mean(), y[hit].sum() / y.sum() if y.sum() else 1.0)
    return points


@pytest.mark.parametrize("rows_per_segment", [5, 50, 10**6])
@pytest.mark.parametrize("digits", [1, 6])
def test_curve_equals_brute_force(spark, rows_per_segment, digits):
    rng = np.random.default_rng(digits)
    p = rng.random(300).round(digits)
    # A third of the rows share one score.
    p[:100] = 0.4
    y = (rng.random(300) < p).astype(int)
    rows = evaluation.pr_curve(scored(spark, y, p), rows_per_segment=rows_per_segment).collect()
    want = brute_curve(y, p)
    got = {r["threshold"]: (r["precision"], r["recall"]) for r in rows}
    assert got.pop(None) == (1.0, 0.0)
    assert set(got) == set(want) and len(rows) == len(want) + 1
    for t, point in want.items():
        assert got[t] == pytest.approx(point)


def test_curve_without_positives(spark):
    rows = evaluation.pr_curve(scored(spark, [0, 0], [0.1, 0.9])).collect()
    assert {(r["precision"], r["recall"]) for r in rows if r["threshold"] is not None} == {(0.0, 1.0)}


def test_best_threshold_is_the_first_maximum(spark):
    curve = spark.createDataFrame(
        [(0.2, 0.5, 1.0), (0.4, 1.0, 0.5), (0.6, 1.0, 0.25), (None, 1.0, 0.0)], "threshold double, precision double, recall double"
    )
    row = evaluation.best_threshold(curve).first()
    assert row["best_f1_threshold"] == 0.2 and row["best_f1_score"] == pytest.approx(2 / 3)


def test_calibration_edges(spark):
    rows = evaluation.calibration(scored(spark, [1, 1, 1, 1], [0.3, 0.6, 0.7, 1.0])).orderBy("bin").collect()
    assert [r["bin"] for r in rows if r["n"]] == [2, 5, 6]
    assert [r["positive_share"] for r in rows] == [0, 0, 1, 0, 0, 1, 1, 0, 0, 0]


def test_probability_one_is_in_no_range(spark):
    rows = evaluation.range_counts(scored(spark, [1] * 6, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])).collect()
    assert [r["n"] for r in rows] == [1] * 5


def test_report_and_scores(spark):
    y, yhat = [0, 0, 0, 1, 1, 1, 1, 1], [0, 1, 0, 1, 1, 0, 1, 1]
    df = spark.createDataFrame(list(zip(y, yhat)), "true_label int, predicted_label int")
    cells = evaluation.scores(evaluation.confusion(df)).first()
    assert (cells["tn"], cells["fp"], cells["fn"], cells["tp"]) == (2, 1, 1, 4)
    assert cells["accuracy"] == 0.75 and cells["precision"] == 0.8 and cells["recall"] == 0.8 and cells["f1_score"] == pytest.approx(0.8)
    report = {r["class"]: r for r in evaluation.class_report(df).collect()}
    assert report["0"]["precision"] == pytest.approx(2 / 3) and report["0"]["support"] == 3
    assert report["macro avg"]["recall"] == pytest.approx((2 / 3 + 0.8) / 2)
    assert report["weighted avg"]["precision"] == pytest.approx((2 / 3 * 3 + 0.8 * 5) / 8)


def test_scores_are_zero_where_undefined(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "true_label int, predicted_label int")
    row = evaluation.scores(evaluation.confusion(df)).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1_score"]) == (1.0, 0.0, 0.0, 0.0)


def test_confidence_numbers(spark):
    df = scored(spark, [1, 0, 0, 1], [0.9, 0.95, 0.1, 0.05])
    row = evaluation.confidence_accuracy(df).first()
    assert (row["high_confidence_predictions"], row["low_confidence_predictions"]) == (2, 2)
    assert row["high_confidence_accuracy"] == pytest.approx(0.5) and row["low_confidence_accuracy"] == pytest.approx(0.5)
    stats = evaluation.confidence_stats(evaluation.details(df)).first()
    assert stats["max_confidence"] == 0.95 and stats["class_1_mean_prob"] == pytest.approx(0.475)
    assert evaluation.summary(df).first()["std_prediction_probability"] == pytest.approx(np.std([0.9, 0.95, 0.1, 0.05]))


def test_confidence_labels(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.2, 0.25, 0.45, 0.7, 0.9)], "p double")
    rows = df.select(flags.confidence_label(F.col("p")).alias("a"), flags.confidence_label_shifted(F.col("p")).alias("b")).collect()
    assert [r["a"] for r in rows] == ["High", "Medium" if abs(0.2 - 0.5) <= 0.3 else "High", "Medium", "Low", "Medium", "High"]
    assert [r["b"] for r in rows] == ["High", "High", "High", "Medium" if abs(0.45 - 0.5) > 0.1 else "Low", "Medium", "Medium"]


def test_infinite_and_missing_values_become_finite(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),), (1.5,)], "x double")
    got = [r[0] for r in df.select(flags.finite(F.col("x"))).collect()]
    assert got == [0.0, 0.0, np.finfo(float).max, -np.finfo(float).max, 1.5]
