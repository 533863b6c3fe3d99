"""Evaluation of scored rows; a score table of any size is reduced in one or two passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.functions import flags
from slowtide.operators.segments import FIRST_LEVEL, ROWS_PER_SEGMENT, build_index, summed_above
from slowtide.session import durable

# Probability ranges, left-closed and right-open.
RANGES = [(0.0, 0.2), (0.2, 0.4), (0.4, 0.6), (0.6, 0.8), (0.8, 1.0)]


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_counts(label: Column, predicted: Column) -> dict[str, Column]:
    return {
        "tn": F.count_if((label == 0) & (predicted == 0)),
        "fp": F.count_if((label == 0) & (predicted == 1)),
        "fn": F.count_if((label == 1) & (predicted == 0)),
        "tp": F.count_if((label == 1) & (predicted == 1)),
    }


def confusion(df: DataFrame, label: str = "true_label", predicted: str = "predicted_label") -> DataFrame:
    """One row: the four cells and their share of all rows."""
    cells = confusion_counts(F.col(label), F.col(predicted))
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return df.agg(*[c.alias(n) for n, c in cells.items()]).select(
        *cells, *[_ratio(F.col(n), total).alias(f"{n}_share") for n in cells]
    )


def scores(cells: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of confusion rows; 0 where undefined."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return cells.withColumns(
        {
            "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def class_report(df: DataFrame, label: str = "true_label", predicted: str = "predicted_label") -> DataFrame:
    """Rows ``0``, ``1``, ``accuracy``, ``macro avg`` and ``weighted avg``."""
    c = confusion(df, label, predicted)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    n = tp + fp + fn + tn

    def measures(hit: Column, wrong: Column, missed: Column) -> tuple[Column, Column, Column, Column]:
        return (
            _ratio(hit, hit + wrong),
            _ratio(hit, hit + missed),
            _ratio(2 * hit, 2 * hit + wrong + missed),
            hit + missed,
        )

    zero, one = measures(tn, fn, fp), measures(tp, fp, fn)
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [_ratio(a * zero[3] + b * one[3], n) for a, b in zip(zero[:3], one[:3])]
    accuracy = _ratio(tp + tn, n)

    def row(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"), support.alias("support")
        )

    return c.select(
        F.inline(
            F.array(
                row("0", *zero),
                row("1", *one),
                row("accuracy", accuracy, accuracy, accuracy, n),
                row("macro avg", *macro, n),
                row("weighted avg", *weighted, n),
            )
        )
    )


def pr_curve(
    df: DataFrame,
    label: str = "true_label",
    p: str = "probability",
    rows_per_segment: int = ROWS_PER_SEGMENT,
    first_level: int = FIRST_LEVEL,
) -> DataFrame:
    """Precision and recall at every distinct score, predicting 1 where ``p >= threshold``.

    The input is read twice: a sketch finds balanced ranges of the scores, then the rows are counted per
    distinct score. Each range runs from its top down, starting from the totals of the ranges above. The
    end point (precision 1, recall 0) has a null threshold.
    """
    rows = df.where(F.col(p).isNotNull()).select(
        F.col(p).cast("double").alias("threshold"), F.col(label).cast("bigint").alias("pos")
    )
    index = build_index(rows, "threshold", rows_per_segment, first_level=first_level)
    counted = durable(
        index.place(rows).groupBy("_coarse", "_segment", "threshold").agg(F.count("*").alias("predicted"), F.sum("pos").alias("tp"))
    )
    totals = counted.groupBy("_coarse", "_segment").agg(F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    positives = totals.agg(F.sum("tp")).first()[0]
    inside = Window.partitionBy("_segment").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    running = counted.withColumns({"predicted": F.sum("predicted").over(inside), "tp": F.sum("tp").over(inside)})
    if not index.single:
        above = summed_above(totals, ["predicted", "tp"], index)
        running = running.join(above, "_segment").withColumns(
            {"predicted": F.col("predicted") + F.col("above_predicted"), "tp": F.col("tp") + F.col("above_tp")}
        )
    points = running.select(
        "threshold",
        (F.col("tp") / F.col("predicted")).alias("precision"),
        (F.col("tp") / F.lit(positives)).alias("recall") if positives else F.lit(1.0).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def best_threshold(curve: DataFrame) -> DataFrame:
    """Threshold of the highest F1, the lowest one at a tie."""
    p, r = F.col("precision"), F.col("recall")
    return (
        curve.where(F.col("threshold").isNotNull())
        .withColumn("f1", 2 * p * r / (p + r + F.lit(1e-12)))
        .agg(
            F.max_by("threshold", F.struct("f1", (-F.col("threshold")).alias("first"))).alias("best_f1_threshold"),
            F.max("f1").alias("best_f1_score"),
        )
    )


def predict_at(df: DataFrame, threshold: float | Column, p: str = "probability") -> DataFrame:
    """Class 1 strictly above the threshold."""
    return df.withColumn("predicted_label", flags.decision(F.col(p), threshold))


def range_counts(df: DataFrame, p: str = "probability") -> DataFrame:
    """Rows per range of RANGES; a probability of exactly 1 is in none."""
    x = F.col(p)
    counted = df.agg(*[F.count_if((x >= lo) & (x < hi)).alias(f"r{i}") for i, (lo, hi) in enumerate(RANGES)])
    rows = [
        F.struct(F.lit(f"{lo:.1f}-{hi:.1f}").alias("range"), F.col(f"r{i}").alias("n"))
        for i, (lo, hi) in enumerate(RANGES)
    ]
    return counted.select(F.inline(F.array(*rows)))


def calibration(df: DataFrame, label: str = "true_label", p: str = "probability", bins: int = 10) -> DataFrame:
    """Share of positives per probability bin; 0 for an empty bin."""
    edges = [i * (1.0 / bins) for i in range(bins)] + [1.0]
    x, y = F.col(p), F.col(label)
    inside = [(x >= lo) & (x < hi) for lo, hi in zip(edges, edges[1:])]
    counted = df.agg(
        *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(inside)],
        *[F.avg(F.when(c, y)).alias(f"y{i}") for i, c in enumerate(inside)],
    )
    rows = [
        F.struct(
            F.lit(i).alias("bin"),
            F.lit((lo + hi) / 2).alias("center"),
            F.col(f"n{i}").alias("n"),
            F.coalesce(F.col(f"y{i}"), F.lit(0.0)).alias("positive_share"),
        )
        for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
    ]
    return counted.select(F.inline(F.array(*rows)))


def confidence_accuracy(
    df: DataFrame,
    label: str = "true_label",
    predicted: str = "predicted_label",
    p: str = "probability",
    high: float = 0.8,
    low: float = 0.2,
) -> DataFrame:
    right, x = F.col(label) == F.col(predicted), F.col(p)
    tiny = F.lit(1e-12)
    return df.agg(
        F.count_if(x > high).alias("high_confidence_predictions"),
        F.count_if(x < low).alias("low_confidence_predictions"),
        (F.count_if((x > high) & right) / (F.count_if(x > high) + tiny)).alias("high_confidence_accuracy"),
        (F.count_if((x < low) & right) / (F.count_if(x < low) + tiny)).alias("low_confidence_accuracy"),
    )


def summary(
    df: DataFrame, label: str = "true_label", predicted: str = "predicted_label", p: str = "probability"
) -> DataFrame:
    return df.agg(
        F.count("*").alias("val_samples"),
        F.avg(label).alias("positive_class_ratio"),
        F.avg(predicted).alias("prediction_positive_ratio"),
        F.avg(p).alias("mean_prediction_probability"),
        F.stddev_pop(p).alias("std_prediction_probability"),
    )


def details(
    df: DataFrame, label: str = "true_label", predicted: str = "predicted_label", p: str = "probability", keep: tuple[str, ...] = ()
) -> DataFrame:
    return df.select(
        *keep,
        F.col(label).alias("true_label"),
        F.col(predicted).alias("predicted_label"),
        F.col(p).alias("predicted_probability"),
        flags.flag(F.col(label) == F.col(predicted)).alias("correct"),
        flags.confidence_score(F.col(p)).alias("confidence"),
    )


def confidence_stats(detail: DataFrame) -> DataFrame:
    x, y = F.col("predicted_probability"), F.col("true_label")
    per_class = [
        measure(F.when(y == c, x)).alias(f"class_{c}_{name}_prob")
        for c in (0, 1)
        for name, measure in (("mean", F.avg), ("std", F.stddev_samp))
    ]
    return detail.agg(
        F.avg("confidence").alias("mean_confidence"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
        *per_class,
    )


def class_slice(df: DataFrame, label: str = "true_label", p: str = "probability") -> DataFrame:
    """Per true class: rows, mean score, and rows scored in [0.4, 0.6)."""
    x = F.col(p)
    return df.groupBy(label).agg(
        F.count("*").alias("n"),
        F.avg(x).alias("mean_probability"),
        F.count_if((x >= 0.4) & (x < 0.6)).alias("undecided"),
    )
