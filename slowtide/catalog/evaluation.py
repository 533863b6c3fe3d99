"""Evaluation of the scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.catalog.registry import query, rounded
from slowtide.catalog.slices import RUNS_SQL, run_table
from slowtide.operators import evaluation, runs
from slowtide.session import durable, fresh_folder
from slowtide.sources.testdata import requests, scored, table
from slowtide.functions import flags

_CELLS = """SELECT count(*) AS n, count(*) FILTER (true_label = 0 AND predicted_label = 0) AS tn, count(*) FILTER (true_label = 0 AND predicted_label = 1) AS fp,
                   count(*) FILTER (true_label = 1 AND predicted_label = 0) AS fn, count(*) FILTER (true_label = 1 AND predicted_label = 1) AS tp FROM {source}"""


@query(
    "ev1_confusion_matrix",
    f"""SELECT tn, fp, fn, tp, round(tn / n, 6) AS tn_share, round(fp / n, 6) AS fp_share, round(fn / n, 6) AS fn_share, round(tp / n, 6) AS tp_share
        FROM ({_CELLS.format(source="scored")})""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.confusion(scored(spark, sf)))


_LABELS_SQL = "(SELECT quality AS true_label, toxic AS predicted_label FROM labels)"
_SCORES = """SELECT '{name}' AS source, round((tp + tn) / n, 6) AS accuracy, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
                    round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
                    round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1_score FROM ({cells})"""


@query(
    "ev2_scores",
    _SCORES.format(name="scored", cells=_CELLS.format(source="scored"))
    + " UNION ALL "
    + _SCORES.format(name="labels", cells=_CELLS.format(source=_LABELS_SQL)),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    other = table(spark, sf, "labels").select(F.col("quality").alias("true_label"), F.col("toxic").alias("predicted_label"))
    parts = [
        evaluation.scores(evaluation.confusion(df)).select(F.lit(name).alias("source"), "accuracy", "precision", "recall", "f1_score")
        for name, df in (("scored", scored(spark, sf)), ("labels", other))
    ]
    return rounded(parts[0].unionByName(parts[1]))


@query(
    "ev3_class_report",
    f"""WITH c AS ({_CELLS.format(source="scored")}),
             m AS (SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0,
                          tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fn + fp) AS f1, tn + fp AS s0, tp + fn AS s1 FROM c)
        SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, s0 AS support FROM m
        UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM m
        UNION ALL SELECT 'accuracy', round((tp + tn) / n, 6), round((tp + tn) / n, 6), round((tp + tn) / n, 6), n FROM m
        UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM m
        UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6), round((f0 * s0 + f1 * s1) / n, 6), n FROM m""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.class_report(scored(spark, sf)))


def _curve_sql(source: str) -> str:
    return f"""
        SELECT t AS threshold, tp / predicted AS precision, tp / positives AS recall
        FROM (SELECT t, sum(pos) OVER w AS tp, sum(n) OVER w AS predicted, sum(pos) OVER () AS positives
              FROM (SELECT probability AS t, count(*) AS n, sum(true_label) AS pos FROM {source} GROUP BY 1)
              WINDOW w AS (ORDER BY t DESC ROWS UNBOUNDED PRECEDING))
        UNION ALL SELECT NULL, 1, 0"""


@query(
    "ev4_precision_recall_curve",
    f"SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM ({_curve_sql('scored')})",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.pr_curve(scored(spark, sf)))


# A score with many distinct values; the tests of the curve cut such scores in ranges.
_FINE_SQL = "(SELECT CASE WHEN is_error = 1 THEN 1 ELSE 0 END AS true_label, response_time / (response_time + 2000) AS probability FROM requests)"


@query(
    "ev4_precision_recall_curve_fine",
    f"SELECT round(threshold, 9) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM ({_curve_sql(_FINE_SQL)})",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fine = requests(spark, sf).select(
        F.col("is_error").alias("true_label"), (F.col("response_time") / (F.col("response_time") + 2000)).alias("probability")
    )
    curve = evaluation.pr_curve(fine)
    return curve.select(F.round("threshold", 9).alias("threshold"), F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query(
    "ev5_best_f1_threshold",
    f"""WITH f AS (SELECT threshold, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM ({_curve_sql('scored')}) WHERE threshold IS NOT NULL),
             b AS (SELECT threshold, f1 FROM f ORDER BY round(f1, 12) DESC, threshold LIMIT 1),
             j AS (SELECT s.true_label, CASE WHEN s.probability > b.threshold THEN 1 ELSE 0 END AS predicted_label FROM scored s, b)
        SELECT b.threshold AS best_f1_threshold, round(b.f1, 6) AS best_f1_score, c.tn, c.fp, c.fn, c.tp FROM b, ({_CELLS.format(source="j")}) c""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf)
    best = evaluation.best_threshold(evaluation.pr_curve(rows))
    found = best.first()
    cells = evaluation.confusion(evaluation.predict_at(rows, found["best_f1_threshold"]))
    return rounded(
        cells.select(
            F.lit(found["best_f1_threshold"]).alias("best_f1_threshold"), F.lit(found["best_f1_score"]).alias("best_f1_score"),
            "tn", "fp", "fn", "tp",
        )
    )


@query(
    "ev6_probability_ranges",
    " UNION ALL ".join(
        f"SELECT '{lo:.1f}-{hi:.1f}' AS range, count(*) FILTER (probability >= {lo}::DOUBLE AND probability < {hi}::DOUBLE) AS n FROM scored"
        for lo, hi in evaluation.RANGES
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.range_counts(scored(spark, sf))


_EDGES = [i * 0.1 for i in range(10)] + [1.0]


@query(
    "ev7_calibration",
    " UNION ALL ".join(
        f"""SELECT {i} AS bin, round({(lo + hi) / 2!r}::DOUBLE, 6) AS center, count(*) FILTER (probability >= {lo!r}::DOUBLE AND probability < {hi!r}::DOUBLE) AS n,
                   round(coalesce(avg(true_label) FILTER (probability >= {lo!r}::DOUBLE AND probability < {hi!r}::DOUBLE), 0), 6) AS positive_share FROM scored"""
        for i, (lo, hi) in enumerate(zip(_EDGES, _EDGES[1:]))
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.calibration(scored(spark, sf)))


@query(
    "ev8_confidence_accuracy",
    """SELECT count(*) FILTER (probability > 0.8) AS high_confidence_predictions, count(*) FILTER (probability < 0.2) AS low_confidence_predictions,
              round(count(*) FILTER (probability > 0.8 AND true_label = predicted_label) / (count(*) FILTER (probability > 0.8) + 1e-12), 6) AS high_confidence_accuracy,
              round(count(*) FILTER (probability < 0.2 AND true_label = predicted_label) / (count(*) FILTER (probability < 0.2) + 1e-12), 6) AS low_confidence_accuracy FROM scored""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.confidence_accuracy(scored(spark, sf)))


@query(
    "ev9_score_summary",
    """SELECT count(*) AS val_samples, round(avg(true_label), 6) AS positive_class_ratio, round(avg(predicted_label), 6) AS prediction_positive_ratio,
              round(avg(probability), 6) AS mean_prediction_probability, round(stddev_pop(probability), 6) AS std_prediction_probability FROM scored""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.summary(scored(spark, sf)))


@query(
    "ev10_confidence_stats",
    """SELECT round(avg(greatest(probability, 1 - probability)), 6) AS mean_confidence, round(min(greatest(probability, 1 - probability)), 6) AS min_confidence,
              round(max(greatest(probability, 1 - probability)), 6) AS max_confidence,
              round(avg(probability) FILTER (true_label = 0), 6) AS class_0_mean_prob, round(stddev_samp(probability) FILTER (true_label = 0), 6) AS class_0_std_prob,
              round(avg(probability) FILTER (true_label = 1), 6) AS class_1_mean_prob, round(stddev_samp(probability) FILTER (true_label = 1), 6) AS class_1_std_prob FROM scored""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.confidence_stats(evaluation.details(scored(spark, sf))))


@query(
    "ev11_prediction_details",
    """SELECT event_id, true_label, predicted_label, probability AS predicted_probability, CASE WHEN true_label = predicted_label THEN 1 ELSE 0 END AS correct,
              round(greatest(probability, 1 - probability), 6) AS confidence FROM scored""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.details(scored(spark, sf), keep=("event_id",)))


@query(
    "ev12_run_log",
    f"""SELECT run_id, run_ts, 'logistic' AS model_type, '24' AS window_size, CAST(val_samples AS DOUBLE) AS val_samples, round(final_accuracy, 6) AS final_accuracy,
               round(final_precision, 6) AS final_precision, round(final_recall, 6) AS final_recall, round(final_f1, 6) AS final_f1 FROM ({RUNS_SQL})""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "runs")
    table_of_runs = durable(run_table(spark, sf))
    good = flags.flag(F.col("metrics")["final_f1"] >= 0.1) == 1
    runs.log_run(spark, path, table_of_runs.where(good))
    runs.log_run(spark, path, table_of_runs.where(~good))
    metric, param = F.col("metrics"), F.col("params")
    return rounded(
        runs.read_runs(spark, path).select(
            "run_id",
            "run_ts",
            *[param[n].alias(n) for n in ("model_type", "window_size")],
            *[metric[n].alias(n) for n in ("val_samples", "final_accuracy", "final_precision", "final_recall", "final_f1")],
        )
    )
