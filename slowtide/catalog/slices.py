"""Order, position, look-up and split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.catalog.registry import query, rounded
from slowtide.catalog.windows import train_part
from slowtide.functions import clock
from slowtide.operators import evaluation, runs, slices
from slowtide.operators.sequences import sequence_limits, sequences
from slowtide.plans import features
from slowtide.session import durable
from slowtide.sources.testdata import host_samples, requests, scored


@query("tk1_sorted_by_time", """SELECT event_id, "timestamp", response_time FROM requests ORDER BY "timestamp", event_id""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return slices.in_time_order(requests(spark, sf), tie=["event_id"]).select("event_id", "timestamp", "response_time")


@query(
    "tk2_head_and_tail",
    """(SELECT 'head' AS part, event_id, "timestamp" FROM requests ORDER BY "timestamp", event_id LIMIT 5)
       UNION ALL (SELECT 'tail', event_id, "timestamp" FROM requests ORDER BY "timestamp" DESC, event_id DESC LIMIT 24)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = requests(spark, sf).select("event_id", "timestamp")
    first = slices.head(log, 5, tie=["event_id"]).select(F.lit("head").alias("part"), "*")
    return first.unionByName(slices.tail(log, 24, tie=["event_id"]).select(F.lit("tail").alias("part"), "*"))


@query(
    "tk3_positions_20_to_40",
    """(SELECT '20-29' AS rows, sample_id, "timestamp" FROM host_samples ORDER BY "timestamp", sample_id LIMIT 10 OFFSET 20)
       UNION ALL (SELECT '30-39', sample_id, "timestamp" FROM host_samples ORDER BY "timestamp", sample_id LIMIT 10 OFFSET 30)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    samples = host_samples(spark, sf).select("sample_id", "timestamp")
    parts = [
        slices.at_positions(samples, a, a + 10, tie=["sample_id"]).select(F.lit(f"{a}-{a + 9}").alias("rows"), "*")
        for a in (20, 30)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "tk4_drop_and_keep_last_5",
    """SELECT bucket, "Delay_Detected", CASE WHEN bucket_id > (SELECT max(bucket_id) - 5 FROM filled) THEN 1 ELSE 0 END AS holdout FROM filled""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = features.health_series(requests(spark, sf)).fillna(0, ["Delay_Detected"])
    return slices.split_holdout(series, schemas.HOLDOUT_BUCKETS).select("bucket", "Delay_Detected", "holdout")


@query(
    "tk5_point_look_up",
    """WITH exact AS (SELECT "timestamp" AS t FROM host_samples ORDER BY "timestamp", sample_id LIMIT 1 OFFSET 50)
       (SELECT 'exact' AS target, sample_id, "timestamp" FROM host_samples WHERE "timestamp" >= (SELECT t FROM exact) ORDER BY "timestamp", sample_id LIMIT 6)
       UNION ALL (SELECT 'between', sample_id, "timestamp" FROM host_samples WHERE "timestamp" >= TIMESTAMP '2024-01-23 05:32:30' ORDER BY "timestamp", sample_id LIMIT 5)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    samples = host_samples(spark, sf).select("sample_id", "timestamp")
    exact = slices.at_positions(samples, 50, 51, tie=["sample_id"]).select("timestamp").scalar()
    targets = {"exact": exact, "between": clock.instant("2024-01-23 05:32:30"), "after the end": clock.instant("2030-01-01 00:00:00")}
    found = [
        slices.look_up(samples, at, tie=["sample_id"]).select(F.lit(name).alias("target"), "*") for name, at in targets.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "tk6_ordered_validation_split",
    """SELECT bucket_id, CASE WHEN bucket_id > max(bucket_id) OVER () - ceil(count(*) OVER () * 0.2::DOUBLE) THEN 1 ELSE 0 END AS is_validation
       FROM train_part WHERE bucket_id >= (SELECT min(bucket_id) + 24 FROM train_part)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = durable(train_part(spark, sf).select("bucket_id", "bucket", "CPU", "target"))
    windows = slices.split_ordered(sequences(series, ["CPU"]), limits=sequence_limits(series))
    return windows.select("bucket_id", "is_validation")


RUNS_SQL = """
    SELECT CAST(user_id AS VARCHAR) AS run_id, max("timestamp") AS run_ts, count(*) AS val_samples,
           (tp + tn) / count(*) AS final_accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS final_precision,
           CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS final_recall,
           CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS final_f1
    FROM (SELECT *, count(*) FILTER (true_label = 1 AND predicted_label = 1) OVER u AS tp, count(*) FILTER (true_label = 0 AND predicted_label = 0) OVER u AS tn,
                 count(*) FILTER (true_label = 0 AND predicted_label = 1) OVER u AS fp, count(*) FILTER (true_label = 1 AND predicted_label = 0) OVER u AS fn
          FROM scored WINDOW u AS (PARTITION BY user_id)) GROUP BY user_id, tp, tn, fp, fn"""


def run_table(spark: SparkSession, sf: str) -> DataFrame:
    """One run per user: the scores of that user's rows."""
    cells = evaluation.confusion_counts(F.col("true_label"), F.col("predicted_label"))
    per_user = scored(spark, sf).groupBy("user_id").agg(
        *[c.alias(n) for n, c in cells.items()], F.count("*").alias("n"), F.max("timestamp").alias("run_ts")
    )
    return runs.run_rows(
        evaluation.scores(per_user),
        F.col("user_id"),
        F.col("run_ts"),
        {"window_size": F.lit(24), "epochs": F.lit(10), "model_type": F.lit("logistic")},
        {
            "final_accuracy": F.col("accuracy"),
            "final_precision": F.col("precision"),
            "final_recall": F.col("recall"),
            "final_f1": F.col("f1_score"),
            "val_samples": F.col("n"),
        },
    )


@query(
    "tk7_best_run",
    f"""WITH r AS ({RUNS_SQL}) SELECT run_id, run_ts, round(final_f1, 6) AS final_f1, round(final_accuracy, 6) AS final_accuracy
        FROM r ORDER BY r.final_f1 DESC, run_id LIMIT 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    best = runs.best_run(run_table(spark, sf))
    return rounded(
        best.select(
            "run_id", "run_ts", F.col("metrics")["final_f1"].alias("final_f1"), F.col("metrics")["final_accuracy"].alias("final_accuracy")
        )
    )


@query("tk8_sample_500", "SELECT event_id, probability FROM scored ORDER BY md5('7#' || event_id), event_id LIMIT 500")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return slices.sample(scored(spark, sf).select("event_id", "probability"), 500, "event_id", seed=7)
