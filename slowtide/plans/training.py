"""Train the delay classifier on input windows, and score with it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.functions import flags
from slowtide.operators import evaluation
from slowtide.operators.columns import available_features
from slowtide.operators.sequences import Scaler, class_weight_column, fit_scaler, latest_window, sequence_limits, sequences
from slowtide.operators.slices import split_ordered
from slowtide.session import durable


_SIDECAR = (
    "features array<string>, window int, mean array<double>, scale array<double>, threshold double, "
    "metrics map<string,double>, losses array<double>"
)


@dataclass(frozen=True)
class DelayModel:
    features: tuple[str, ...]
    window: int
    scaler: Scaler
    classifier: LogisticRegressionModel
    threshold: float
    metrics: dict[str, float]
    losses: tuple[float, ...]


def save_model(model: DelayModel, path: str) -> None:
    """Classifier in Spark's own format, the rest as a one-row JSON dataset beside it."""
    model.classifier.write().overwrite().save(f"{path}/classifier")
    rest = {
        "features": list(model.features),
        "window": model.window,
        "mean": list(model.scaler.mean),
        "scale": list(model.scaler.scale),
        "threshold": model.threshold,
        "metrics": model.metrics,
        "losses": list(model.losses),
    }
    spark = SparkSession.active()
    spark.createDataFrame([rest], _SIDECAR).coalesce(1).write.mode("overwrite").json(f"{path}/sidecar")


def load_model(spark: SparkSession, path: str) -> DelayModel:
    rest = spark.read.schema(_SIDECAR).json(f"{path}/sidecar").first()
    features = tuple(rest["features"])
    return DelayModel(
        features,
        rest["window"],
        Scaler(features, tuple(rest["mean"]), tuple(rest["scale"])),
        LogisticRegressionModel.load(f"{path}/classifier"),
        rest["threshold"],
        dict(rest["metrics"]),
        tuple(rest["losses"]),
    )


def _vector(df: DataFrame) -> DataFrame:
    return df.withColumn("inputs", array_to_vector(F.flatten("steps")))


def _probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("probability", vector_to_array("probability")[1])


def train(
    series: DataFrame,
    features: Sequence[str] = tuple(schemas.FEATURES),
    window: int = schemas.WINDOW_BUCKETS,
    fit_on: str = "train",
    weighting: str | None = "balanced",
    max_iter: int = 100,
) -> DelayModel:
    """Logistic regression on flattened, standardised windows.

    Fits to the estimator's tolerance, in ``max_iter`` iterations at most. The last fifth of the windows validates; the threshold is the one with the best
    F1 there. ``weighting`` is ``balanced``, ``asymmetric`` (3 to 1) or None.
    """
    features = available_features(series, features)
    base = durable(series.select("bucket_id", "bucket", *features, "target"))
    scaler = fit_scaler(base, features, window, fit_on)
    cut = sequences(scaler.apply(base), features, window=window)
    windows = _vector(split_ordered(cut, schemas.VALIDATION_SHARE, limits=sequence_limits(base, window)))
    # The windows are cut once; every training iteration re-reads them.
    ready = durable(windows.select("bucket_id", "label", "is_validation", "inputs"))
    fitting, held = ready.where("is_validation = 0"), ready.where("is_validation = 1")
    if weighting == "balanced":
        weight = class_weight_column(fitting)
    elif weighting == "asymmetric":
        weight = flags.asymmetric_weight(F.col("label"))
    else:
        weight = F.lit(1.0)
    estimator = LogisticRegression(
        featuresCol="inputs", labelCol="label", weightCol="weight", maxIter=max_iter, regParam=0.01,
        standardization=False, aggregationDepth=2,
    )
    classifier = estimator.fit(fitting.withColumn("weight", weight))
    checked = durable(
        _probability(classifier.transform(held)).select(F.col("label").alias("true_label"), "probability")
    )
    best = evaluation.best_threshold(evaluation.pr_curve(checked)).first()
    threshold = best["best_f1_threshold"] if best["best_f1_threshold"] is not None else 0.5
    judged = evaluation.predict_at(checked, threshold)
    cells = evaluation.scores(evaluation.confusion(judged)).first()
    overall = evaluation.summary(judged).first()
    loss = judged.agg(F.avg(flags.log_loss(F.col("true_label"), F.col("probability"))).alias("l")).first()["l"]
    metrics = {
        "final_accuracy": cells["accuracy"],
        "final_precision": cells["precision"],
        "final_recall": cells["recall"],
        "final_f1": cells["f1_score"],
        "best_f1_score": best["best_f1_score"],
        "val_loss": loss,
        **{name: overall[name] for name in overall.__fields__},
    }
    metrics = {name: float(value) for name, value in metrics.items()}
    losses = tuple(float(x) for x in classifier.summary.objectiveHistory)
    return DelayModel(tuple(features), window, scaler, classifier, float(threshold), metrics, losses)


def score(model: DelayModel, series: DataFrame, threshold: float | None = None) -> DataFrame:
    """Every window of the series: label, probability and class."""
    cut = sequences(model.scaler.apply(series), model.features, window=model.window)
    scored = _probability(model.classifier.transform(_vector(cut)))
    limit = model.threshold if threshold is None else threshold
    return evaluation.predict_at(scored, limit).select("bucket_id", "bucket", "label", "probability", "predicted_label")


def predict_latest(model: DelayModel, series: DataFrame, now: Column, threshold: float | None = None) -> DataFrame:
    """One row for the prediction log: will there be a delay within two buckets?"""
    row = latest_window(model.scaler.apply(series), model.features, model.window)
    scored = _probability(model.classifier.transform(_vector(row)))
    limit = model.threshold if threshold is None else threshold
    p = F.col("probability")
    return scored.select(
        now.alias("timestamp"),
        flags.decision(p, limit).alias("prediction"),
        p,
        flags.confidence_label(p).alias("confidence"),
    ).withColumn("answer", flags.answer_text(F.col("prediction")))
