"""Fixed-length input windows, their scaling and class weights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.functions import flags
from slowtide.operators.chunked import over_halo
from slowtide.operators.series import bounds
from slowtide.operators.slices import tail


def sequences(
    series: DataFrame,
    features: Sequence[str],
    label: str = "target",
    window: int = 24,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Row j of the series → the ``window`` rows before it and its own label.

    ``steps`` is ARRAY<ARRAY<DOUBLE>> in time order, nulls and infinities made
    finite. Rows without ``window`` predecessors give no sequence.
    """
    step = F.array(*[flags.finite(F.col(f).cast("double")) for f in features])
    slim = series.select(
        *keys, "bucket_id", "bucket", F.coalesce(F.col(label), F.lit(0)).cast("int").alias("label"), step.alias("_step")
    )
    framed = over_halo(
        slim,
        lambda w: {"steps": F.collect_list("_step").over(w.rowsBetween(-window, -1))},
        back=window,
        keys=keys,
    )
    return framed.where(F.size("steps") == window).drop("_step")


def sequence_limits(series: DataFrame, window: int = 24, keys: Sequence[str] = ()) -> DataFrame:
    """First and last ``bucket_id`` that get a sequence."""
    return bounds(series, keys).withColumn("lo", F.col("lo") + window)


@dataclass(frozen=True)
class Scaler:
    features: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        """Standardise the feature columns in place."""
        return df.withColumns(
            {
                f: (flags.finite(F.col(f).cast("double")) - F.lit(m)) / F.lit(s)
                for f, m, s in zip(self.features, self.mean, self.scale)
            }
        )


def fit_scaler(
    series: DataFrame, features: Sequence[str], window: int = 24, fit_on: str = "all", share: float = 0.2
) -> Scaler:
    """Mean and population std over all windows, without building them.

    A row counts once per window that contains it; ``fit_on="train"`` leaves the
    windows of the validation part out. A constant feature gets scale 1.
    """
    weighted = window_weights(series, window, fit_on, share)
    xs = weighted.select(
        F.col("weight").cast("double").alias("w"),
        *[flags.finite(F.col(f).cast("double")).alias(f) for f in features],
    )
    first = xs.agg(
        F.sum("w").alias("_w"),
        *[F.try_divide(F.sum(F.col("w") * F.col(f)), F.sum("w")).alias(f) for f in features],
        *[F.min(F.when(F.col("w") > 0, F.col(f))).alias(f"_lo_{f}") for f in features],
        *[F.max(F.when(F.col("w") > 0, F.col(f))).alias(f"_hi_{f}") for f in features],
    ).first()
    if not first["_w"]:
        raise ValueError("no sequences: the series is shorter than the window")
    mean = {f: first[f] for f in features}
    spread = xs.agg(
        *[
            F.sqrt(F.sum(F.col("w") * (F.col(f) - F.lit(mean[f])) * (F.col(f) - F.lit(mean[f]))) / F.sum("w")).alias(f)
            for f in features
        ]
    ).first()
    scale = [1.0 if first[f"_lo_{f}"] == first[f"_hi_{f}"] else spread[f] for f in features]
    return Scaler(tuple(features), tuple(mean[f] for f in features), tuple(scale))


def window_weights(series: DataFrame, window: int = 24, fit_on: str = "all", share: float = 0.2) -> DataFrame:
    """Add ``weight``: how many windows contain the row, by arithmetic on its number."""
    both = series.select(F.struct(F.min("bucket_id").alias("lo"), F.max("bucket_id").alias("hi"))).scalar()
    row = F.col("bucket_id") - both["lo"]
    windows = both["hi"] - both["lo"] + 1 - window
    if fit_on == "train":
        windows = windows - F.ceil(windows * F.lit(share)).cast("bigint")
    elif fit_on != "all":
        raise ValueError(f"unknown fit_on: {fit_on}")
    last = F.least(row, windows - 1)
    first = F.greatest(F.lit(0).cast("bigint"), row - (window - 1))
    return series.withColumn("weight", F.greatest(F.lit(0).cast("bigint"), last - first + 1))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (classes · n_class); no rows when there is one class only."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    # One row per class.
    classes = Window.partitionBy()
    total, k = F.sum("n").over(classes), F.count("*").over(classes)
    return counts.select(label, "n", F.when(k > 1, total / (k * F.col("n"))).alias("weight")).where(
        F.col("weight").isNotNull()
    )


def class_weight_column(df: DataFrame, label: str = "label") -> Column:
    """The same weights as an expression, from two collected counts."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return F.lit(1.0)
    total, chain = sum(counts.values()), F
    for value, n in counts.items():
        chain = chain.when(F.col(label) == value, F.lit(total / (len(counts) * n)))
    return chain


def latest_window(
    series: DataFrame, features: Sequence[str], window: int = 24, order: str = "bucket_id"
) -> DataFrame:
    """One row: the last ``window`` rows as ``steps``.

    A shorter series is padded in front with its last row, an empty one with zeros.
    """
    step = F.array(*[flags.finite(F.col(f).cast("double")) for f in features])
    rows = tail(series.select(order, step.alias("step")), window, order)
    zeros = F.array(*[F.lit(0.0) for _ in features])
    # At most ``window`` rows are gathered here.
    gathered = rows.agg(F.sort_array(F.collect_list(F.struct(order, "step"))).alias("rows"), F.max(order).alias(order))
    steps = F.col("rows")["step"]
    padded = F.concat(F.array_repeat(F.try_element_at(steps, F.lit(-1)), F.lit(window) - F.size("rows")), steps)
    return gathered.select(
        order, F.when(F.size("rows") == 0, F.array_repeat(zeros, window)).otherwise(padded).alias("steps")
    )


def asymmetric_losses(df: DataFrame, label: str = "true_label", p: str = "probability") -> DataFrame:
    """Per class: rows, weight and mean weighted cross-entropy (missed delays cost three times)."""
    weight = flags.asymmetric_weight(F.col(label))
    loss = flags.log_loss(F.col(label), F.col(p), weight)
    return df.groupBy(label).agg(F.count("*").alias("n"), F.max(weight).alias("weight"), F.avg(loss).alias("mean_loss"))
