"""Summaries of a table: rates, nulls, spans, box plots, histograms, densities."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.functions import clock
from slowtide.operators.quantiles import exact_quantiles
from slowtide.operators.slices import tail


def rate_summary(df: DataFrame, flag: str = "Delay_Detected") -> DataFrame:
    return df.agg(
        F.sum(flag).cast("bigint").alias("delays"),
        F.count("*").alias("total"),
        (F.avg(flag) * 100).alias("delay_pct"),
    )


def group_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(f"mean_{value}"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: nulls and their share in percent, from a single pass."""
    counted = df.agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns]
    return counted.select("_n", F.inline(F.array(*rows))).select(
        "column_name",
        "nulls",
        F.when(F.col("_n") > 0, F.col("nulls") * 100.0 / F.col("_n")).alias("null_pct"),
    )


def total_nulls(df: DataFrame) -> DataFrame:
    return df.agg(
        sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("bigint")).alias("total_nulls")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def shape(df: DataFrame) -> DataFrame:
    """One row per column with its type and position, and the row count of the table."""
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("data_type"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(len(rows)).alias("n_columns"), F.inline(F.array(*rows)))


def time_span(df: DataFrame, now: Column, ts: str = "timestamp") -> DataFrame:
    limits = df.agg(F.min(ts).alias("oldest"), F.max(ts).alias("newest"))
    return limits.select(
        "oldest",
        "newest",
        clock.whole_days_between(F.col("newest"), F.col("oldest")).alias("span_days"),
        clock.hours_between(now, F.col("newest")).alias("hours_old"),
    )


def repeated(ts: str = "timestamp") -> Column:
    """Aggregate: rows beyond the first of each value, all nulls being one value."""
    return F.count("*") - F.countDistinct(ts) - F.max(F.col(ts).isNull().cast("int"))


def recent_std(df: DataFrame, columns: Sequence[str], n: int, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """Population standard deviation over the newest ``n`` rows."""
    return tail(df, n, ts, tie).agg(*[F.stddev_pop(c).alias(f"{c}_std") for c in columns])


def prediction_std(df: DataFrame, p: str, ts: str, tie: Sequence[str] = (), n: int = 50) -> DataFrame:
    """Standard deviation of all predictions, and of the last ``n`` once there are so many."""
    latest = tail(df, n, ts, tie).agg(F.count(p).alias("k"), F.stddev_pop(p).alias("s"))
    last = latest.select(F.when(F.col("k") >= n, F.col("s"))).scalar()
    return df.agg(F.stddev_pop(p).alias("pred_prob_std")).withColumn("rolling_pred_std", last)


def box_stats(df: DataFrame, value: str, by: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Quartiles per class, and the extremes inside 1.5 interquartile ranges of the box."""
    x = F.col(value)
    quartiles = exact_quantiles(
        df, {str(c): (F.when(F.col(by) == c, x), [0.25, 0.5, 0.75]) for c in classes}
    )
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for c in classes:
        q1, _, q3 = quartiles[str(c)]
        if q1 is not None:
            low = F.when(F.col(by) == c, F.lit(q1 - 1.5 * (q3 - q1))).otherwise(low)
            high = F.when(F.col(by) == c, F.lit(q3 + 1.5 * (q3 - q1))).otherwise(high)
    rows = (
        df.where(F.col(by).isin(list(classes)) & x.isNotNull())
        .groupBy(by)
        .agg(
            F.count("*").alias("n"),
            F.min(F.when(x >= low, x)).alias("whisker_low"),
            F.max(F.when(x <= high, x)).alias("whisker_high"),
            F.count_if((x < low) | (x > high)).alias("outliers"),
        )
    )
    def quartile(i: int) -> Column:
        chain = F.lit(None).cast("double")
        for c in classes:
            chain = F.when(F.col(by) == c, F.lit(quartiles[str(c)][i])).otherwise(chain)
        return chain

    return rows.withColumns({"q1": quartile(0), "median": quartile(1), "q3": quartile(2)})


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the extremes; every bin left-closed, the last one closed."""
    ends = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).first()
    if ends["lo"] is None:
        lo, hi = 0.0, 1.0
    elif ends["lo"] == ends["hi"]:
        lo, hi = ends["lo"] - 0.5, ends["hi"] + 0.5
    else:
        lo, hi = ends["lo"], ends["hi"]
    step = (hi - lo) / bins

    def edge(i: Column) -> Column:
        return F.when(i >= bins, F.lit(hi)).otherwise(i * F.lit(step) + F.lit(lo))

    x = F.col(value)
    guess = F.least(F.floor((x - lo) * (bins / (hi - lo))).cast("int"), F.lit(bins - 1))
    # Rounding may put a value on the wrong side of its edge.
    placed = F.when(x < edge(guess), guess - 1).when(
        (x >= edge(guess + 1)) & (guess < bins - 1), guess + 1
    ).otherwise(guess)
    counted = df.where(x.isNotNull()).groupBy(placed.alias("bin")).agg(F.count("*").alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counted, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("bin_low"),
        edge(F.col("bin") + 1).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density(df: DataFrame, values: Sequence[str], points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of each column on its own grid; bandwidth = sample std · n^(-1/5).

    The input is read twice, for the grids and for the sums. Each task adds its values to one vector of
    ``points`` sums per column, so nothing but those vectors is shuffled.
    """
    stats = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"), F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi"),
            ).alias(f"s{i}")
            for i, c in enumerate(values)
        ]
    ).first()
    grids = {}
    for i, c in enumerate(values):
        s = stats[f"s{i}"]
        if s["std"]:
            h = s["std"] * s["n"] ** -0.2
            lo, hi = s["lo"] - cut * h, s["hi"] + cut * h
            grids[c] = (lo, (hi - lo) / (points - 1), h, 1.0 / (s["n"] * h * math.sqrt(2 * math.pi)))

    if not grids:
        return df.sparkSession.createDataFrame([], "column_name string, point int, at double, density double")
    names = list(grids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {c: np.zeros(points) for c in names}
        for batch in batches:
            for c, column in zip(names, batch.columns, strict=True):
                lo, step, h, _ = grids[c]
                at = lo + step * np.arange(points)
                x, n = np.unique(column.drop_null().to_numpy(), return_counts=True)
                for i in range(0, len(x), 512):
                    own = x[i : i + 512]
                    # Further than nine bandwidths off, a value adds less than the last bit of those nearby.
                    near = slice(*np.searchsorted(at, [own[0] - 9 * h, own[-1] + 9 * h]))
                    z = (at[near, None] - own) / h
                    totals[c][near] += np.exp(-0.5 * z * z) @ n[i : i + 512]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(list(totals.values()), pa.list_(pa.float64()))], names=["column_name", "totals"])

    vectors = df.select(*[F.col(c).cast("double") for c in names]).mapInArrow(sums, "column_name string, totals array<double>")
    facts = [(c, lo, step, scale) for c, (lo, step, _, scale) in grids.items()]
    by_column = df.sparkSession.createDataFrame(facts, "column_name string, lo double, step double, scale double")
    return (
        vectors.select("column_name", F.posexplode("totals").alias("point", "total"))
        .groupBy("column_name", "point")
        .agg(F.sum("total").alias("total"))
        .join(by_column, "column_name")
        .select("column_name", "point", (F.col("lo") + F.col("point") * F.col("step")).alias("at"), (F.col("total") * F.col("scale")).alias("density"))
    )
