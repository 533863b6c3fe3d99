"""Sorting, head and tail, look-ups and ordered splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.operators.series import bounds


def in_time_order(df: DataFrame, ts: str = "timestamp", tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(ts, *tie)


def head(df: DataFrame, n: int, ts: str = "timestamp", tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(ts, *tie).limit(n)


def tail(df: DataFrame, n: int, ts: str = "timestamp", tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in (ts, *tie)]).limit(n)


def at_positions(df: DataFrame, first: int, stop: int, ts: str = "timestamp", tie: Sequence[str] = ()) -> DataFrame:
    """Rows number ``first`` … ``stop - 1`` in time order, counted from 0."""
    return df.orderBy(ts, *tie).limit(stop).offset(first)


def look_up(df: DataFrame, target: Column, ts: str = "timestamp", tie: Sequence[str] = ()) -> DataFrame:
    """From an exact time: it and the next 5 rows; else the 5 rows after it; else none."""
    nearest = df.where(F.col(ts) >= target).orderBy(ts, *tie).limit(6)
    # The window below sees at most these six rows.
    place = Window.orderBy(ts, *tie)
    exact = F.first(ts).over(place.rowsBetween(Window.unboundedPreceding, 0)) == target
    return (
        nearest.withColumn("_n", F.row_number().over(place))
        .withColumn("_exact", exact)
        .where(F.col("_exact") | (F.col("_n") <= 5))
        .drop("_n", "_exact")
    )


def split_holdout(series: DataFrame, last: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """Tag ``holdout`` = 1 on the last rows of a dense series."""
    return (
        _with_limits(series, bounds(series, keys), keys)
        .withColumn("holdout", (F.col("bucket_id") > F.col("hi") - last).cast("int"))
        .drop("lo", "hi")
    )


def split_ordered(
    windows: DataFrame, share: float = 0.2, keys: Sequence[str] = (), limits: DataFrame | None = None
) -> DataFrame:
    """Tag ``is_validation`` = 1 on the last ceil(share·n) rows of dense ``bucket_id``.

    ``limits`` (keys, lo, hi) saves evaluating ``windows`` a second time.
    """
    held = F.ceil((F.col("hi") - F.col("lo") + 1) * F.lit(share)).cast("bigint")
    return (
        _with_limits(windows, bounds(windows, keys) if limits is None else limits, keys)
        .withColumn("is_validation", (F.col("bucket_id") > F.col("hi") - held).cast("int"))
        .drop("lo", "hi")
    )


def _with_limits(series: DataFrame, limits: DataFrame, keys: Sequence[str]) -> DataFrame:
    if keys:
        return series.join(limits, [*keys], "left")
    both = limits.select(F.struct("lo", "hi")).scalar()
    return series.withColumn("lo", both["lo"]).withColumn("hi", both["hi"])


def sample(df: DataFrame, n: int, identity: str, seed: int = 0) -> DataFrame:
    """At most ``n`` rows without replacement; the same rows for the same seed."""
    lot = F.md5(F.concat_ws("#", F.lit(str(seed)), F.col(identity).cast("string")))
    return df.orderBy(lot, identity).limit(n)
