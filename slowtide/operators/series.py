"""Gap-free time series: bucket aggregation, spine and their join.

A series has its key columns, ``bucket_id`` (dense whole number) and ``bucket``
(start of the interval); "k rows away" is exactly "k bucket ids away".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.functions import clock
from slowtide.session import durable

CHUNK = 288

_FUNCTIONS = {"max": F.max, "mean": F.avg, "sum": F.sum}


def bucket_aggregate(
    df: DataFrame,
    aggs: dict[str, tuple[str, str | Column]],
    step: int,
    ts: str = "timestamp",
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row per non-empty bucket; ``aggs`` maps output name to (max|mean|sum, column).

    All three functions combine map-side, so a bucket or key with most of the rows
    still leaves every task as one row.
    """
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, clock.bucket_of(F.col(ts), step).alias("bucket_id"))
        .agg(*[_FUNCTIONS[fn](src).alias(out) for out, (fn, src) in aggs.items()])
    )


def bounds(buckets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return buckets.groupBy(*keys).agg(F.min("bucket_id").alias("lo"), F.max("bucket_id").alias("hi"))


def spine(limits: DataFrame, keys: Sequence[str] = (), chunk: int = CHUNK) -> DataFrame:
    """Every bucket id from ``lo`` to ``hi``, chunk numbers first so no array is long."""
    chunks = limits.where(F.col("lo").isNotNull()).select(
        *keys,
        "lo",
        "hi",
        F.explode(F.sequence(clock.floor_div(F.col("lo"), chunk), clock.floor_div(F.col("hi"), chunk))).alias("_c"),
    )
    first = F.greatest(F.col("lo"), F.col("_c") * chunk)
    last = F.least(F.col("hi"), F.col("_c") * chunk + (chunk - 1))
    return chunks.select(*keys, F.explode(F.sequence(first, last)).alias("bucket_id"))


def fill_gaps(
    buckets: DataFrame, step: int, keys: Sequence[str] = (), zero: Sequence[str] = (), limits: DataFrame | None = None
) -> DataFrame:
    """Left join of the spine to the buckets; ``zero`` columns read 0 in empty buckets."""
    joined = spine(bounds(buckets, keys) if limits is None else limits, keys).join(
        buckets, [*keys, "bucket_id"], "left"
    )
    values = [c for c in buckets.columns if c not in keys and c != "bucket_id"]
    return joined.select(
        *keys,
        "bucket_id",
        clock.bucket_start(F.col("bucket_id"), step).alias("bucket"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zero else F.col(c) for c in values],
    )


def resample(
    df: DataFrame,
    aggs: dict[str, tuple[str, str | Column]],
    step: int = 300,
    ts: str = "timestamp",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Gap-free series of buckets of ``step`` seconds; ``sum`` of an empty bucket is 0.

    The bucket table (small beside the input) is written once, so the input is read once
    whatever follows.
    """
    buckets = bucket_aggregate(df, aggs, step, ts, keys)
    zero = [out for out, (fn, _) in aggs.items() if fn == "sum"]
    return fill_gaps(durable(buckets), step, keys, zero)
