"""Stacking of request logs whose schemas differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.functions import clock, flags
from slowtide.operators import columns


def union_same(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def union_strict(a: DataFrame, b: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Both sides must have all wanted columns."""
    return columns.keep_strict(a, wanted).unionByName(columns.keep_strict(b, wanted))


def union_on_schema(
    a: DataFrame, b: DataFrame, types: Mapping[str, str], ts: str = "timestamp"
) -> DataFrame:
    """Exactly the target columns; what a side lacks is null, an unreadable time too."""
    def aligned(df: DataFrame) -> DataFrame:
        full = columns.add_missing(df, types)
        return full.select(
            *[
                clock.parse_timestamp(F.col(c).cast("string")).alias(c) if c == ts and dict(full.dtypes)[c] == "string"
                else F.col(c).cast(t).alias(c)
                for c, t in types.items()
            ]
        )

    return aligned(a).unionByName(aligned(b))


def union_all_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every column of either side; nothing is lost."""
    return a.unionByName(b, allowMissingColumns=True)


def union_counts(a: DataFrame, b: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: size of both inputs and of the result, and whether they add up."""
    def size(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("part"))

    parts = size(a, "a").unionAll(size(b, "b")).unionAll(size(merged, "merged"))
    return parts.agg(
        F.count_if(F.col("part") == "a").alias("n_first"),
        F.count_if(F.col("part") == "b").alias("n_second"),
        F.count_if(F.col("part") == "merged").alias("n_merged"),
    ).withColumn("complete", flags.flag(F.col("n_first") + F.col("n_second") == F.col("n_merged")))
