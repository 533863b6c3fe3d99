"""Projection, renaming, casting and filtering by name; schema checks cost no job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.functions import clock


def keep_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def keep_strict(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    gone = missing(df, wanted)
    if gone:
        raise ValueError(f"Missing columns: {gone}")
    return df.select(*wanted)


def missing(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def add_missing(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns that do not exist yet are added as typed nulls."""
    new = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def halve_precision(df: DataFrame) -> DataFrame:
    """DOUBLE columns to FLOAT."""
    return df.withColumns({c: F.col(c).cast("float") for c, t in df.dtypes if t == "double"})


def available_features(df: DataFrame, features: Sequence[str], label_source: str = "Delay_Detected") -> list[str]:
    """Features the table really has; the column the label is made of is refused."""
    if label_source in features:
        raise ValueError(f"{label_source} would leak the label into the features")
    present = [f for f in features if f in df.columns]
    if not present:
        raise ValueError("none of the features is available")
    return present


def without_day(df: DataFrame, day: int, ts: str = "timestamp") -> DataFrame:
    return df.where(F.dayofmonth(ts) != day)


def since_latest(df: DataFrame, hours: float, ts: str = "timestamp") -> DataFrame:
    """Rows of the last ``hours`` before the newest row, cutoff included."""
    newest = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - clock.seconds(hours * 3600))


def since(df: DataFrame, now: Column, hours: float, ts: str = "timestamp") -> DataFrame:
    return df.where(F.col(ts) >= now - clock.seconds(hours * 3600))


def where_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())
