"""0/1 flags, labels and clean-up rules on single columns; a null input never raises a flag."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def is_delayed(response_time: Column, limit: float = 2000) -> Column:
    return flag(no_nan(response_time) > limit)


def is_error(status: Column) -> Column:
    return flag(status >= 400)


def is_success(status: Column) -> Column:
    return flag((status >= 200) & (status < 400))


def no_nan(x: Column) -> Column:
    """NaN becomes null, so that comparisons and aggregates skip it."""
    return F.when(~F.isnan(x), x)


def finite(x: Column) -> Column:
    """Null and NaN become 0, infinities the largest double of their sign."""
    top = sys.float_info.max
    return F.coalesce(clip(no_nan(x), -top, top), F.lit(0.0))


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """Force into [low, high]; null stays null."""
    bounded = x
    if low is not None:
        bounded = F.greatest(bounded, F.lit(float(low)))
    if high is not None:
        bounded = F.least(bounded, F.lit(float(high)))
    return F.when(x.isNotNull(), bounded)


def path_depth(url: Column) -> Column:
    return F.regexp_count(F.coalesce(url, F.lit("")), F.lit("/")).cast("int")


def last_segment(url: Column) -> Column:
    return F.substring_index(F.coalesce(url, F.lit("")), "/", -1)


def decision(p: Column, threshold: float | Column) -> Column:
    return flag(p > threshold)


def confidence_label(p: Column) -> Column:
    distance = F.abs(p - F.lit(0.5))
    return F.when(distance > 0.3, "High").when(distance > 0.1, "Medium").otherwise("Low")


def confidence_label_shifted(p: Column) -> Column:
    """Variant that measures "High" from 0.7 instead of 0.5."""
    return (
        F.when(F.abs(p - F.lit(0.7)) > 0.3, "High")
        .when(F.abs(p - F.lit(0.5)) > 0.1, "Medium")
        .otherwise("Low")
    )


def confidence_score(p: Column) -> Column:
    return F.greatest(p, F.lit(1.0) - p)


def answer_text(label: Column) -> Column:
    return F.when(label == 1, "Yes").otherwise("No")


def log_loss(label: Column, p: Column, weight: Column | None = None, eps: float = 1e-7) -> Column:
    """Per-row binary cross-entropy with the probability kept ``eps`` away from 0 and 1."""
    bounded = clip(p, eps, 1.0 - eps)
    loss = -(label * F.ln(bounded) + (F.lit(1) - label) * F.ln(F.lit(1.0) - bounded))
    return loss if weight is None else loss * weight


def asymmetric_weight(label: Column, positive: float = 3.0, negative: float = 1.0) -> Column:
    return F.when(label == 1, F.lit(positive)).otherwise(F.lit(negative))
