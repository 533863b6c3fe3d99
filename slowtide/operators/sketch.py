"""Approximate fences of numeric columns, gathered so that no task merges every sketch.

Fences only steer later work (where to cut, where to look); whoever uses them proves
or does not need their exactness.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GROUPS = 256


def fences(df: DataFrame, columns: Sequence[Column], steps: int) -> list[tuple[int, list[float]]]:
    """Per column: how many values it has, and ``steps + 1`` evenly spaced values of it.

    Each task's sketch goes to one of a few hundred groups; only the groups' fences
    are merged at the end.
    """
    grid = F.split(F.lit(",".join(str(j / steps) for j in range(steps + 1))), ",").cast("array<double>")
    per_group = df.groupBy((F.spark_partition_id() % _GROUPS).alias("_group")).agg(
        *[
            F.struct(
                F.count(c).alias("n"), F.percentile_approx(c.cast("double"), grid, max(1000, 10 * steps)).alias("fences")
            ).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    # At most one row per group; a group weighs as much as it has values.
    rows = per_group.collect()
    return [_merge([r[f"s{i}"] for r in rows], steps) for i in range(len(columns))]


def _merge(sketches: list, steps: int) -> tuple[int, list[float]]:
    weighted = sorted(
        (x, s["n"] / (steps + 1)) for s in sketches if s["n"] for x in s["fences"]
    )
    total = sum(s["n"] for s in sketches)
    if not total:
        return 0, []
    merged, passed, at = [], 0.0, iter(weighted)
    x, weight = next(at)
    for j in range(steps + 1):
        goal = j * total / steps
        while passed + weight < goal:
            following = next(at, None)
            if following is None:
                break
            passed += weight
            x, weight = following
        merged.append(x)
    return total, merged
