"""As-of join: each left row with the right row nearest in time.

Only the distinct left times take part in the search. They and the right times are
cut in balanced ranges, each range is scanned forwards and backwards, and rows before
the first or after the last right row of a range look into the neighbouring ranges. A time or range with
most of the rows therefore neither pairs up rows nor lands in one task; the final
equi-join on time is left to AQE's skew handling.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slowtide.functions import clock
from slowtide.operators.segments import FIRST_LEVEL, ROWS_PER_SEGMENT, RangeIndex, build_index, handed_on
from slowtide.session import durable


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] = (),
    direction: str = "nearest",
    tolerance: timedelta | None = None,
    tie: Sequence[str] = (),
    suffixes: tuple[str, str] = ("_x", "_y"),
    rows_per_segment: int = ROWS_PER_SEGMENT,
    first_level: int = FIRST_LEVEL,
) -> DataFrame:
    """Left outer join on the nearest ``on`` (``backward``, ``forward`` or ``nearest``).

    Every left row appears once. The tolerance is inclusive; at equal distance the
    earlier right row wins. Right rows with the same time are ordered by ``tie`` (all
    their columns if not given): looking back, the last of them matches, looking
    ahead the first. Null values of the matched row stay null; a null left time is an
    error. Other columns that occur on both sides get ``suffixes``.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction: {direction}")
    payload = [c for c in right.columns if c not in (on, *by)]
    both = set(payload) & set(left.columns)
    picked = {c: c + suffixes[1] if c in both else c for c in payload}
    order = F.struct(*[F.col(c) for c in (tie or payload)]) if (tie or payload) else F.struct(F.lit(0))
    whole = F.struct(*[F.col(c) for c in payload]) if payload else F.struct(F.lit(0).alias("_"))

    samples = (
        right.where(F.col(on).isNotNull())
        .groupBy(*by, on)
        .agg(F.max_by(whole, order).alias("last"), F.min_by(whole, order).alias("first"))
    )
    at = clock.epoch_micros(F.col(on))
    nothing = F.lit(None).cast(samples.schema["last"].dataType)
    times = (
        left.where(F.col(on).isNotNull())
        .select(*by, on)
        .distinct()
        .select(*by, on, at.alias("at"), F.lit(1).alias("side"), nothing.alias("last"), nothing.alias("first"))
    )
    steps = samples.select(*by, on, at.alias("at"), F.lit(0).alias("side"), "last", "first").unionByName(times)
    all_times = left.select(at.alias("at")).unionAll(right.select(at.alias("at")))
    index = build_index(all_times, "at", rows_per_segment, first_level=first_level)
    cut = (
        index.place(steps)
        .withColumn("back", F.when(F.col("side") == 0, F.struct("at", F.col("last").alias("row"))))
        .withColumn("ahead", F.when(F.col("side") == 0, F.struct("at", F.col("first").alias("row"))))
        .drop("last", "first")
    )
    if not index.single:
        # Read twice from here on: by the scan and for what ranges hand on.
        cut = durable(cut)
    within = Window.partitionBy(*by, "_segment")
    so_far = (Window.unboundedPreceding, 0)
    scanned = cut
    if direction != "forward":
        up = within.orderBy("at", "side").rowsBetween(*so_far)
        scanned = scanned.withColumn("back", F.last("back", ignorenulls=True).over(up))
    if direction != "backward":
        down = within.orderBy(F.desc("at"), F.asc("side")).rowsBetween(*so_far)
        scanned = scanned.withColumn("ahead", F.last("ahead", ignorenulls=True).over(down))
    found = scanned.where(F.col("side") == 1)
    back, ahead = F.col("back"), F.col("ahead")
    if not index.single:
        found = found.join(neighbours(cut, by, index), [*by, "_segment"], "left")
        back, ahead = F.coalesce(back, F.col("tail")), F.coalesce(ahead, F.col("head"))
    to_back, to_ahead = F.col("at") - back["at"], ahead["at"] - F.col("at")
    if direction == "backward":
        chosen, distance = back, to_back
    elif direction == "forward":
        chosen, distance = ahead, to_ahead
    else:
        use_back = ahead.isNull() | (to_back <= to_ahead)
        chosen, distance = F.when(use_back, back).otherwise(ahead), F.when(use_back, to_back).otherwise(to_ahead)
    if tolerance is not None:
        chosen = F.when(distance <= int(tolerance / timedelta(microseconds=1)), chosen)
    matches = found.select(*by, on, chosen["row"].alias("_match"))

    no_time = F.raise_error(F.lit(f"as-of join: null in left column {on}")).cast(left.schema[on].dataType)
    renamed = left.withColumn(on, F.when(F.col(on).isNull(), no_time).otherwise(F.col(on)))
    joined = renamed.join(matches, [*by, on], "left")
    return joined.select(
        *[F.col(c).alias(c + suffixes[0]) if c in both else F.col(c) for c in left.columns],
        *[F.col("_match")[c].alias(name) for c, name in picked.items()],
    )


def neighbours(cut: DataFrame, by: Sequence[str], index: RangeIndex) -> DataFrame:
    """Per key and range with rows: the last right row of the ranges before it, the first of those after it."""
    edges = cut.groupBy(*by, "_coarse", "_segment").agg(
        F.max_by("back", F.when(F.col("side") == 0, F.col("at"))).alias("tail"),
        F.min_by("ahead", F.when(F.col("side") == 0, F.col("at"))).alias("head"),
    )
    return handed_on(edges, by, {"tail": False, "head": True}, index)
