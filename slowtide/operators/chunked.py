"""Windows over a long ordered series without sorting it in one task.

*Halo*: the series is cut in chunks of consecutive bucket ids; each row is also
sent to the neighbouring chunks whose frames reach it, the window runs per chunk,
and the copies are dropped. *Carry*: for frames without a start, each chunk gets
the result of all earlier chunks from a table with one row per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from slowtide.functions import clock
from slowtide.operators.segments import FIRST_LEVEL, ROWS_PER_SEGMENT, build_index, handed_on
from slowtide.operators.series import CHUNK


def over_halo(
    series: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    back: int = 0,
    forward: int = 0,
    keys: Sequence[str] = (),
    chunk: int = CHUNK,
) -> DataFrame:
    """Add window columns that look at most ``back`` rows back and ``forward`` rows ahead.

    ``columns`` gets the ordered window and returns name → expression; all of them
    share one shuffle and one sort.
    """
    at = F.col("bucket_id")
    spread = F.sequence(clock.floor_div(at - forward, chunk), clock.floor_div(at + back, chunk))
    window = Window.partitionBy(*keys, "_chunk").orderBy("bucket_id")
    return (
        series.withColumn("_chunk", F.explode(spread))
        .withColumns(columns(window))
        .where(F.col("_chunk") == clock.floor_div(at, chunk))
        .drop("_chunk")
    )


def rolling(window: WindowSpec, n: int) -> WindowSpec:
    return window.rowsBetween(-(n - 1), 0)


def rolling_mean(x: str, window: WindowSpec, n: int, at_least: int = 1) -> Column:
    return _enough(x, window, n, at_least, F.avg(x))


def rolling_std(x: str, window: WindowSpec, n: int, at_least: int = 1) -> Column:
    """Sample standard deviation; null on fewer than two values."""
    return _enough(x, window, n, at_least, F.stddev_samp(x))


def _enough(x: str, window: WindowSpec, n: int, at_least: int, measure: Column) -> Column:
    frame = rolling(window, n)
    value = measure.over(frame)
    return value if at_least <= 1 else F.when(F.count(x).over(frame) >= at_least, value)


def forward_fill(
    series: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), chunk: int = CHUNK
) -> DataFrame:
    """Replace nulls by the last earlier value; leading nulls stay null."""
    cut = series.withColumn("_chunk", clock.floor_div(F.col("bucket_id"), chunk))
    local = Window.partitionBy(*keys, "_chunk").orderBy("bucket_id").rowsBetween(Window.unboundedPreceding, 0)
    # One row per chunk: the only step whose window spans the whole series.
    tails = cut.groupBy(*keys, "_chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("bucket_id"))).alias(c) for c in columns]
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(
        *keys, "_chunk", *[F.last(c, ignorenulls=True).over(before).alias(f"_carried_{c}") for c in columns]
    )
    filled = {c: F.last(c, ignorenulls=True).over(local) for c in columns}
    return (
        cut.withColumns(filled)
        .join(carried, [*keys, "_chunk"], "left")
        .withColumns({c: F.coalesce(F.col(c), F.col(f"_carried_{c}")) for c in columns})
        .select(*series.columns)
    )


def forward_fill_rows(
    rows: DataFrame,
    columns: Sequence[str],
    ts: str,
    tie: str,
    keys: Sequence[str] = (),
    rows_per_segment: int = ROWS_PER_SEGMENT,
    first_level: int = FIRST_LEVEL,
) -> DataFrame:
    """Replace nulls by the last earlier value, over rows at irregular times; leading nulls stay null.

    Rows are ordered by ``ts``, equal times by ``tie``, a number that tells them apart. They are cut in balanced
    ranges of that order, so neither a busy hour nor one time with most of the rows lands in one task; the last
    value of each key and range is handed on as a table. Rows without a time come last in their key, by ``tie``.
    ``rows`` is read three times, for the ranges and the handed-on table by the columns they need only.
    """
    late = F.lit(1 << 62)
    timed = rows.withColumns({"_at": F.coalesce(clock.epoch_micros(F.col(ts)), late), "_tie": F.col(tie)})
    index = build_index(timed, "_at", rows_per_segment, tie="_tie", first_level=first_level)
    cut = index.place(timed)
    local = Window.partitionBy(*keys, "_segment").orderBy("_at", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    filled = cut.withColumns({c: F.last(c, ignorenulls=True).over(local) for c in columns})
    if not index.single:
        at = F.struct("_at", "_tie")
        ends = cut.groupBy(*keys, "_coarse", "_segment").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_carried_{c}") for c in columns])
        carried = handed_on(ends, keys, {f"_carried_{c}": False for c in columns}, index).withColumnsRenamed({k: f"_key_{k}" for k in keys})
        same = filled["_segment"] == carried["_segment"]
        for k in keys:
            same = same & filled[k].eqNullSafe(carried[f"_key_{k}"])
        filled = filled.join(carried, same, "left").withColumns({c: F.coalesce(F.col(c), F.col(f"_carried_{c}")) for c in columns})
    return filled.select(*rows.columns)
