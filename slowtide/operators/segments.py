"""Balanced ranges of an ordered column, in any number, and what earlier ranges hand on to later ones.

Two levels. A short list of cuts on the driver divides the column into coarse ranges. Where more
ranges are needed than that list may have, each coarse range gets finer cuts, found by a sketch per
coarse range and kept as a table that is joined, never as literals; its measured size decides whether
it is broadcast. A value that alone has more rows than a range should is cut by a second column, if
there is one to order its rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.operators.sketch import fences
from slowtide.session import kept_table

ROWS_PER_SEGMENT = 1_000_000
#: Coarse ranges, and so the most cuts that the driver holds.
FIRST_LEVEL = 1024
#: Halvings that find a place among the finer cuts of a coarse range.
_HALVINGS = 30


@dataclass
class RangeIndex:
    """Numbers ranges so that their order is that of the column; equal values share a range unless ``tie`` parts them."""

    order: str
    tie: str | None = None
    cuts: list[float] = field(default_factory=list)
    #: Tie cuts of values that have a coarse range of their own, by that range's number among ``cuts``.
    hot: dict[int, list[float]] = field(default_factory=dict)
    #: Numbers of ranges of a single value, whose finer cuts are by ``tie`` then.
    alone: list[int] = field(default_factory=list)
    #: Rows (_coarse, _cuts) of finer cuts, where the first level is not enough.
    finer: DataFrame | None = None

    @property
    def single(self) -> bool:
        return not self.cuts and self.finer is None

    def place(self, df: DataFrame) -> DataFrame:
        """Add ``_coarse`` and ``_segment``, the number of the row's range."""
        if self.single:
            return df.withColumns({"_coarse": F.lit(0), "_segment": F.lit(0).cast("long")})
        placed = self._coarse(df)
        if self.finer is None:
            return placed.withColumn("_segment", F.col("_coarse").cast("long")).drop("_base")
        found = placed.join(self.finer, "_coarse", "left")
        fine = F.coalesce(cuts_upto(F.col("_cuts"), self._fine_value()), F.lit(0))
        return found.select(*df.columns, "_coarse", (F.shiftleft(F.col("_coarse").cast("long"), 32) + fine).alias("_segment"))

    def _coarse(self, df: DataFrame) -> DataFrame:
        placed = _bucket(df, self.order, self.cuts, "_base")
        if not self.hot:
            return placed.withColumn("_coarse", F.col("_base"))
        # Ranges of one value have several numbers, so those behind them move up.
        shift, moves = 0, []
        for base in range(len(self.cuts) + 1):
            moves.append(shift)
            shift += len(self.hot.get(base, []))
        sub = F.lit(0)
        for k, (base, ties) in enumerate(self.hot.items()):
            placed = _bucket(placed, self.tie, ties, f"_tie{k}")
            sub = F.when(F.col("_base") == base, F.col(f"_tie{k}")).otherwise(sub)
        moved = F.get(F.array(*map(F.lit, moves)), F.col("_base"))
        return placed.withColumn("_coarse", F.col("_base") + moved + sub).drop(*[f"_tie{k}" for k in range(len(self.hot))])

    def _fine_value(self) -> Column:
        value = F.col(self.order).cast("double")
        return F.when(F.col("_base").isin(self.alone), F.col(self.tie).cast("double")).otherwise(value) if self.alone else value


def build_index(
    df: DataFrame, order: str, rows_per_segment: int = ROWS_PER_SEGMENT, tie: str | None = None, first_level: int = FIRST_LEVEL
) -> RangeIndex:
    """An index whose ranges of ``df`` have about ``rows_per_segment`` rows each.

    One sketch pass counts the rows and finds the coarse cuts; a second pass over the column finds the finer
    ones where ``first_level`` ranges are too few. Without ``tie`` (numeric, as ``order`` is) a value stays
    whole, so then only distinct values are bounded by range. With it a value is cut if it has more rows than
    a range should, or, where finer cuts are needed, more than the ``first_level``-th part of all rows.
    """
    n, marks = fences(df, [F.col(order)], first_level)[0]
    wanted = math.ceil(n / rows_per_segment)
    if wanted <= 1:
        return RangeIndex(order, tie)
    steps = min(wanted, first_level)
    picked = Counter(marks[round(j * first_level / steps)] for j in range(1, steps))
    alone = [v for v, r in picked.items() if r > 1 or wanted > first_level] if tie else []
    index = RangeIndex(order, tie, sorted({*picked, *(math.nextafter(v, math.inf) for v in alone)}))
    index.alone = [index.cuts.index(v) + 1 for v in alone]
    hot = [v for v in alone if picked[v] > 1]
    if hot:
        own = [F.when(F.col(order) == v, F.col(tie)) for v in hot]
        for v, (_, ties) in zip(hot, fences(df, own, first_level), strict=True):
            r = picked[v] + 1
            index.hot[index.cuts.index(v) + 1] = sorted({ties[round(j * first_level / r)] for j in range(1, r)})
    if wanted > first_level:
        per_range = math.ceil(2 * wanted / first_level)
        grid = F.split(F.lit(",".join(str(j / per_range) for j in range(1, per_range))), ",").cast("array<double>")
        found = index._coarse(df).groupBy("_coarse").agg(
            F.array_distinct(F.percentile_approx(index._fine_value(), grid, max(1000, 10 * per_range))).alias("_cuts")
        )
        index.finer = kept_table(found.where(F.col("_coarse").isNotNull()), "ranges")
    return index


def _bucket(df: DataFrame, column: str, cuts: Sequence[float], name: str) -> DataFrame:
    """Number of cuts that are at most the column's value; null for null."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    placed = Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol="_value", outputCol="_placed", handleInvalid="keep"
    ).transform(df.withColumn("_value", F.col(column).cast("double")))
    return placed.withColumn(name, F.col("_placed").cast("int")).drop("_value", "_placed")


def cuts_upto(cuts: Column, value: Column) -> Column:
    """How many of the ascending ``cuts`` are at most ``value``, by halving."""

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.floor((low + high) / 2).cast("int")
        right = F.get(cuts, middle) <= value
        closed = low >= high
        return F.struct(
            F.when(closed | ~right, low).otherwise(middle + 1).alias("low"),
            F.when(closed | right, high).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_HALVINGS)), start, halve, lambda span: span["low"])


def handed_on(edges: DataFrame, keys: Sequence[str], columns: dict[str, bool], index: RangeIndex) -> DataFrame:
    """Per (key, range): the last non-null value of earlier ranges, or of later ones where ``columns`` says True.

    ``edges`` has one row per key and range that occur together, so its size follows the rows, not keys times
    ranges. With a second level the scan has two as well: within each coarse range, and over coarse ranges.
    """

    def scan(df: DataFrame, part: Sequence[str], at: str) -> DataFrame:
        up = Window.partitionBy(*part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        down = Window.partitionBy(*part).orderBy(F.desc(at)).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({f"_next_{c}": F.last(c, ignorenulls=True).over(down if back else up) for c, back in columns.items()})

    if index.finer is None:
        return scan(edges, keys, "_segment").select(*keys, "_segment", *[F.col(f"_next_{c}").alias(c) for c in columns])
    ends = edges.groupBy(*keys, "_coarse").agg(
        *[(F.min_by if back else F.max_by)(c, F.when(F.col(c).isNotNull(), F.col("_segment"))).alias(c) for c, back in columns.items()]
    )
    over = scan(ends, keys, "_coarse").select(*keys, "_coarse", *[F.col(f"_next_{c}").alias(f"_over_{c}") for c in columns])
    # Null keys are keys like others.
    inner = scan(edges, [*keys, "_coarse"], "_segment").alias("e")
    same = F.lit(True)
    for k in [*keys, "_coarse"]:
        same = same & F.col(f"e.{k}").eqNullSafe(F.col(f"o.{k}"))
    joined = inner.join(over.alias("o"), same, "left")
    return joined.select(
        *[F.col(f"e.{k}").alias(k) for k in keys], "e._segment", *[F.coalesce(f"_next_{c}", f"_over_{c}").alias(c) for c in columns]
    )


def summed_above(totals: DataFrame, columns: Sequence[str], index: RangeIndex) -> DataFrame:
    """Per range, the sums of ``columns`` over all ranges above it, scanned on two levels as in ``handed_on``."""
    above = (Window.unboundedPreceding, -1)

    def sums(df: DataFrame, part: Sequence[str], at: str, prefix: str) -> DataFrame:
        window = Window.partitionBy(*part).orderBy(F.desc(at)).rowsBetween(*above)
        return df.withColumns({f"{prefix}{c}": F.coalesce(F.sum(c).over(window), F.lit(0)) for c in columns})

    if index.finer is None:
        return sums(totals, [], "_segment", "above_").select("_segment", *[f"above_{c}" for c in columns])
    coarse = totals.groupBy("_coarse").agg(*[F.sum(c).alias(c) for c in columns])
    over = sums(coarse, [], "_coarse", "_over_").select("_coarse", *[f"_over_{c}" for c in columns])
    inner = sums(totals, ["_coarse"], "_segment", "_in_").join(over, "_coarse")
    return inner.select("_segment", *[(F.col(f"_in_{c}") + F.col(f"_over_{c}")).alias(f"above_{c}") for c in columns])
