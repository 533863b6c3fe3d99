"""Exact quantiles of columns of any size, for all rows or for every key at once.

The built-in exact percentile keeps every distinct value of a column, or of a key, in one task. Here the
input is read twice. The first pass sketches all columns of all keys (mergeable KLL sketches) and so fences
in the values at the wanted ranks. The second counts: rows below and above a fence as such, rows between
fences by value; these counts prove the fences. What is left between them, about half a percent of
the rows, is a table of its own, narrowed further where a fence still holds too many distinct values for one
sort. Only if a sketch was off its bound is the input read a third time, without fences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.operators.segments import cuts_upto
from slowtide.session import durable, kept_table

#: Distinct values between two fences that are sorted in one task.
DISTINCT_IN_ONE_SORT = 2_000_000
#: Size of a sketch; up to as many values it is exact.
SKETCH = 4000
#: Share of the rows by which a fence stands off its rank: twice the sketch's bound of error.
MARGIN = 2 * 2.296 / SKETCH**0.9021
#: Parts in which one step of narrowing divides the values between two fences.
_PARTS = 256

Targets = dict[str, tuple[Column, list[float]]]


def exact_quantiles(df: DataFrame, targets: Targets, in_one_sort: int = DISTINCT_IN_ONE_SORT, margin: float = MARGIN) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each expression over all rows, nulls and NaN skipped.

    ``targets`` maps a name to (expression, probabilities). One row reaches the driver.
    """
    row = quantiles_by(df, [], targets, in_one_sort, margin).collect()[0]
    return {name: list(row[name]) for name in targets}


def quantiles_by(df: DataFrame, keys: Sequence[str], targets: Targets, in_one_sort: int = DISTINCT_IN_ONE_SORT, margin: float = MARGIN) -> DataFrame:
    """One row per key: the keys, and per target an array of its quantiles; null where a key has no value.

    All columns, keys and probabilities share the passes. Null is a key like others; without keys there is one
    row. A key with most of the rows is counted before the shuffle, and its fences hold no more values than
    ``in_one_sort`` when they are sorted.
    """
    at = [f"_k{i}" for i in range(len(keys))]
    xs = [F.when(~F.isnan(x.cast("double")), x.cast("double")) for x, _ in targets.values()]
    rows = df.select(*[F.col(k).alias(a) for k, a in zip(keys, at, strict=True)], *[x.alias(f"x{i}") for i, x in enumerate(xs)])
    probabilities = [list(ps) for _, ps in targets.values()]
    fences = _Fences(rows, at, probabilities, margin)
    found = fences.values(rows, in_one_sort)
    if not found["proven"]:
        found = fences.opened().values(rows, in_one_sort)
    values = found["values"]
    if not keys:
        return values.select(*[F.col(f"q{i}").alias(name) for i, name in enumerate(targets)])
    return values.select(*[F.col(a).alias(k) for k, a in zip(keys, at, strict=True)], *[F.col(f"q{i}").alias(name) for i, name in enumerate(targets)])


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which nulls are values like others."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & left[c].eqNullSafe(renamed[f"_r_{c}"])
    return left.join(renamed, same, how).drop(*[f"_r_{c}" for c in on])


class _Fences:
    """Per key and column i: the number of values n{i}, and the fences lo{i} and hi{i} of each probability."""

    def __init__(self, rows: DataFrame, at: Sequence[str], probabilities: list[list[float]], margin: float) -> None:
        self.at, self.probabilities, self.margin, self.open = list(at), probabilities, margin, False
        measures = [
            c
            for i in range(len(probabilities))
            for c in (
                F.count(f"x{i}").alias(f"n{i}"),
                F.min(f"x{i}").alias(f"least{i}"),
                F.max(f"x{i}").alias(f"most{i}"),
                F.kll_sketch_agg_double(f"x{i}", SKETCH).alias(f"s{i}"),
            )
        ]

        def mark(i: int, rank: float, end: str) -> Column:
            if not 0 < rank < 1:
                return F.col(f"{end}{i}")
            # A small sketch is no better than the whole range.
            return F.when(F.col(f"n{i}") > SKETCH, F.kll_sketch_get_quantile_double(f"s{i}", F.lit(rank))).otherwise(F.col(f"{end}{i}"))

        marks = [
            c
            for i, ps in enumerate(probabilities)
            for c in (
                F.col(f"n{i}"),
                F.array(*[mark(i, p - margin, "least") for p in ps]).alias(f"lo{i}"),
                F.array(*[mark(i, p + margin, "most") for p in ps]).alias(f"hi{i}"),
            )
        ]
        found = rows.groupBy(*at).agg(*measures).select(*at, *marks)
        # One row without keys; else a table, whose size decides how it is joined.
        self.table = kept_table(found, "fences") if at else None
        self.row = None if at else found.first()
        names = [f"n{i}" for i in range(len(probabilities))]
        sizes = self.table.agg(*[F.max(n).alias(n) for n in names]).first() if at else self.row
        self.most = max((sizes[n] or 0) for n in names)

    def opened(self) -> "_Fences":
        """The same without any limit."""
        self.open, self.margin = True, 1.0
        return self

    def beside(self, df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
        """``df`` with the columns of its key that begin so."""
        columns = [f"{p}{i}" for p in prefixes for i in range(len(self.probabilities))]
        if self.table is not None:
            return _joined(df, self.table.select(*self.at, *columns), self.at)
        whole = {c: F.lit(self.row[c]).cast("array<double>" if c.startswith(("lo", "hi")) else "long") for c in columns}
        return df.withColumns(whole)

    def values(self, rows: DataFrame, in_one_sort: int) -> dict:
        """``values``: the table (key, q0, q1, …); ``proven``: whether every quantile lies between its fences."""
        counted = self._counted(rows)
        expected = self.most * (min(1.0, 2.2 * self.margin) if self.most > SKETCH else 1.0)
        if expected > in_one_sort:
            spots = self._narrowed(self._spots(durable(counted)), in_one_sort)
        else:
            spots = self._spots(counted)
        ends = self._ends(spots)
        arrays = [
            F.array(*[F.max(F.when((F.col("i") == i) & (F.col("k") == k), F.col("value"))) for k in range(len(ps))]).alias(f"q{i}")
            for i, ps in enumerate(self.probabilities)
        ]
        values = ends.groupBy(*self.at).agg(*arrays)
        if self.table is None:
            row = values.first()
            missing = any(row[f"q{i}"][k] is None for i, ps in enumerate(self.probabilities) if self.row[f"n{i}"] for k in range(len(ps)))
            return {"values": rows.sparkSession.createDataFrame([row], values.schema), "proven": not missing}
        nothing = {f"q{i}": F.coalesce(f"q{i}", F.array(*[F.lit(None).cast("double")] * len(ps))) for i, ps in enumerate(self.probabilities)}
        sizes = self.table.select(*self.at, *[f"n{i}" for i in range(len(arrays))])
        whole = kept_table(_joined(sizes, values, self.at, "left").withColumns(nothing), "quantiles")
        lost = [(F.col(f"n{i}") > 0) & F.exists(f"q{i}", lambda v: v.isNull()) for i in range(len(arrays))]
        missing = whole.agg(*[F.max(x.cast("int")).alias(f"m{i}") for i, x in enumerate(lost)]).first()
        return {"values": whole, "proven": not any(missing)}

    def _counted(self, rows: DataFrame) -> DataFrame:
        """Rows (key, i, zone, v, n): n values of column i in a zone, by value where the zone lies between any fences.

        Digit k of ``zone`` to the base of three says whether the value is below the fences of probability k (0),
        between them (1) or above (2). Every value makes one row before it is counted.
        """
        fenced = rows if self.open else self.beside(rows, ["lo", "hi"])
        entries = []
        for i, ps in enumerate(self.probabilities):
            x, zone, inside = F.col(f"x{i}"), F.lit(0), F.lit(self.open)
            for k in range(len(ps)):
                if self.open:
                    zone = zone + F.lit(3**k)
                    continue
                low, high = F.get(f"lo{i}", F.lit(k)), F.get(f"hi{i}", F.lit(k))
                zone = zone + F.when(x < low, 0).when(x <= high, 1).otherwise(2) * 3**k
                inside = inside | x.between(low, high)
            entries.append(F.struct(F.lit(i).alias("i"), F.when(x.isNotNull(), zone.cast("long")).alias("zone"), F.when(inside, x).alias("v")))
        stacked = fenced.select(*self.at, F.inline(F.array(*entries))).where(F.col("zone").isNotNull())
        return stacked.groupBy(*self.at, "i", "zone", "v").agg(F.count("*").alias("n"))

    def _spots(self, counted: DataFrame) -> DataFrame:
        """Rows (key, i, k, side, v, n, place): what is below (0) or between (1) the fences, and the quantile's place."""
        most = max(len(ps) for ps in self.probabilities)
        chances = F.array(*[F.array(*[F.lit(float(p)) for p in ps]) for ps in self.probabilities])
        digits = F.array(*[F.struct(F.lit(k).alias("k"), F.expr(f"zone div {3**k} % 3").alias("side")) for k in range(most)])
        split = self.beside(counted, ["n"]).withColumn("_n", F.get(F.array(*[F.col(f"n{i}") for i in range(len(self.probabilities))]), F.col("i")))
        spots = split.select(*self.at, "i", "v", "n", "_n", F.inline(digits)).where(F.col("side") < 2)
        return spots.select(*self.at, "i", "k", "side", "v", "n", (F.get(F.get(chances, F.col("i")), F.col("k")) * (F.col("_n") - 1)).alias("place")).where("place >= 0")

    def _ends(self, spots: DataFrame) -> DataFrame:
        """Rows (key, i, k, value), from a running count over what is below and between the fences."""
        group = [*self.at, "i", "k"]
        up = Window.partitionBy(*group).orderBy("side", "v").rowsBetween(Window.unboundedPreceding, 0)
        upto = spots.withColumn("upto", F.sum("n").over(up)).where("side = 1")

        def at_rank(rank: Column) -> Column:
            return F.max(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")), F.col("v")))

        ends = upto.groupBy(*group).agg(at_rank(F.floor("place")).alias("a"), at_rank(F.ceil("place")).alias("b"), F.max("place").alias("place"))
        # Equal ends need no difference, which infinities do not have.
        between = F.col("a") + (F.col("b") - F.col("a")) * (F.col("place") - F.floor("place"))
        return ends.select(*group, F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(between).alias("value"))

    def _narrowed(self, spots: DataFrame, in_one_sort: int) -> DataFrame:
        """Spots in which no group has more values between its fences than ``in_one_sort``, or the two around the quantile.

        Each step parts the distinct values of all large groups by a sketch and keeps the parts that the place
        falls in, by their counts; what is below them becomes one row.
        """
        group = [*self.at, "i", "k"]
        grid = F.split(F.lit(",".join(str(j / _PARTS) for j in range(1, _PARTS))), ",").cast("array<double>")
        many = None
        while True:
            sizes = kept_table(spots.groupBy(*group).agg(F.count_if(F.col("side") == 1).alias("distinct")), "sizes")
            now = sizes.agg(F.max("distinct")).first()[0] or 0
            if now <= max(in_one_sort, 2) or (many is not None and now >= many):
                return spots
            many = now
            large = _joined(spots.where("side = 1"), sizes.where(F.col("distinct") > max(in_one_sort, 2)).select(*group), group)
            marks = kept_table(large.groupBy(*group).agg(F.percentile_approx("v", grid, 10 * _PARTS).alias("cuts")), "marks")
            part = F.when(F.col("side") == 0, F.lit(-1)).otherwise(F.coalesce(cuts_upto(F.col("cuts"), F.col("v")), F.lit(0)))
            parted = durable(_joined(spots, marks, group, "left").withColumn("part", part).drop("cuts"))
            sums = parted.groupBy(*group, "part").agg(F.sum("n").alias("n"), F.max("place").alias("place"))
            up = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
            upto = F.sum("n").over(up)
            placed = sums.withColumns({"before": upto - F.col("n"), "upto": upto})
            hit = (F.col("part") >= 0) & (F.col("before") <= F.ceil("place")) & (F.floor("place") < F.col("upto"))
            kept = placed.where(hit)
            inner = _joined(parted, kept.select(*group, "part"), [*group, "part"]).select(*group, "side", "v", "n", "place")
            below = kept.groupBy(*group).agg(F.min("before").alias("n"), F.max("place").alias("place")).where("n > 0")
            spots = durable(inner.unionByName(below.select(*group, F.lit(0).cast(inner.schema["side"].dataType).alias("side"), F.lit(None).cast("double").alias("v"), "n", "place")))
