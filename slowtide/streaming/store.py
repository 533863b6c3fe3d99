"""Buckets of a stream as mergeable parts: one folder per micro-batch, merged when they are read.

A part holds what a batch adds to each bucket (maximum, sum, number of values), so rows that come late
merge into a bucket that was read before, in whatever order files arrive and however they fall into
batches. A repeated batch replaces its folder. Every few batches the parts become one base table, so a
reader opens a bounded number of folders; with ``keep`` the base drops buckets older than that.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowtide.functions import clock

#: Batches after which the parts become one base.
COMPACT = 16
#: What a stream measures: name to (max, sum, mean or count; column).
Measures = Mapping[str, tuple[str, Column]]


class PartStore:
    def __init__(self, spark: SparkSession, folder: str, measures: Measures, step: int, keep: timedelta | None = None, compact: int = COMPACT) -> None:
        self.spark, self.folder, self.measures, self.step = spark, folder, measures, step
        self.keep, self.compact = keep, compact
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def part(self, rows: DataFrame, ts: str = "timestamp") -> DataFrame:
        """What ``rows`` add to their buckets; rows without a time add nothing."""
        measured = {name: (kind, column) for name, (kind, column) in self.measures.items()}
        parts = [F.max(clock.epoch_micros(F.col(ts))).alias("newest")]
        for name, (kind, column) in measured.items():
            if kind in ("sum", "mean"):
                parts.append(F.sum(column).alias(f"sum_{name}"))
            if kind in ("count", "mean"):
                parts.append(F.count(column).alias(f"count_{name}"))
            if kind == "max":
                parts.append(F.max(column).alias(f"max_{name}"))
        return rows.where(F.col(ts).isNotNull()).groupBy(clock.bucket_of(F.col(ts), self.step).alias("bucket_id")).agg(*parts)

    def add(self, rows: DataFrame, batch: int) -> None:
        """Keep the part of a micro-batch, in place of one with that number."""
        self.part(rows).write.mode("overwrite").parquet(f"{self.folder}/parts/{batch}")
        if (batch + 1) % self.compact == 0:
            whole = self._merged(self._read(batch))
            if self.keep is not None:
                newest = whole.agg(F.max("newest")).first()[0]
                oldest = (newest or 0) - self.keep // timedelta(microseconds=1)
                whole = whole.where((F.col("bucket_id") + 1) * (self.step * clock.MICROS) > oldest)
            whole.write.mode("overwrite").parquet(f"{self.folder}/base/{batch}")

    def _numbers(self, kind: str) -> list[int]:
        """Batches that have a committed folder of this kind."""
        top = self._path(f"{self.folder}/{kind}")
        found = self._files.listStatus(top) if self._files.exists(top) else []
        done = [s.getPath() for s in found if self._files.exists(self._path(s.getPath(), "_SUCCESS"))]
        return sorted(int(p.getName()) for p in done)

    def _read(self, upto: int | None = None) -> DataFrame:
        """The newest base before ``upto``, and the parts behind it."""
        bases = [b for b in self._numbers("base") if upto is None or b < upto]
        last = bases[-1] if bases else -1
        parts = [p for p in self._numbers("parts") if p > last and (upto is None or p <= upto)]
        folders = [*[f"{self.folder}/base/{b}" for b in bases[-1:]], *[f"{self.folder}/parts/{p}" for p in parts]]
        if not folders:
            return self.spark.createDataFrame([], self._schema())
        return self.spark.read.schema(self._schema()).parquet(*folders)

    def _schema(self) -> T.StructType:
        """Columns of a part; sums and maxima in the types that they have over the measures' columns."""
        if not hasattr(self, "_known"):
            raise RuntimeError("tell the store the rows' schema first")
        return self._known

    def knowing(self, rows: DataFrame) -> "PartStore":
        """This store for rows of the schema of ``rows``, which may be a stream."""
        self._known = self.part(self.spark.createDataFrame([], rows.schema)).schema
        return self

    def _merged(self, parts: DataFrame) -> DataFrame:
        merge = [(F.max if c.startswith(("max_", "newest")) else F.sum)(c).alias(c) for c in parts.columns if c != "bucket_id"]
        return parts.groupBy("bucket_id").agg(*merge)

    def buckets(self, lateness: timedelta, since: timedelta | None = None) -> DataFrame:
        """Rows (bucket_id, bucket, measures) of the buckets that ended ``lateness`` before the newest row or earlier.

        ``since`` leaves out those that ended longer before the newest closed bucket's end.
        """
        merged = self._merged(self._read())
        # One row, so that every bucket is compared with the same newest time.
        newest = merged.agg(F.max("newest")).first()[0]
        if newest is None:
            newest = 0
        length = self.step * clock.MICROS
        closed = (newest - lateness // timedelta(microseconds=1)) // length
        rows = merged.where(F.col("bucket_id") < closed)
        if since is not None:
            last = rows.agg(F.max("bucket_id")).first()[0] or 0
            rows = rows.where(F.col("bucket_id") * length >= (last + 1) * length - since // timedelta(microseconds=1))
        return rows.select("bucket_id", clock.bucket_start(F.col("bucket_id"), self.step).alias("bucket"), *[self._measure(n, k).alias(n) for n, (k, _) in self.measures.items()])

    def _measure(self, name: str, kind: str) -> Column:
        if kind == "mean":
            return F.try_divide(F.col(f"sum_{name}"), F.col(f"count_{name}"))
        return F.col(f"{kind}_{name}")
