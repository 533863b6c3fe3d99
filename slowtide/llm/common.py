"""Helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.session import fresh_folder

#: Bytes of text that a task works on at a time; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there; ``options`` are the writer's."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def beside(columns: list[str], outputs: set[str]) -> list[str]:
    """Names that ``columns`` have beside ``outputs``: one that clashes gets ``_input`` added until it is free."""
    taken, out = {c.lower() for c in columns} | outputs, []
    for c in columns:
        if c.lower() in outputs:
            while c.lower() in taken:
                c += "_input"
            taken.add(c.lower())
        out.append(c)
    return out


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two columns that tell rows apart: equal rows share them, and get equal results."""
    return [F.col(id_col).alias("row_id"), F.xxhash64(F.col(text_col)).alias("row_hash")]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a string column: first row, UTF-8 bytes of its texts, where each text begins and ends in them.

    Nulls read as empty. Only a text that is longer than ``limit`` makes a larger slice.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first, n = 0, len(column)
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield first, flat[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run meanwhile hand tasks at most ``rows`` rows at a time, which bounds what a worker holds."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class BitFilter:
    """A set of 64-bit hashes in a fixed number of bits, three for each: never misses a member, may take others for one."""

    def __init__(self, bits: int, words: np.ndarray) -> None:
        self.bits, self.words = bits, words

    @staticmethod
    def shifts(bits: int) -> list[int]:
        """Where in a hash its three places are read."""
        return [64 - bits, (64 - bits) // 2, 0]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for shift in self.shifts(self.bits):
            at = hashes.view(np.uint64) >> np.uint64(shift) & np.uint64((1 << self.bits) - 1)
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
        return found

    @property
    def empty(self) -> bool:
        return not self.words.any()


def bit_filter(hashes: DataFrame, column: str, bits: int) -> BitFilter:
    """Filter over a column of longs. Its size, and so what reaches the driver, is 2^bits bits whatever the input."""
    places = F.array(*(F.shiftrightunsigned(column, s).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) for s in BitFilter.shifts(bits)))
    words = hashes.select(F.explode(places).alias("bit")).select(F.shiftright("bit", 6).alias("word"), F.col("bit").bitwiseAND(63).cast("int").alias("at"))
    found = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, at))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return BitFilter(bits, out)


class Shipped:
    """A filter as a broadcast of plain values, which workers read without this package."""

    def __init__(self, spark: SparkSession, made: BitFilter) -> None:
        self._plain = spark.sparkContext.broadcast((made.bits, made.words))

    @property
    def value(self) -> BitFilter:
        return BitFilter(*self._plain.value)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups, and where each group begins and ends, from batches sorted by ``keys``.

    Only the last group of a batch is carried into the next one, so groups must be of bounded size.
    """
    kept: pa.Table | None = None

    def changes(t: pa.Table) -> np.ndarray:
        new = np.zeros(max(t.num_rows - 1, 0), dtype=bool)
        for k in keys:
            x = t[k].to_numpy()
            new |= x[1:] != x[:-1]
        return np.flatnonzero(new) + 1

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if kept is None else pa.concat_tables([kept, t])
        edges = changes(t)
        if not len(edges):
            kept = t
            continue
        yield t.slice(0, edges[-1]).combine_chunks(), np.concatenate([[0], edges])
        kept = t.slice(edges[-1])
    if kept is not None:
        yield kept.combine_chunks(), np.array([0, kept.num_rows])
