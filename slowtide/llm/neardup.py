"""Near duplicates among embeddings: corners of cross polytopes after fast Hadamard rotations.

A rotation is three rounds of random signs and a fast Hadamard transform; its corners are the
coordinate directions and their opposites. All corners of several rotations divide the sphere into
regions: a vector stands in the regions of its nearest corners, in so many that all but ``MISSED`` of
the linked pairs have one in common. Vectors of a region are compared by blocked matrix products,
and pairs at the threshold once more in double precision.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.llm.common import batches_of, stored, whole_groups
from slowtide.llm.components import components
from slowtide.llm.words import mixed
from slowtide.session import fresh_folder

#: Further corners that are looked into for each rotation, and the share of linked pairs at the threshold that may be missed.
PROBES, MISSED = 2, 1e-3
#: Vectors of a region that meet others in one task at a time, at least, at most, and by the numbers that they have.
LEAST_BLOCK, BLOCK, BLOCK_NUMBERS = 256, 8192, 1 << 20
#: Corners for the square root of the number of vectors: more of them cost time to find the nearest ones, fewer to compare more vectors.
CORNERS = 6
#: Nearest corners of a vector at most, and pairs that are drawn to learn how many are needed.
MOST_NEAR, PAIRS = 64, 4096
#: Vectors that a tile of a matrix product has on its sides.
TILE = 256, 2048
#: Copies of all vectors that a round deals out; rounds of less than so many bytes are not worth it.
COPIES, LEAST_ROUND = 1.8, 1 << 28
#: Bytes that are compared at a time, that a task gathers before it deals them out, and of a row that carries several copies.
GROUP_BYTES, GATHER_BYTES, ROW_BYTES = 1 << 23, 1 << 25, 1 << 16
#: Tables of vectors are written without dictionaries, which would hold each of them.
PLAIN = {"parquet.enable.dictionary": "false"}
#: What stands in front of a copy.
HEAD = np.dtype([("code", "<i8"), ("c", "<i8"), ("size", "<i8"), ("i", "<i4"), ("j", "<i4"), ("block", "<i4"), ("none", "<i4")])


def plan(n: int, dims: int, cosine: float = 0.9) -> tuple[int, int]:
    """Tables and rotations per bucket for ``n`` vectors: enough rotations that random vectors rarely share
    a bucket (an eighth of a vector for each), and enough tables for ``MISSED`` at the given width and cosine.
    """
    width = 1 << max(1, (dims - 1).bit_length())
    rotations = max(2, math.ceil(math.log(8 * max(n, 1)) / math.log(2 * width)))
    return math.ceil(math.log(MISSED) / math.log(1 - shared_chance(dims, cosine, rotations))), rotations


def shared_chance(dims: int, cosine: float, rotations: int, pairs: int = 512, tables: int = 16) -> float:
    """Chance that a pair of the given cosine shares a bucket of a table (own or probed), from simulated pairs; the same each time."""
    a, b = _drawn_pairs(dims, cosine, pairs)
    machine = CrossPolytope(dims, tables, rotations, seed=5)
    x, y = machine.buckets(a), machine.buckets(b)
    shared = (x == y[:, :, :1]).any(axis=2) | (y == x[:, :, :1]).any(axis=2)
    return min(max(float(shared.mean()), 1 / shared.size), 0.999)


def block_rows(dims: int) -> int:
    return max(LEAST_BLOCK, min(BLOCK, BLOCK_NUMBERS // max(dims, 1)))


def layout(n: int, dims: int, cosine: float, seed: int = 11) -> tuple[int, int]:
    """Rotations, and nearest corners whose regions a vector stands in, for ``n`` vectors; no rotation: all meet in one region.

    Corners grow with the square root of ``n``, as far as few enough of them are needed. How many are is
    learned from drawn pairs of the given cosine, the same each time: half of ``MISSED`` may share none.
    """
    width = 1 << max(PROBES.bit_length(), (dims - 1).bit_length())
    rotations = max(1, round(CORNERS * math.sqrt(n) / (2 * width)))
    while n > block_rows(dims) and cosine > 0:
        near = _near_needed(dims, cosine, rotations, seed)
        if near <= MOST_NEAR and 2 * near * near < 2 * width * rotations:
            return rotations, near
        if rotations == 1:
            break
        rotations //= 2
    return 0, 1


def _near_needed(dims: int, cosine: float, rotations: int, seed: int) -> int:
    a, b = _drawn_pairs(dims, cosine, PAIRS)
    machine = CrossPolytope(dims, 1, rotations, seed=seed)
    most = min(MOST_NEAR, 2 * machine.width * rotations // 2)
    x, y = (machine.nearest(v.astype(np.float32), most) for v in (a, b))
    rank = np.full(len(a), MOST_NEAR)
    for p in range(most):
        same = x[:, p : p + 1] == y
        rank = np.where(same.any(axis=1), np.minimum(rank, np.maximum(p, same.argmax(axis=1))), rank)
    return int(np.sort(rank)[-1 - int(PAIRS * MISSED / 2)]) + 1


def _drawn_pairs(dims: int, cosine: float, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(3)
    a = unit_rows(rng.normal(size=(pairs, dims)))
    side = rng.normal(size=(pairs, dims))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    return a, a if dims == 1 else cosine * a + math.sqrt(max(0.0, 1 - cosine * cosine)) * unit_rows(side)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width, step = *x.shape, 1
    x = x.copy()
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


class CrossPolytope:
    """Corners near unit vectors, and bucket numbers; the same for the same seed."""

    def __init__(self, dims: int, tables: int, rotations: int, probes: int = PROBES, seed: int = 11) -> None:
        # Wide enough for the corners that are looked into.
        self.width = 1 << max(probes.bit_length(), (dims - 1).bit_length())
        self.tables, self.rotations, self.probes = tables, rotations, probes
        self.dims, self._directions = dims, None
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, rotations, 3, self.width))

    @property
    def directions(self) -> np.ndarray:
        """What the first table's rotations make of the unit vectors, side by side: a product with it rotates in all ways."""
        if self._directions is None:
            self._directions = np.empty((self.dims, self.rotations * self.width), dtype=np.float32)
            for r, rounds in enumerate(self.signs[0]):
                x = np.eye(self.dims, self.width)
                for signs in rounds:
                    x = hadamard(x * signs)
                self._directions[:, r * self.width : (r + 1) * self.width] = x
        return self._directions

    def nearest(self, vectors: np.ndarray, near: int) -> np.ndarray:
        """The ``near`` nearest corners of all rotations for each vector, nearest first.

        The largest of each group of columns are found first; only the groups of the ``near`` largest can hold a nearest corner.
        """
        columns = self.directions.shape[1]
        size = 32 if columns >= 64 * near and self.width % 32 == 0 else 1
        turned, out = np.ascontiguousarray(self.directions.T), np.empty((len(vectors), near), dtype=np.int32)
        for begin in range(0, len(vectors), 256):
            some = np.ascontiguousarray(vectors[begin : begin + 256].T)
            n = some.shape[1]
            scores, tops = np.empty((columns, n), dtype=np.float32), np.empty((columns // size, n), dtype=np.float32)
            # A product of so many columns stays in the processor's cache.
            for at in range(0, columns, 1024):
                part = np.matmul(turned[at : at + 1024], some, out=scores[at : at + 1024]).reshape(-1, size, n)
                np.maximum(part.max(axis=1), -part.min(axis=1), out=tops[at // size : at // size + len(part)])
            best = np.argpartition(np.ascontiguousarray(-tops.T), near - 1, axis=1)[:, :near]
            found = scores.reshape(-1, size, n)[best, :, np.arange(n)[:, None]].reshape(n, -1)
            among = (best[:, :, None] * size + np.arange(size)).reshape(n, -1)
            at = np.argpartition(-np.abs(found), near - 1, axis=1)[:, :near]
            order = np.argsort(-np.abs(np.take_along_axis(found, at, axis=1)), axis=1, kind="stable")
            at = np.take_along_axis(at, order, axis=1)
            out[begin : begin + n] = np.take_along_axis(among, at, axis=1) * 2 + (np.take_along_axis(found, at, axis=1) < 0)
        return out

    def corners(self, vectors: np.ndarray, table: int, rotation: int) -> np.ndarray:
        """The ``1 + probes`` nearest corners of each vector after one rotation, nearest first."""
        x = np.zeros((len(vectors), self.width))
        x[:, : vectors.shape[1]] = vectors
        for signs in self.signs[table, rotation]:
            x = hadamard(x * signs)
        near = np.argsort(-np.abs(x), axis=1, kind="stable")[:, : 1 + self.probes]
        return near * 2 + (np.take_along_axis(x, near, axis=1) < 0)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """Per vector and table: its own bucket, then those that differ in one rotation by a next nearest corner.

        Numbers are scrambled, as they outgrow 64 bits from nine rotations on; vectors of another width get others.
        """
        out = np.zeros((len(vectors), self.tables, 1 + self.rotations * self.probes), dtype=np.int64)
        for t in range(self.tables):
            corners = [self.corners(vectors, t, r) for r in range(self.rotations)]
            choices = [[0] * self.rotations]
            choices += [[p if r == at else 0 for r in range(self.rotations)] for at in range(self.rotations) for p in range(1, 1 + self.probes)]
            for k, choice in enumerate(choices):
                number = np.full(len(vectors), t * 65536 + vectors.shape[1], dtype=np.uint64)
                for r, p in enumerate(choice):
                    number = mixed(number * np.uint64(2 * self.width) + corners[r][:, p].astype(np.uint64))
                out[:, t, k] = number.view(np.int64)
        return out


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 11) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of ``vectors``.

    Links join vectors whose cosine is at least ``cosine``; those found are right, a few may be missed
    (see ``MISSED``, and the tests for measured recall). Vectors that are null, empty, zero, or hold
    null or non-finite components link with nothing. Vectors of different length are not compared.
    Rows of equal id and components are one vector. A null id is in no component and not kept.
    Other columns are ignored; an empty table gives no rows.

    Equal vectors are one class that enters the search once, with its number of members. A
    region's classes are dealt to blocks; pairs of blocks meet in a task, so no region is gathered
    whole. A pair counts in the first region that it shares, and a task sends only counts and a
    spanning set of links on. Regions are worked off in rounds, so that the copies of the vectors that are
    dealt out at a time stay in proportion to the input.
    """
    spark = vectors.sparkSession
    kind = "float" if vectors.select(vector_col).dtypes[0][1] == "array<float>" else "double"
    number = np.dtype(np.float32 if kind == "float" else np.float64)
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"))
    hashes = [F.when(F.col("v").isNotNull(), x) for x in (F.xxhash64("v"), F.xxhash64(F.lit(2), "v"))]
    rows = source.mapInArrow(_packed(number), "vec_id long, v binary").withColumns(dict(zip("ch", hashes, strict=True)))
    path = fresh_folder(spark, "vector-rows")
    rows.write.options(**PLAIN).parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    ids = stored(rows.select("vec_id", "c", "h", (F.length("v") / number.itemsize).cast("int").alias("width")), "vector-ids")
    known = ids.filter("c IS NOT NULL")
    members = stored(known.groupBy("c", "h").agg(F.min("vec_id").alias("least"), F.countDistinct("vec_id").alias("size"), F.count("*").alias("n")), "vector-members")
    widest = known.agg(F.max("width")).first()[0] or 1
    wide = known.groupBy("width").agg(F.count("*").alias("n")).filter(F.col("n") > LEAST_BLOCK).collect()
    layouts = {r["width"]: layout(r["n"], r["width"], cosine, seed) for r in wide}
    with batches_of(spark, max(16, (1 << 24) // max(ROW_BYTES, widest * number.itemsize))):
        placed = _classes(rows.filter("c IS NOT NULL"), members, layouts, number, seed)
        # From here on, vectors are read from their classes; a second copy of the input would stay for all rounds.
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        found = _found(placed, layouts, number, cosine)
    counts = found.filter("links > 0").groupBy("c").agg(F.sum("links").alias("links"))
    graph = components(found.filter("to IS NOT NULL").select(F.col("c").alias("a"), F.col("to").alias("b")))
    linked = members.join(counts, "c").join(graph, F.col("c") == F.col("node")).select("c", "h", "size", "least", "links", "root")
    roots = linked.groupBy("root").agg(F.min("least").alias("component"))
    classes = members.select("c", "h", "size", "least").join(linked.join(roots, "root").select("c", "h", "links", "component"), ["c", "h"], "left")
    classes = classes.select("c", "h", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "least").alias("component"))
    out = ids.select("vec_id", "c", "h").join(classes, ["c", "h"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _classes(rows: DataFrame, members: DataFrame, layouts: dict, number: np.dtype, seed: int) -> DataFrame:
    """Classes with their size and nearest corners, and how many of them a task has of each code (see ``_placed``)."""
    with _shuffles_cleaned(rows.sparkSession):
        # A vector that stands in one row needs no shuffle to become a class.
        several = stored(members.filter("n > 1").select("c", "h"), "vector-several")
        alone = rows.join(several, ["c", "h"], "left_anti").select("c", F.lit(1).cast("long").alias("size"), "v")
        merged = rows.join(several, ["c", "h"], "left_semi").groupBy("c", "h").agg(F.first("v").alias("v")).join(members, ["c", "h"])
        whole = alone.unionByName(merged.select("c", "size", "v"))
        return stored(whole.mapInArrow(_placed(layouts, number, seed), "c long, size long, width int, packed binary, code long, n long"), "vector-classes", **PLAIN)


def _found(placed: DataFrame, layouts: dict, number: np.dtype, cosine: float) -> DataFrame:
    """Rows (c, links, to) of classes that have links: their number, counted in parts, and a spanning set."""
    spark = placed.sparkSession
    with _shuffles_cleaned(spark):
        classes = placed.filter("c IS NOT NULL").select("c", "size", "width", "packed")
        crowd = placed.filter("code IS NOT NULL").groupBy("code").agg(F.sum("n").alias("n")).filter("n > 1").toArrow()
        code, n = (crowd[k].to_numpy() for k in ("code", "n"))
        order = np.argsort(code)
        code, n = code[order], n[order]
        width = code >> 32
        blocks = -(-n // np.clip(BLOCK_NUMBERS // np.maximum(width, 1), LEAST_BLOCK, BLOCK))
        held = classes.agg(F.sum(F.length("packed"))).first()[0] or 0
        near = np.array([layouts.get(w, (0, 1))[1] for w in width.tolist()], dtype=np.int64)
        sent = int((n * blocks * (HEAD.itemsize + 4 * near + width * number.itemsize)).sum())
        rounds = max(1, math.ceil(sent / max(LEAST_ROUND, COPIES * held)))
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Several groups for a task, so that a task's share is even.
        tasks = max(least, sent // rounds // (4 * GROUP_BYTES))
        groups = 4 * tasks
        shipped = spark.sparkContext.broadcast((code, blocks))
        out = []
        for k in range(rounds):
            copies = classes.mapInArrow(_dealt(layouts, number, shipped, rounds, k, groups), "p int, length int, copies binary")
            dealt = copies.repartition(*([tasks] if tasks > least else []), "p").sortWithinPartitions("p")
            out.append(stored(dealt.mapInArrow(_compare_cells(cosine, layouts, number), "c long, links long, to long"), "vector-links"))
        shipped.destroy()
    return reduce(DataFrame.unionByName, out)


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Tables that are written meanwhile leave no shuffle files behind."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def unit_rows(flat: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe for very large and very small components."""
    scaled = flat / np.abs(flat).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of list: which rows, and their numbers as a matrix."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for width in np.unique(lengths):
        at = np.flatnonzero(lengths == width)
        yield at, flat[begins[at][:, None] + np.arange(width)]


def _packed(number: np.dtype):
    """Components as bytes, minus zero as zero; null for a row that links with nothing."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, parts = np.zeros(batch.num_rows, dtype=np.int64), []
            for at, matrix in _matrices(batch["v"]):
                matrix = np.ascontiguousarray(matrix, dtype=number) + number.type(0)
                good = np.isfinite(matrix).all(axis=1) & matrix.any(axis=1)
                good &= batch["vec_id"].is_valid().to_numpy(zero_copy_only=False)[at]
                at, matrix = at[good], matrix[good]
                if len(at):
                    lengths[at] = matrix.shape[1] * number.itemsize
                    parts.append((at, matrix.view(np.uint8)))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            data = np.empty(ends[-1], dtype=np.uint8)
            for at, part in parts:
                if len(at) == len(lengths):
                    data = part.ravel()
                else:
                    data[ends[at][:, None] + np.arange(part.shape[1])] = part
            yield pa.RecordBatch.from_arrays([batch["vec_id"], _binary(data, ends, np.packbits(lengths > 0, bitorder="little"))], ["vec_id", "v"])

    return work


def _binary(data: np.ndarray, ends: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    buffers = [None if valid is None else pa.py_buffer(valid), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def _bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without nulls, and where its values begin and end in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    return np.frombuffer(data, dtype=np.uint8), ends[column.offset : column.offset + len(column) + 1].astype(np.int64)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of a binary column without nulls: which rows, and their bytes as a matrix."""
    data, ends = _bytes(column)
    lengths = np.diff(ends)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        yield at, data[ends[0] : ends[-1]].reshape(-1, length) if len(at) == len(lengths) else data[ends[at][:, None] + np.arange(length)]


def _placed(layouts: dict, number: np.dtype, seed: int):
    """Nearest corners of each vector, in order, in front of its bytes; at a task's end, how many it has of each code, which is width and corner."""
    names = ["c", "size", "width", "packed", "code", "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines: dict[int, CrossPolytope] = {}
        codes, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]

        def summed() -> tuple[np.ndarray, np.ndarray]:
            known, where = np.unique(np.concatenate(codes), return_inverse=True)
            return known, np.bincount(where, weights=np.concatenate(counts), minlength=len(known)).astype(np.int64)

        for table in _gathered(batches, "v", GATHER_BYTES // 4):
            for at, raw in _by_length(table["v"]):
                width = raw.shape[1] // number.itemsize
                rotations, near = layouts.get(width, (0, 1))
                corners = np.zeros((len(at), 1), dtype=np.int32)
                if rotations:
                    machine = machines.get(width) or machines.setdefault(width, CrossPolytope(width, 1, rotations, seed=seed))
                    unit = unit_rows(np.ascontiguousarray(raw).view(number).astype(np.float64))
                    corners = np.sort(machine.nearest(unit.astype(np.float32), near), axis=1)
                found, n = np.unique(corners, return_counts=True)
                codes.append(found + (np.int64(width) << 32))
                counts.append(n)
                packed = np.concatenate([corners.view(np.uint8), raw], axis=1)
                packed = _binary(packed.ravel(), np.arange(len(at) + 1) * packed.shape[1])
                c, size, none = *(pa.array(table[k].to_numpy()[at]) for k in ("c", "size")), pa.nulls(len(at), pa.int64())
                yield pa.RecordBatch.from_arrays([c, size, pa.array(np.full(len(at), width, dtype=np.int32)), packed, none, none], names)
            if len(codes) > 64:
                codes, counts = ([x] for x in summed())
        known, n = summed()
        none = pa.nulls(len(known), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none.cast(pa.int32()), pa.nulls(len(known), pa.binary()), pa.array(known), pa.array(n)], names)

    return work


def _gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Rows of several batches at a time, until ``column`` has about so many bytes."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch[column].nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _dealt(layouts: dict, number: np.dtype, shipped, rounds: int, k: int, groups: int):
    """Copies of vectors for the regions of a round, several in a row, by the group that their cell belongs to.

    Each pair of a region's blocks is a cell; a vector goes to all cells of its block.
    """

    def copies(c: np.ndarray, size: np.ndarray, packed: np.ndarray, row: np.ndarray, code: np.ndarray, blocks: np.ndarray) -> pa.RecordBatch | None:
        block = (mixed(c[row].view(np.uint64) ^ mixed(code.view(np.uint64))) % blocks.astype(np.uint64)).astype(np.int32)
        whose = np.repeat(np.arange(len(row)), blocks)
        other = np.arange(len(whose)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        head = np.zeros(len(whose), dtype=HEAD)
        row, head["code"], head["block"] = row[whose], code[whose], block[whose]
        head["i"], head["j"] = np.minimum(head["block"], other), np.maximum(head["block"], other)
        head["c"], head["size"] = c[row], size[row]
        # The cells of a region of several blocks are worked off in all rounds.
        mine = (head["code"] + head["i"] + head["j"]) % rounds == k
        if not mine.any():
            return None
        row, head = row[mine], head[mine]
        cell = mixed(head["code"].view(np.uint64)) ^ (head["i"].astype(np.uint64) << np.uint64(32)) ^ head["j"].astype(np.uint64)
        p = (mixed(cell) % np.uint64(groups)).astype(np.int32)
        order = np.argsort(p, kind="stable")
        p, length = p[order], HEAD.itemsize + packed.shape[1]
        whole = np.empty((len(p), length), dtype=np.uint8)
        whole[:, : HEAD.itemsize] = head.view(np.uint8).reshape(len(p), -1)[order]
        whole[:, HEAD.itemsize :] = packed[row[order]]
        edges = np.concatenate([[0], np.flatnonzero(p[1:] != p[:-1]) + 1, [len(p)]])
        most = max(1, ROW_BYTES // length)
        parts = -(-np.diff(edges) // most)
        begins = np.repeat(edges[:-1], parts) + most * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        rows = _binary(whole.ravel(), np.append(begins, len(p)) * length)
        return pa.RecordBatch.from_arrays([pa.array(p[begins]), pa.array(np.full(len(begins), length, dtype=np.int32)), rows], ["p", "length", "copies"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded, blocks = shipped.value
        if not len(crowded):
            return
        for table in _gathered(batches, "packed", GATHER_BYTES // 4):
            c, size, widths = (table[x].to_numpy() for x in ("c", "size", "width"))
            for rows, matrix in _by_length(table["packed"]):
                for width in np.unique(widths[rows]).tolist():
                    of = np.flatnonzero(widths[rows] == width)
                    at, packed = rows[of], matrix if len(of) == len(rows) else matrix[of]
                    corners = np.ascontiguousarray(packed[:, : 4 * layouts.get(width, (0, 1))[1]]).view(np.int32)
                    code = corners + (np.int64(width) << 32)
                    where = np.minimum(np.searchsorted(crowded, code), len(crowded) - 1)
                    row, col = np.nonzero((crowded[where] == code) & ((blocks[where] > 1) | (code % rounds == k)))
                    if not len(row):
                        continue
                    code, n = code[row, col], blocks[where[row, col]]
                    ends = np.cumsum(n) * (HEAD.itemsize + packed.shape[1])
                    cuts = np.searchsorted(ends, np.arange(1, ends[-1] // GATHER_BYTES + 1) * GATHER_BYTES, side="right")
                    for x, y in itertools.pairwise(np.unique([0, *cuts.tolist(), len(row)]).tolist()):
                        out = copies(c[at], size[at], packed, row[x:y], code[x:y], n[x:y])
                        if out is not None:
                            yield out

    return work


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Add links to ``root``, which names for each node one of its component and for that one itself."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        root[np.maximum(x, y)] = np.minimum(x, y)
        while (root != (above := root[root])).any():
            root[:] = above


def _shared_before(corners: np.ndarray, a: np.ndarray, b: np.ndarray, corner: int) -> np.ndarray:
    """Whether vectors ``a`` and ``b`` share one of their corners, which are in order, before ``corner``."""
    out, left = np.zeros(len(a), dtype=bool), np.arange(len(a))
    for p in range(corners.shape[1]):
        one = corners[a[left], p]
        before = one < corner
        left, one = left[before], one[before]
        if not len(left):
            break
        same = (corners[b[left]] == one[:, None]).any(axis=1)
        out[left[same]] = True
        left = left[~same]
    return out


def _linked(unit: np.ndarray, cosine: float, lefts: np.ndarray, rights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ``lefts`` and ``rights`` with at least the cosine, tile by tile; each pair once if both are the same.

    Products are of single precision; those within their error of the cosine are worked out again.
    """
    once = lefts is rights
    single = unit.astype(np.float32)
    left = single if len(lefts) == len(unit) else single[lefts]
    right = left if once else single[rights]
    slack = (unit.shape[1] + 16) * 1.2e-7
    low, high = np.float32(cosine - slack), np.float32(cosine + slack)
    for i in range(0, len(lefts), TILE[0]):
        for j in range(i if once else 0, len(rights), TILE[1]):
            products = left[i : i + TILE[0]] @ right[j : j + TILE[1]].T
            # Where a tile begins at the diagonal, its vectors meet themselves.
            if once and j == i:
                np.fill_diagonal(products, -2)
            # Few rows have a hit, and looking for hits costs more than the largest product of each row.
            some = np.flatnonzero(products.max(axis=1) >= low)
            if not len(some):
                continue
            products = products[some] if len(some) < len(products) else products
            p, q = np.divmod(np.flatnonzero(products.ravel() >= low), products.shape[1])
            unsure = np.flatnonzero(products[p, q] < high)
            p, q = some[p] + i, q + j
            good = p < q if once else np.ones(len(p), dtype=bool)
            a, b = lefts[p], rights[q]
            step = max(1, (1 << 20) // unit.shape[1])
            for k in range(0, len(unsure), step):
                at = unsure[k : k + step]
                good[at] &= (unit[a[at]] * unit[b[at]]).sum(axis=1) >= cosine
            yield a[good], b[good]


def _compare_cells(cosine: float, layouts: dict, number: np.dtype):
    def links(c: np.ndarray, size: np.ndarray, block: np.ndarray, corners: np.ndarray, unit: np.ndarray, corner: int, i: int, j: int):
        lefts = np.flatnonzero(block == i)
        n, root = np.zeros(len(c)), np.arange(len(c))
        for a, b in _linked(unit, cosine, lefts, lefts if i == j else np.flatnonzero(block == j)):
            # A pair counts in the first region that it shares.
            here = ~_shared_before(corners, a, b, corner)
            a, b = a[here], b[here]
            n += np.bincount(a, weights=size[b], minlength=len(c)) + np.bincount(b, weights=size[a], minlength=len(c))
            _joined(root, a, b)
        some = np.flatnonzero(n)
        return c[some], n[some].astype(np.int64), c[root[some]], root[some] == some

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in whole_groups(batches, ["p"]):
            data, ends = _bytes(table["copies"])
            lengths, found = table["length"].to_numpy(), []
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                whole = data[ends[0] : ends[-1]] if len(at) == len(lengths) else np.concatenate([data[ends[r] : ends[r + 1]] for r in at.tolist()])
                whole = whole.reshape(-1, length)
                head = np.ascontiguousarray(whole[:, : HEAD.itemsize]).view(HEAD).ravel()
                order = np.lexsort((head["j"], head["i"], head["code"]))
                head, whole = head[order], whole[order, HEAD.itemsize :]
                code, i, j, c, size, block = (np.ascontiguousarray(head[x]) for x in ("code", "i", "j", "c", "size", "block"))
                edges = np.flatnonzero((code[1:] != code[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
                for x, y in itertools.pairwise([0, *edges.tolist(), len(code)]):
                    if y - x > 1:
                        near = layouts.get(int(code[x]) >> 32, (0, 1))[1]
                        corners = np.ascontiguousarray(whole[x:y, : 4 * near]).view(np.int32)
                        unit = unit_rows(np.ascontiguousarray(whole[x:y, 4 * near :]).view(number).astype(np.float64))
                        found.append(links(c[x:y], size[x:y], block[x:y], corners, unit, int(code[x]) & 0xFFFFFFFF, int(i[x]), int(j[x])))
            if found:
                c, n, to, own = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(n), pa.array(to, mask=own)], ["c", "links", "to"])

    return work
