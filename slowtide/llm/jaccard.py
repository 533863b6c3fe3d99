"""N-gram Jaccard join over a count-vector R-tree.

A document's word shingles are hashed into groups, and the counts per group are a point. Two sets
share at most the sum, over the coordinates, of the smaller count, which bounds their overlap.

Upper level of the tree, as join keys. In any one order of all shingles, sets above the threshold
share some of their first shingles: s of them among as many as a linked set may miss and s more. A
cell holds the documents with one such shingle; a linked pair has s cells in common, so a set that
shares fewer cells with others links with none. The order is
that of the hashes, but shingles that are frequent where they are read come last, so cells stay
small; which ones count as frequent changes the cost, not the links. Of the cells that a set has left,
it leaves the first s - 1 in an order that puts crowded ones first: of the s common cells of a linked
pair, neither leaves the last one in that order. Cells are cut by size of set, and cells with the same
members are one.

Lower levels, in tasks. The points of a cell are packed into a tree of tiles with the largest count
per coordinate; pairs of tiles whose summed minima cannot reach the overlap are dropped whole, and
the pairs of points that are left are verified on their shingle sets.

Components need no links that only repeat what is known: first each document meets its neighbours in
its cells, then only pairs of different components meet within a cell, in the first cell they share.
Links lie within components, so all links of a document are then counted there: every pair of different
sets of a component meets once, in tasks that get a pair of blocks of its sets and send counts on.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.llm.common import BitFilter, Shipped, batches_of, bit_filter, stored, text_slices, whole_groups
from slowtide.llm.components import components
from slowtide.llm.words import Hasher

SHINGLE_WORDS, NUMERATOR, DENOMINATOR = 5, 80, 100
#: Coordinates of a point: from half the set's size to all of it, a power of two between these. In fewer, what differs between near sets cancels out.
LEAST_GROUPS, GROUPS = 16, 1024
FILTER_BITS = 25
#: Points of a cell that meet in a task at a time, and entries of a tile.
BLOCK, FANOUT = 512, 16
#: Sets, and shingles on average, of a block of a component, and columns of shared shingles counted at a time.
PART_SETS, PART_SHINGLES, COLUMNS = 256, 1 << 19, 4096
#: Cells of sets that a task hands on at a time.
CELLS_AT_A_TIME = 1 << 16
#: Documents that a task gets at a time.
BATCH_ROWS = 2000
#: Documents of one task that make a shingle frequent.
FREQUENT = 4
#: Sets that make a cell crowded.
CROWDED = 8


class Threshold:
    """What a threshold ``num / den`` asks of sets of given sizes."""

    def __init__(self, num: int, den: int) -> None:
        if not 0 < num <= den:
            raise ValueError("the threshold lies above 0 and at most at 1")
        self.num, self.den = num, den

    def kept(self, n: int) -> int:
        """Shingles of a set of ``n`` that any linked one has at least; its size is no smaller either."""
        return -(-n * self.num // self.den)

    def shared(self, n: int) -> int:
        """Cells that a set of ``n`` has in common with a linked one that is no smaller, at least; grows with ``n``."""
        return min(1 + (n - self.kept(n)) // 4, self.kept(n))

    def cells(self, shingles: np.ndarray, frequent: BitFilter) -> np.ndarray:
        """Cells of one set, given as ascending distinct hashes: its first shingles, frequent ones last."""
        n = len(shingles)
        most = n - self.kept(n) + self.shared(n)
        late = frequent.has(shingles)
        return np.concatenate([shingles[~late], shingles[late]])[:most] if late.any() else shingles[:most]

    def stayed(self, n: int, own: np.ndarray, crowded: BitFilter) -> np.ndarray:
        """Of a set's cells that others have too, those it needs to meet every linked set in one; none if they are too few to link.

        It leaves as many as any linked pair has in common less one, the first in one order of all cells.
        """
        least = self.shared(self.kept(n))
        if len(own) < least:
            return own[:0]
        own = np.sort(own)
        first = crowded.has(own)
        return np.concatenate([own[first], own[~first]])[least - 1 :]

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)

    def least_overlap(self, sizes: np.ndarray) -> np.ndarray:
        """Smallest overlap that links sets of the given summed size."""
        return -(-sizes * self.num // (self.num + self.den))


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each text its row and its distinct shingles' hashes, ascending; fewer words make one shingle, none an empty set."""
    hasher = Hasher(lower=True)
    for first, flat, ends in text_slices(column):
        hashes, _, _, bounds = hasher.words(flat, ends)
        runs = hasher.runs(hashes)
        every = runs.at(np.arange(max(0, len(hashes) - words + 1)), words)
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if b - a >= words:
                yield first + k, np.unique(every[a : b - words + 1])
            else:
                yield first + k, runs.at(np.array([a]), b - a) if b > a else np.zeros(0, dtype=np.uint64)


def set_key(shingles: np.ndarray) -> int | None:
    """64-bit name of a set; sets are taken as equal if their names are."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True) if len(shingles) else None


class Tree:
    """Points packed bottom-up into tiles of ``FANOUT``; each level holds largest counts and smallest sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        # Packed by size, then by where the points are heaviest.
        heavy = points.reshape(len(points), -1, 16).sum(axis=2) if points.shape[1] % 16 == 0 else points
        self.order = np.lexsort((*heavy.T[:4], sizes))
        self.levels = [(points[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > 1:
            p, s = self.levels[-1]
            at = np.arange(0, len(p), FANOUT)
            self.levels.append((np.maximum.reduceat(p, at, axis=0), np.minimum.reduceat(s, at)))


def tree_join(a: Tree, b: Tree, threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points, as positions in what the trees were made of, whose summed minima reach the least overlap."""
    depth = max(len(a.levels), len(b.levels))
    x, y = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    for level in reversed(range(depth)):
        (pa_, sa), (pb, sb) = a.levels[min(level, len(a.levels) - 1)], b.levels[min(level, len(b.levels) - 1)]
        keep = np.zeros(len(x), dtype=bool)
        for at in range(0, len(x), 4096):
            i, j = x[at : at + 4096], y[at : at + 4096]
            reach = np.minimum(pa_[i], pb[j]).sum(axis=1, dtype=np.int64)
            keep[at : at + 4096] = reach >= threshold.least_overlap(sa[i] + sb[j])
        x, y = x[keep], y[keep]
        if level:
            x, y = _children(x, y, a, b, level)
    return a.order[x], b.order[y]


def _children(x: np.ndarray, y: np.ndarray, a: Tree, b: Tree, level: int) -> tuple[np.ndarray, np.ndarray]:
    for tree, mine in ((a, True), (b, False)):
        if level < len(tree.levels):
            own = x if mine else y
            n = np.minimum(FANOUT, len(tree.levels[level - 1][0]) - own * FANOUT)
            steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            child = np.repeat(own * FANOUT, n) + steps
            x, y = (child, np.repeat(y, n)) if mine else (np.repeat(x, n), child)
    return x, y


def jaccard_components(
    docs: DataFrame,
    num: int = NUMERATOR,
    den: int = DENOMINATOR,
    words: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each row of ``docs``.

    A set holds the distinct shingles of ``words`` words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; fewer
    words make one shingle. Two documents link when den * intersection >= num * union; component_id is
    the smallest doc_id that links reach, its own included. Null texts and texts without words have
    an empty set and link with nothing. A row without id links others, but names no component:
    component_id is null where no member has an id. Repeated rows and ids are allowed, other columns are
    ignored, an empty table gives no rows.

    Equal sets are one candidate, so copies cost one row each. The driver sees counts and a filter of
    fixed size that tells which cells may hold two sets; a crowded filter lets more rows pass.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _named(*_graph(source, Threshold(num, den), words, filter_bits)).drop("key")


def jaccard_join(
    docs: DataFrame,
    num: int = NUMERATOR,
    den: int = DENOMINATOR,
    words: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, n_links): those of ``jaccard_components``, and the number of links.

    ``n_links`` counts the other documents whose set links with the row's, equal sets among them. Rows of
    equal id and set are one document; each row without id is one of its own. Empty sets have no links.

    All links are verified on the shingles, each pair of different sets of a component once. A pair of
    blocks meets in a task, so a set travels once for each block of its component: rows moved and pairs
    compared grow with the square of a component's different sets. Of two sets the link is known.
    """
    threshold = Threshold(num, den)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    points, graph = _graph(source, threshold, words, filter_bits)
    graph = stored(graph, "jaccard-graph")
    own = points.filter("key IS NOT NULL")
    size = (F.countDistinct("doc_id") + F.count_if(F.col("doc_id").isNull())).alias("size")
    sizes = stored(own.groupBy("key").agg(size, F.first("n_shingles").alias("n_shingles")), "jaccard-sizes")
    counts = _link_counts(sizes, graph, source, words, threshold, filter_bits)
    links = sizes.join(counts, "key", "left").select("key", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return _named(points, graph).join(links, "key", "left").select(
        "doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def _graph(source: DataFrame, threshold: Threshold, words: int, filter_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, key, …) of the documents, and rows (node, root) of the set keys that link with others."""
    with batches_of(source.sparkSession, BATCH_ROWS):
        return _find_graph(source, threshold, words, filter_bits)


def _find_graph(source: DataFrame, threshold: Threshold, words: int, filter_bits: int) -> tuple[DataFrame, DataFrame]:
    spark = source.sparkSession
    often = bit_filter(source.select("text").mapInArrow(_frequent(words), "h long").distinct(), "h", filter_bits)
    frequent = Shipped(spark, often)
    # Dealt by cell first: most cells stand in one set, so a table of cells before the exchange would grow with a task's documents and save few rows.
    seen = source.select("text").mapInArrow(_cell_keys(threshold, words, frequent), "cell long, least long, most long, n long").repartition("cell")
    cells = stored(seen.groupBy("cell").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n")).filter("least < most"), "jaccard-cells")
    told = Shipped(spark, bit_filter(cells, "cell", filter_bits))
    crowded = Shipped(spark, bit_filter(cells.filter(F.col("n") >= CROWDED), "cell", filter_bits))
    schema = "doc_id long, n_shingles long, key long, cells array<long>, point binary"
    points = stored(source.mapInArrow(_points(threshold, words, frequent, told, crowded), schema), "jaccard-points")
    sets = stored(points.filter("point IS NOT NULL").select("key", "n_shingles", "cells", "point").dropDuplicates(["key"]), "jaccard-sets")
    members = stored(_meetings(sets.select("key", "n_shingles", F.explode("cells").alias("cell")).join(cells, "cell", "left_semi"), threshold), "jaccard-members")

    facts = sets.select("key", "n_shingles", "point")
    # First neighbours only, in an order that differs from cell to cell: few pairs, which join most of a large group.
    sized = members.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sized, "cell").select("cell", "key", F.pmod(F.xxhash64("key", "cell"), "blocks").cast("int").alias("block"), F.xxhash64("cell", "key").alias("turn"))
    ordered = dealt.join(facts, "key").repartition("cell", "block").sortWithinPartitions("cell", "block", "turn")
    links = stored(_verified(ordered.mapInArrow(_neighbours(threshold), "a long, b long").distinct(), source, words, threshold, filter_bits), "jaccard-links")
    graph = components(links)
    # Then all pairs of a cell whose documents are not joined yet.
    known = facts.join(graph, F.col("key") == F.col("node"), "left").select("key", F.coalesce("root", "key").alias("part"), "n_shingles", "point")
    placed = members.join(known.select("key", "part"), "key")
    mixed_cells = placed.groupBy("cell").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n")).filter("low < high")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mixed = stored(placed.join(mixed_cells, "cell").select("cell", "key", blocks.alias("blocks")), "jaccard-mixed")
    known = known.join(mixed.groupBy("key").agg(F.collect_list("cell").alias("cells")), "key")
    dealt = mixed.select("cell", "key", "blocks", F.pmod(F.xxhash64("key", "cell"), "blocks").cast("int").alias("block"))
    spread = dealt.select("cell", "key", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key"
    )
    ordered = spread.join(known, "key").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    more = _verified(ordered.mapInArrow(_candidates(threshold), "a long, b long"), source, words, threshold, filter_bits)
    return points, components(links.unionByName(more))


def _named(points: DataFrame, graph: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, key) of all documents."""
    roots = points.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    roots = roots.join(graph, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    named = roots.join(roots.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("key", "component_id")
    return points.select("doc_id", "n_shingles", "key").join(named, "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "key"
    )


def _link_counts(sizes: DataFrame, graph: DataFrame, source: DataFrame, words: int, threshold: Threshold, filter_bits: int) -> DataFrame:
    """Rows (key, links) for the set keys that link: documents of all other sets that they link with."""
    members = stored(graph.select(F.col("node").alias("key"), "root").join(sizes, "key"), "jaccard-classes")
    groups = members.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"), F.sum("size").alias("all"))
    pairs = members.join(groups.filter("n = 2"), "root").select("key", (F.col("all") - F.col("size")).alias("links"))
    blocks = F.ceil(F.greatest(F.col("n") / PART_SETS, F.col("shingles") / PART_SHINGLES)).cast("int")
    large = members.join(groups.filter("n > 2").select("root", blocks.alias("blocks")), "root")
    dealt = stored(large.select("root", "key", "size", "blocks", F.pmod(F.xxhash64("key", "root"), "blocks").cast("int").alias("block")), "jaccard-dealt")
    # Each pair of blocks is a cell; a set goes to all cells of its block.
    cells = dealt.select("root", "key", "size", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "size"
    )
    named = Shipped(source.sparkSession, bit_filter(dealt, "key", filter_bits))
    whole = source.select("text").mapInArrow(_sets(words, named), "key long, shingles binary").dropDuplicates(["key"])
    ordered = cells.join(whole, "key").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    counted = ordered.mapInArrow(_count_cells(threshold), "key long, links long").groupBy("key").agg(F.sum("links").alias("links"))
    return pairs.unionByName(counted)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set on the left has in common with each on the right."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    places = []
    for flat, sets in ((a, left), (b, right)):
        at = np.searchsorted(both, flat)
        at[at == len(both)] = 0
        found = both[at] == flat if len(both) else np.zeros(len(flat), dtype=bool)
        row, at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[found], at[found]
        order = np.argsort(at, kind="stable")
        places.append((row[order], at[order], len(sets)))
    for first in range(0, len(both), COLUMNS):
        width = min(COLUMNS, len(both) - first)
        ones = []
        for row, at, n in places:
            x, y = np.searchsorted(at, [first, first + width])
            one = np.zeros((n, width), dtype=np.float32)
            one[row[x:y], at[x:y] - first] = 1
            ones.append(one)
        out += (ones[0] @ ones[1].T).astype(np.int64)
    return out


def _count_cells(threshold: Threshold):
    """For the sets of a cell, the documents on the other side that they link with."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, ["root", "i", "j"]):
            i, j, block, key, size = (table[c].to_numpy() for c in ("i", "j", "block", "key", "size"))
            column = table["shingles"].combine_chunks()
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                sides = [np.flatnonzero(block[x:y] == n) + x for n in (i[x], j[x])]
                if not len(sides[0]) or not len(sides[1]):
                    continue
                sets = [[np.frombuffer(column[k].as_buffer(), np.uint64) for k in side.tolist()] for side in sides]
                both = overlaps(*sets)
                n, m = (np.array([len(s) for s in side], dtype=np.int64) for side in sets)
                linked = threshold.den * both >= threshold.num * (n[:, None] + m[None, :] - both)
                if i[x] == j[x]:
                    np.fill_diagonal(linked, False)
                links = [linked.astype(np.int64) @ size[sides[1]]]
                if i[x] != j[x]:
                    links.append(linked.T.astype(np.int64) @ size[sides[0]])
                keys, counts = np.concatenate([key[s] for s in sides[: len(links)]]), np.concatenate(links)
                yield pa.RecordBatch.from_arrays([pa.array(keys[counts > 0]), pa.array(counts[counts > 0])], ["key", "links"])

    return work


def _meetings(members: DataFrame, threshold: Threshold) -> DataFrame:
    """Rows (cell, key) of the meetings that a pair needs: cells cut by size, and one cell for all with the same members.

    Linked sets differ in size by less than the threshold's ratio, so they lie in one band of that
    width or in two that touch; a set stands in its own band's meeting and the next one's. A set
    alone in a meeting leaves, and of meetings with the same members one is enough.
    """
    width = max(math.log(threshold.den / threshold.num), 1e-6) * (1 + 1e-9)
    band = F.floor(F.log("n_shingles") / width)
    rows = members.select(F.explode(F.array(band, band + 1)).alias("band"), "cell", "key").select(F.xxhash64("cell", "band").alias("cell"), "key")
    named = rows.groupBy("cell").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"), F.sum(F.shiftright(F.xxhash64("key", F.lit(1)), 24)).alias("y")
    )
    one = named.filter("n > 1").groupBy("n", "x", "y").agg(F.min("cell").alias("cell"))
    return rows.join(one.select("cell"), "cell", "left_semi")


def _verified(pairs: DataFrame, source: DataFrame, words: int, threshold: Threshold, filter_bits: int) -> DataFrame:
    """Those of the pairs (a, b) of set keys that link, by the shingles of the documents that stand in them."""
    spark = source.sparkSession
    pairs = stored(pairs, "jaccard-pairs")
    named = Shipped(spark, bit_filter(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key", filter_bits))
    # Both joins read the one exchange by key.
    whole = source.select("text").mapInArrow(_sets(words, named), "key long, shingles binary").dropDuplicates(["key"])
    left = pairs.join(whole.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(whole.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [threshold.linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch["x"], batch["y"], strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(work, "a long, b long")


def _sets(words: int, named):
    """Shingles of the sets that the filter lets pass, each once in a batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: set[int] = set()
            keys, sets, size = [], [], 0
            for _, shingles in shingle_sets(batch["text"], words):
                key = set_key(shingles)
                if key is not None and key not in known and named.value.has(np.array([key]))[0]:
                    known.add(key)
                    keys.append(key)
                    sets.append(shingles.tobytes())
                    size += len(sets[-1])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "shingles"])
                    keys, sets, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "shingles"])

    return work


def _frequent(words: int):
    """Shingles that stand in ``FREQUENT`` documents of a task or more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many, counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def count() -> None:
            nonlocal many, counts, waiting, size
            h, n = np.unique(np.concatenate(waiting), return_counts=True)
            # Only what repeats within a portion is worth carrying on.
            h, n = h[n > 1], n[n > 1]
            both, at = np.unique(np.concatenate([many, h]), return_inverse=True)
            many, counts = both, np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(both)).astype(np.int64)
            waiting, size = [], 0

        for batch in batches:
            for _, shingles in shingle_sets(batch["text"], words):
                waiting.append(shingles)
                size += len(shingles)
                if size > 1 << 19:
                    count()
        if waiting:
            count()
        yield pa.RecordBatch.from_arrays([pa.array(many[counts >= FREQUENT].view(np.int64))], ["h"])

    return work


def _cell_keys(threshold: Threshold, words: int, frequent):
    """Cells of sets, each once in a portion: the least and the greatest key of its sets there, and their number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: set[int] = set()
            cells, keys, size = [], [], 0
            for _, shingles in shingle_sets(batch["text"], words):
                key = set_key(shingles)
                if key is not None and key not in known:
                    known.add(key)
                    own = threshold.cells(shingles, frequent.value)
                    cells.append(own.copy())
                    keys.append(key)
                    size += len(own)
                if size > CELLS_AT_A_TIME:
                    yield _cell_rows(cells, keys)
                    cells, keys, size = [], [], 0
            if cells:
                yield _cell_rows(cells, keys)
            pa.default_memory_pool().release_unused()

    return work


def _cell_rows(cells: list[np.ndarray], keys: list[int]) -> pa.RecordBatch:
    cell = np.concatenate(cells).view(np.int64)
    key = np.repeat(np.array(keys, dtype=np.int64), [len(c) for c in cells])
    order = np.argsort(cell, kind="stable")
    cell, key = cell[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    columns = [cell[first], np.minimum.reduceat(key, first), np.maximum.reduceat(key, first), np.diff(first, append=len(cell))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "least", "most", "n"])


def _points(threshold: Threshold, words: int, frequent, told, crowded):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "key", "cells", "point"]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            known: set[int] = set()
            rows: list[tuple] = []
            begin = 0

            def flush(end: int) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([batch["doc_id"].slice(begin, end - begin), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names)

            size = 0
            for k, shingles in shingle_sets(batch["text"], words):
                if size > 8 << 20:
                    yield flush(k)
                    rows, begin, size = [], k, 0
                key = set_key(shingles)
                row = (len(shingles), key, None, None)
                if key is not None and key not in known:
                    known.add(key)
                    own = threshold.cells(shingles, frequent.value)
                    own = threshold.stayed(len(shingles), own[told.value.has(own)], crowded.value)
                    if len(own):
                        row = (len(shingles), key, own.view(np.int64), point_bytes(group_counts(shingles)))
                        size += 8 * len(own) + len(row[3])
                rows.append(row)
            yield flush(batch.num_rows)

    return work


def group_counts(shingles: np.ndarray) -> np.ndarray:
    """A set's point; small sets are counted in fewer groups, unless a count then needs more than a byte."""
    few = min(GROUPS, max(LEAST_GROUPS, 1 << (max(1, -(-len(shingles) // 2)) - 1).bit_length()))
    for width in (few, GROUPS):
        counts = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width)
        if counts.max() < 256:
            break
    return counts


def point_bytes(counts: np.ndarray) -> bytes:
    """A point's counts, a byte each where they all fit in one and four bytes each otherwise."""
    return counts.astype("u1" if counts.max() < 256 else "<u4").tobytes()


def point_counts(points: list[bytes], width: int | None = None) -> np.ndarray:
    """One row of counts per point, all in ``width`` or in the fewest groups that any of them has: a group's number modulo theirs."""
    width = width or min(min(len(p) for p in points), GROUPS)
    out = np.empty((len(points), width), dtype=np.uint32)
    for k, p in enumerate(points):
        counts = np.frombuffer(p, "u1" if len(p) <= GROUPS else "<u4")
        out[k] = counts if len(counts) == width else counts.reshape(-1, width).sum(axis=0, dtype=np.uint32)
    return out


def summed_minima(points: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bound of the overlap for pairs of points, each pair in the fewer groups of its two."""
    width = np.array([min(len(p), GROUPS) for p in points])
    least = np.minimum(width[a], width[b])
    out = np.zeros(len(a), dtype=np.int64)
    for w in np.unique(least).tolist():
        at = np.flatnonzero(least == w)
        for part in np.array_split(at, len(at) // 4096 + 1):
            x, y = (point_counts([points[k] for k in side[part].tolist()], w) for side in (a, b))
            out[part] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
    return out


def _neighbours(threshold: Threshold):
    """Pairs of neighbours in a block of a cell whose summed minima reach the least overlap."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, ["cell", "block"]):
            key, size = table["key"].to_numpy(), table["n_shingles"].to_numpy()
            inner = np.ones(len(key), dtype=bool)
            inner[edges[:-1]] = False
            at = np.flatnonzero(inner)
            if not len(at):
                continue
            reach = summed_minima(table["point"].to_pylist(), at, at - 1)
            at = at[reach >= threshold.least_overlap(size[at] + size[at - 1])]
            pairs = np.unique(np.stack([np.maximum(key[at], key[at - 1]), np.minimum(key[at], key[at - 1])], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return work


def _candidates(threshold: Threshold):
    """Pairs of different parts in a cell, from its tiles; each pair in the smallest of the cells that both have."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, ["cell", "i", "j"]):
            cell, i, j, block, key, part, size = (table[c].to_numpy() for c in ("cell", "i", "j", "block", "key", "part", "n_shingles"))
            counts, cells = table["point"].combine_chunks(), table["cells"].combine_chunks()
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if y - x < 2 or (part[x:y] == part[x]).all():
                    continue
                points = point_counts(counts.slice(x, y - x).to_pylist())
                left, right = np.flatnonzero(block[x:y] == i[x]), np.flatnonzero(block[x:y] == j[x])
                if not len(left) or not len(right):
                    continue
                a, b = tree_join(Tree(points[left], size[x:y][left]), Tree(points[right], size[x:y][right]), threshold)
                a, b = left[a] + x, right[b] + x
                keep = part[a] != part[b]
                if i[x] == j[x]:
                    keep &= a < b
                a, b = a[keep], b[keep]
                own = {k: cells[k].values.to_numpy() for k in np.unique(np.concatenate([a, b])).tolist()}
                first = np.array([np.intersect1d(own[p], own[q]).min() == cell[x] for p, q in zip(a.tolist(), b.tolist(), strict=True)], dtype=bool)
                yield pa.RecordBatch.from_arrays([pa.array(key[a[first]]), pa.array(key[b[first]])], ["a", "b"])

    return work
