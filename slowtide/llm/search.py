"""Ranked search term at a time, with a limited set of accumulators.

An item's terms are taken rarest first, in phases whose work grows fourfold, and every document that
holds one gets an accumulator of its partial score. Once the terms still to come cannot lift a new
document to the item's kth partial score, no accumulator is added; those there are updated with all
terms that remain, so that their scores are exact, and leave when the remaining bounds cannot lift
them to that score either.

Documents are read once, into rows of their length and their occurrences of the items' terms. A phase
is a narrow pass over those rows: accumulators belong to one document each, so they never move, and a
task hands on its k best per item alone. What phases learn from each other (kth partial score, end of
adding) is one number per item. Items are searched in blocks of bounded size, each of which makes its
own pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slowtide.llm.common import stored, text_slices
from slowtide.llm.periodic import split_words

#: Pairs of item and term that are searched at once; an item with more makes a block of its own size.
BLOCK_PAIRS = 1 << 18
#: Accumulators that a task holds at a time.
CELLS = 1 << 18
#: Shares of all updates after which a phase ends.
PHASES = (1 / 64, 1 / 16, 1 / 4, 1.0)

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[65:91] += 32
_LETTERS[[b for b in range(128) if not chr(b).isalnum()]] = 32


def split_terms(texts: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """First row, terms and ends of slices of texts: ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased."""
    for first, flat, ends in text_slices(texts):
        plain = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(_LETTERS[flat])])
        yield first, *split_words(plain)


class Weights(NamedTuple):
    """What a block's tasks need: numbers of the whole corpus, and pairs sorted by term."""

    documents: int
    length: int
    pair_item: np.ndarray
    pair_weight: np.ndarray
    term_first: np.ndarray  # where a term's pairs begin
    term_phase: np.ndarray
    rest: np.ndarray  # by phase and item, the most that later phases can add

    def dampened(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Occurrences of a term in documents of ``n`` terms as saturating numbers below 10^6."""
        wide = object if 90 * int(n.max(initial=0)) * self.documents >= 1 << 63 else np.int64
        m = 10 + (90 * n.astype(wide) * self.documents // self.length).astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Best:
    """The k best documents of each item: highest score first, then smallest id, missing ids last."""

    def __init__(self, items: int, k: int) -> None:
        self._k, self._rows = k, [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        self.floor = np.ones(items, dtype=np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        new = score >= self.floor[item]
        rows = [np.concatenate([a, b[new]]) for a, b in zip(self._rows, (item, score, doc, known), strict=True)]
        order = np.lexsort((rows[2], ~rows[3], -rows[1], rows[0]))
        rows = [r[order] for r in rows]
        begin = np.searchsorted(rows[0], rows[0])
        place = np.arange(len(begin)) - begin
        self._rows = [r[place < self._k] for r in rows]
        full = place == self._k - 1
        self.floor[rows[0][full]] = rows[1][full]

    def rows(self) -> list[np.ndarray]:
        return self._rows


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows that stand for ``count`` places from ``first`` on: the row and the place of each."""
    row = np.repeat(np.arange(len(first)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)


def accumulate(weights: Weights, phases: int, stop: np.ndarray, floor: np.ndarray, doc: np.ndarray, term: np.ndarray, part: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, score) of the accumulators after the first ``phases`` phases.

    ``doc``, ``term``, ``part`` are the documents' postings. Item i adds accumulators up to phase stop[i];
    one that the remaining bounds cannot lift to floor[i] leaves.
    """
    items = len(stop)
    score = np.zeros(docs * items, dtype=np.int64)
    there = np.zeros(docs * items, dtype=bool)
    phase_of = weights.term_phase[term]
    for phase in range(phases):
        own = np.flatnonzero(phase_of == phase)
        begin = weights.term_first[term[own]]
        row, pair = _expand(begin, weights.term_first[term[own] + 1] - begin)
        item = weights.pair_item[pair]
        cell = doc[own][row] * items + item
        adds = stop[item] >= phase
        use = adds | there[cell]
        there[cell[adds]] = True
        np.add.at(score, cell[use], weights.pair_weight[pair[use]] * part[own][row[use]])
        if phase + 1 < len(weights.rest):
            there &= (score.reshape(docs, items) + weights.rest[phase] >= floor).ravel()
    cell = np.flatnonzero(there)
    return cell // items, cell % items, score[cell]


def _index(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """One row per document that has terms: id, number of terms, and its occurrences of the vocabulary's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for first, words, ends in split_terms(batch.column(1)):
                n = np.diff(ends)
                term = pc.index_in(words, known)
                hit = term.is_valid()
                keys = np.repeat(np.arange(len(n)), n)[hit.to_numpy(zero_copy_only=False)] * len(known) + term.filter(hit).to_numpy()
                keys, tf = np.unique(keys, return_counts=True)
                offsets = pa.array(np.searchsorted(keys, np.arange(len(n) + 1) * len(known)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (keys % max(len(known), 1), tf)]
                rows = pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(n)), pa.array(n.astype(np.int64)), *lists], names=["doc_id", "n", "terms", "tfs"])
                yield rows.filter(pa.array(n > 0))

    return docs.mapInArrow(work, "doc_id long, n long, terms array<int>, tfs array<int>")


def _pass(index: DataFrame, weights: Weights, names: pa.Array, phases: int, stop: np.ndarray, floor: np.ndarray, k: int) -> DataFrame:
    """The k best of each item and task after the first ``phases`` phases."""
    shared = index.sparkSession.sparkContext.broadcast((tuple(weights), names, stop, floor))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, names, stop, floor = shared.value
        weights = Weights(*numbers)
        best = Best(len(stop), k)
        step = max(1, CELLS // len(stop))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = part.column(0)
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                doc_id = ids.fill_null(0).to_numpy()
                size = pc.list_value_length(part.column(2)).to_numpy()
                doc = np.repeat(np.arange(part.num_rows), size)
                term, tf = (part.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                damp = weights.dampened(tf, part.column(1).to_numpy()[doc])
                row, item, score = accumulate(weights, phases, stop, np.maximum(floor, best.floor), doc, term, damp, part.num_rows)
                best.add(item, score, doc_id[row], known[row])
        item, score, doc, known = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), names.take(pa.array(item)), pa.array(doc, mask=~known), pa.array(score)], names=["item", "item_id", "doc_id", "score"])

    rows = index.filter(F.size("terms") > 0).mapInArrow(work, "item int, item_id long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, pairs: pa.Table, k: int) -> DataFrame:
    """Ranked documents of the items in ``pairs`` (item_id, term)."""
    spark = docs.sparkSession
    ids = pairs["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    words = pairs["term"].combine_chunks().dictionary_encode()
    items, vocabulary = len(ids.dictionary), words.dictionary
    index = stored(_index(docs, vocabulary), "search-index")
    totals = index.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    postings = index.select("n", F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
    stats = postings.groupBy("p.terms").agg(F.count("*").alias("df"), F.max("p.tfs").alias("tf"), F.min("n").alias("n")).toArrow()

    df, tf, n = np.zeros(len(vocabulary), np.int64), np.ones(len(vocabulary), np.int64), np.ones(len(vocabulary), np.int64)
    at = stats["terms"].to_numpy()
    df[at], tf[at], n[at] = (stats[c].to_numpy() for c in ("df", "tf", "n"))
    item, term = ids.indices.to_numpy().astype(np.int64), words.indices.to_numpy().astype(np.int64)
    order = np.argsort(term, kind="stable")
    item, term = item[order], term[order]
    weight = np.array([math.floor(1000 * math.log((2 * totals["documents"] + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)

    rare = np.argsort(df, kind="stable")
    spent = np.cumsum((df * np.bincount(term, minlength=len(df)))[rare])
    phase = np.zeros(len(df), dtype=np.int64)
    phase[rare] = np.searchsorted(np.array(PHASES) * max(int(spent[-1]), 1), spent)
    weights = Weights(totals["documents"], max(totals["length"], 1), item, weight[term], np.searchsorted(term, np.arange(len(df) + 1)), phase, np.zeros((0, 0)))
    most = weights.pair_weight * weights.dampened(tf, n)[term] * (df[term] > 0)
    adds = np.zeros((len(PHASES), items), dtype=np.int64)
    np.add.at(adds, (phase[term], item), most)
    weights = weights._replace(rest=adds.sum(axis=0) - np.cumsum(adds, axis=0))

    stop, floor = np.full(items, len(PHASES), dtype=np.int64), np.zeros(items, dtype=np.int64)
    for done in range(1, len(PHASES)):
        kth = _pass(index, weights, ids.dictionary, done, stop, floor, k).filter(F.col("rank") == k).select("item", "score").toArrow()
        np.maximum.at(floor, kth["item"].to_numpy(), kth["score"].to_numpy())
        # A document of equal score may still come first by its id.
        stop[(weights.rest[done - 1] < floor) & (stop == len(PHASES))] = done - 1
        if (stop < len(PHASES)).all():
            break
    return _pass(index, weights, ids.dictionary, len(PHASES), stop, floor, k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item_id, rank from 1, doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text; ids are whole numbers, other columns are not read.
    Weight of a term with df of N documents: w = floor(1000 ln((2N + 2) / (2df + 1))); a document of n of all L
    terms, tf of them the term, scores w * (10^9 tf div (1000 tf + 8 m)), m = 10 + 90 n N div L, summed over the
    item's distinct terms. N counts documents with terms. Equal scores rank by doc_id, rows without id last.

    Null and empty texts have no terms: such documents are never found, such items find nothing. Each row of
    ``docs`` is a document, also where ids or texts repeat. Rows of ``items`` with equal id, null included, are one
    item with the terms of all of them. Empty tables give no rows. Memory: a block of items with about
    ``block_pairs`` terms in all is on the driver and in each task; more items make more blocks.
    """
    spark = docs.sparkSession

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, ends in split_terms(batch.column(1)):
                row = np.repeat(np.arange(first, first + len(ends) - 1), np.diff(ends))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), words.cast(pa.string())], names=["item_id", "term"])

    wanted = items.select(F.col("item_id").cast("long"), "text").mapInArrow(terms, "item_id long, term string")
    pairs = stored(wanted.distinct(), "search-terms")
    blocks = -(-pairs.count() // block_pairs)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    found = []
    for b in range(blocks):
        own = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow()
        if own.num_rows:
            found.append(_search_block(docs, own, k))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, found)
