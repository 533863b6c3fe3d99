"""Substring dedup: runs of words that an earlier document has too are taken out.

Level-wise doubling. Whether a window of ``window`` words is repeated is asked last, and only near
places that were repeated at a quarter and then at half of that length. The first level looks at
anchors alone: in each window the run of a quarter's length with the smallest hash, the first one of
equals. Equal windows have equal anchors, so an anchor that no other document has rules out all
windows it stands for. The second level extends surviving anchors to twice the length, to the right
and to the left; each window holds one of the two. The third level hashes the windows themselves.

Between levels only hashes that occur in two documents go on, as a filter of fixed size that each
task tests while it reads the texts again. A filter can let a window pass too many, never
too few; the last level compares exactly, by 64-bit hashes. With more repeated hashes than the filter
has room for, more windows reach the last level and the result stays the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.llm.common import BitFilter, Shipped, bit_filter, stored, text_slices
from slowtide.llm.words import Hasher, Runs

WINDOW = 50
#: Bits of the filter between two levels: 2^FILTER_BITS.
FILTER_BITS = 25
_SEGMENT = 1 << 22
_PLACE = np.uint64((1 << 23) - 1)


def anchors(runs: Runs, bounds: np.ndarray, window: int) -> np.ndarray:
    """Places of the anchors of all windows of texts whose words lie between ``bounds``; ascending, each once."""
    short = -(-window // 4)
    reach = window - short + 1
    total = int(bounds[-1])
    out = []
    for begin in range(0, total, _SEGMENT):
        end = min(total, begin + _SEGMENT + window)
        places = np.arange(begin, end - short + 1)
        if not len(places):
            continue
        low = runs.at(places, short) & ~_PLACE | (places - begin).astype(np.uint64)
        span = 1
        while span * 2 <= reach:
            low = np.minimum(low[:-span], low[span:]) if len(low) > span else low[:0]
            span *= 2
        if span < reach:
            low = np.minimum(low[: len(low) - (reach - span)], low[reach - span :]) if len(low) > reach - span else low[:0]
        # Windows that begin in this segment and lie within one text.
        starts = window_starts(bounds, window, begin, min(total, begin + _SEGMENT)) - begin
        if len(starts):
            chosen = (low[starts] & _PLACE).astype(np.int64)
            out.append(chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])] + begin)
    return np.unique(np.concatenate(out)) if out else np.zeros(0, dtype=np.int64)


def window_starts(bounds: np.ndarray, window: int, begin: int, end: int) -> np.ndarray:
    """Places from ``begin`` to before ``end`` from which ``window`` words follow within a text."""
    first = np.maximum(bounds[:-1], begin)
    last = np.minimum(bounds[1:] - window + 1, end)
    n = np.maximum(last - first, 0)
    some = np.flatnonzero(n)
    if not len(some):
        return np.zeros(0, dtype=np.int64)
    n, first = n[some], first[some]
    return np.arange(n.sum()) + np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n)


class _Scan:
    """The hashes that each level asks for, from slices of texts."""

    def __init__(self, window: int, filters: list[BitFilter]) -> None:
        self.window, self.filters, self.hasher = window, filters, Hasher()
        self.short = -(-window // 4)

    def slices(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, Runs]]:
        for first, flat, ends in text_slices(column):
            hashes, _, _, bounds = self.hasher.words(flat, ends)
            yield first, bounds, self.hasher.runs(hashes)

    def found(self, bounds: np.ndarray, runs: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the level after the given filters: text, place and hash of each run."""
        level = len(self.filters)
        at = anchors(runs, bounds, self.window)
        if not len(at):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        if level:
            at = at[self.filters[0].has(runs.at(at, self.short))]
        of = np.searchsorted(bounds, at, side="right") - 1
        if not level:
            return of, at, runs.at(at, self.short).view(np.int64)
        right = at + 2 * self.short <= bounds[of + 1]
        left = at - self.short >= bounds[of]
        place = np.concatenate([at[right], at[left] - self.short])
        text = np.concatenate([of[right], of[left]])
        hashes = runs.at(place, 2 * self.short)
        if level == 1:
            return text, place, hashes.view(np.int64)
        keep = self.filters[1].has(hashes)
        anchor = np.concatenate([at[right], at[left]])[keep]
        # Every window around a surviving anchor, each once.
        text, reach = text[keep], self.window - self.short
        low = np.maximum(anchor - reach, bounds[text])
        high = np.minimum(anchor, bounds[text + 1] - self.window)
        mark = np.zeros(int(bounds[-1]) + 2, dtype=np.int64)
        some = high >= low
        np.add.at(mark, low[some], 1)
        np.add.at(mark, high[some] + 1, -1)
        place = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        text = np.searchsorted(bounds, place, side="right") - 1
        hashes = runs.at(place, self.window)
        if level > 2:
            keep = self.filters[2].has(hashes)
            text, place, hashes = text[keep], place[keep], hashes[keep]
        return text, place, hashes.view(np.int64)


def _level(window: int, filters) -> "callable":
    """Per hash the smallest and largest document id of the batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan(window, [f.value for f in filters])
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            for first, bounds, runs in scan.slices(batch["text"]):
                text, _, h = scan.found(bounds, runs)
                own = ids[first + text]
                order = np.lexsort((own, h))
                h, own = h[order], own[order]
                edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, dtype=np.int64)
                last = np.concatenate([edge[1:], [len(h)]]) - 1 if len(edge) else edge
                yield pa.RecordBatch.from_arrays([pa.array(h[edge]), pa.array(own[edge]), pa.array(own[last])], ["h", "least", "most"])

    return work


#: What can be asked for each row.
OUTPUTS = {"n_words": "long", "n_removed": "long", "spans": "array<struct<begin:long,end:long>>", "kept": "string", "kept_sha256": "string"}
_TYPES = {
    "n_words": pa.int64(),
    "n_removed": pa.int64(),
    "spans": pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])),
    "kept": pa.string(),
    "kept_sha256": pa.string(),
}


def remove_repeats(docs: DataFrame, outputs: list[str], window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """Rows (doc_id, *outputs), one for each row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a window over it also starts in a document
    with a smaller id; windows are those of the input. ``kept`` are the other words joined by a space,
    ``spans`` the removed places, from word ``begin`` to before ``end``. Rows of equal id are never each
    other's source; a row without id loses nothing and is no source. Null texts have no words. Other
    columns are ignored; an empty table gives no rows. ``window`` is 4 or more.
    """
    if window < 4:
        raise ValueError("a window has four words or more")
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with_id = source.filter("doc_id IS NOT NULL")
    filters: list = []
    for level in range(3):
        seen = with_id.mapInArrow(_level(window, list(filters)), "h long, least long, most long")
        repeated = seen.groupBy("h").agg(F.min("least").alias("least"), F.max("most").alias("most")).filter("least < most")
        if level == 2:
            repeated = stored(repeated.select("h", "least"), "repeated-windows")
        survivors = bit_filter(repeated, "h", filter_bits)
        filters.append(Shipped(spark, survivors))
        if survivors.empty:
            break
    # Without survivors no window is repeated, and the same step finds no hit.
    asked = ", ".join(f"{c} {OUTPUTS[c]}" for c in outputs)
    first = stored(source.mapInArrow(_finish_or_mark(window, filters, outputs), f"doc_id long, row long, text string, places array<long>, hashes array<long>, {asked}"), "repeat-marks")
    done = first.filter("row IS NULL").select("doc_id", *outputs)
    if survivors.empty:
        return done
    marked = first.filter("row IS NOT NULL")
    hits = marked.select("row", "doc_id", F.explode(F.arrays_zip("places", "hashes")).alias("z")).select("row", "doc_id", F.col("z.places").alias("place"), F.col("z.hashes").alias("h"))
    removed = hits.join(repeated, "h").filter("least < doc_id").groupBy("row").agg(F.collect_list("place").alias("places"))
    cut = marked.select("row", "doc_id", "text").join(removed, "row", "left").mapInArrow(_cut(window, outputs), f"doc_id long, {asked}")
    return done.unionByName(cut)


def _results(outputs: list[str], data: bytes, places: np.ndarray, window: int) -> list:
    words = data.split()
    n = len(words)
    gone = np.zeros(n + 1, dtype=np.int64)
    if len(places):
        np.add.at(gone, places, 1)
        np.add.at(gone, places + window, -1)
    gone = np.cumsum(gone)[:n] > 0
    removed = int(gone.sum())
    kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if removed else words)
    out = {"n_words": n, "n_removed": removed, "kept": kept}
    if "kept_sha256" in outputs:
        out["kept_sha256"] = hashlib.sha256(kept).hexdigest()
    if "spans" in outputs:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        out["spans"] = [{"begin": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
    if "kept" in outputs:
        out["kept"] = kept.decode()
    return [out[c] for c in outputs]


def _finish_or_mark(window: int, filters, outputs: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        scan = _Scan(window, [f.value for f in filters])
        empty = np.zeros(0, dtype=np.int64)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), *(_TYPES[c] for c in outputs)]
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"]
            # A slice of texts at a time goes on, so a task holds the places of one slice.
            for first, bounds, runs in scan.slices(texts):
                text, place, h = scan.found(bounds, runs) if len(filters) == 3 and not filters[2].value.empty else (empty, empty, empty)
                edges = np.searchsorted(text, np.arange(len(bounds)))
                rows = []
                for k in range(len(bounds) - 1):
                    a, b = edges[k], edges[k + 1]
                    value = texts[first + k].as_py() or ""
                    if a == b or ids[first + k] is None:
                        rows.append((ids[first + k], None, None, None, None, *_results(outputs, value.encode(), empty, window)))
                    else:
                        row += 1
                        rows.append((ids[first + k], row, value, place[a:b] - bounds[k], h[a:b], *[None] * len(outputs)))
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "text", "places", "hashes", *outputs])

    return work


def _cut(window: int, outputs: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(batch["text"], batch["places"], strict=True):
                own = np.array(places.as_py() or [], dtype=np.int64)
                rows.append(_results(outputs, text.as_py().encode(), own, window))
            columns = [pa.array([r[k] for r in rows], _TYPES[c]) for k, c in enumerate(outputs)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", *outputs])

    return work
