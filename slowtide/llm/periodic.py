"""Periodic runs of words: stretches that repeat their first few words over and over.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no
neighbouring word extends. The method: the words of a stretch are appended to a suffix automaton;
``access`` of a link-cut tree over its suffix links then walks from the state of each prefix to the
root, over segments of states that were last seen ending at the same word, and gives the whole path
the new end. A segment last seen d words ago whose longest string has d words or more closes a square
of period d, which is extended to its run. d is then the smallest period: with a smaller one the same
string would have been seen later.

Only stretches that can hold a run of the wanted exponent are appended. In a run of period q and
exponent k every word but the first q stands at most q words after an equal one, (k - 1) q words in a
row; stretches of that kind are found for all powers of two at once, by sorting. All words are
compared as exact strings, through a dictionary of the slice at hand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from slowtide.llm.common import beside, text_slices

WORD = r"[^\x20\x09-\x0D]+"
Run = tuple[int, int, int]


class SuffixLinks:
    """Suffix automaton of a word sequence: length and suffix link of each state, and the state of each prefix.

    State 0 stands for none, state 1 for the empty string.
    """

    def __init__(self, ids: list[int]) -> None:
        length, link, moves = [0, 0], [0, 0], [{}, {}]
        self.prefixes = prefixes = []
        last = 1
        for k, c in enumerate(ids, 1):
            new = len(length)
            length.append(k)
            link.append(1)
            moves.append({})
            p = last
            while p and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p:
                q = moves[p][c]
                if length[p] + 1 != length[q]:
                    split = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    moves.append(dict(moves[q]))
                    while p and moves[p].get(c) == q:
                        moves[p][c] = split
                        p = link[p]
                    link[q] = split
                    q = split
                link[new] = q
            prefixes.append(new)
            last = new
        self.length, self.link = length, link


def squares(ids: list[int]) -> Iterator[tuple[int, int]]:
    """(last word, period) of squares; among them the leftmost square of every run.

    Each splay tree holds a path of states last seen ending at the same word, which is kept at its root.
    """
    automaton = SuffixLinks(ids)
    length, up = automaton.length, automaton.link
    left, right, seen = [0] * len(up), [0] * len(up), [-1] * len(up)
    for end, x in enumerate(automaton.prefixes):
        below = 0
        while x:
            top, p = x, up[x]
            while p and (left[p] == top or right[p] == top):
                top, p = p, up[p]
            before = seen[top]
            if top != x:
                _splay(x, up, left, right)
            deeper = right[x]
            if deeper and deeper != below:
                seen[deeper] = before
            right[x] = below
            if 0 <= before and end - before <= length[x]:
                yield end, end - before
            below, x = x, up[x]
        seen[below] = end


def _splay(x: int, up: list[int], left: list[int], right: list[int]) -> None:
    """Make ``x`` the root of its splay tree; the root's ``up`` leads to the path above."""
    p = up[x]
    while p and (left[p] == x or right[p] == x):
        g = up[p]
        inner = g and (left[g] == p or right[g] == p)
        if inner and (left[g] == p) == (left[p] == x):
            _rotate(p, up, left, right)
        elif inner:
            _rotate(x, up, left, right)
        _rotate(x, up, left, right)
        p = up[x]


def _rotate(x: int, up: list[int], left: list[int], right: list[int]) -> None:
    p = up[x]
    g = up[p]
    if left[p] == x:
        child = right[x]
        left[p], right[x] = child, p
    else:
        child = left[x]
        right[p], left[x] = child, p
    if child:
        up[child] = p
    up[p], up[x] = x, g
    if g:
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x


def runs_within(words: list[int], begin: int, end: int, exponent: int, least: int) -> list[Run]:
    """(start, length, period) of runs with at least ``exponent`` periods and ``least`` words that have a square in words[begin:end]."""
    reached: dict[int, int] = {}
    found = []
    n = len(words)
    for last, q in squares(words[begin:end]):
        last += begin
        if reached.get(q, -1) >= last:
            continue
        a, b = last - 2 * q + 1, last + 1
        while b < n and words[b] == words[b - q]:
            b += 1
        while a > 0 and words[a - 1] == words[a - 1 + q]:
            a -= 1
        reached[q] = b - 1
        if b - a >= max(least, exponent * q):
            found.append((a, b - a, q))
    return found


def candidates(ids: np.ndarray, ends: np.ndarray, exponent: int, least: int) -> np.ndarray:
    """Disjoint stretches [begin, end) of the documents' words that hold every wanted run whole; rows of (document, begin, end).

    ``ids`` are the words of all documents, document k has those from ends[k] to ends[k + 1].
    """
    n = len(ids)
    if not n:
        return np.zeros((0, 3), dtype=np.int64)
    order = np.argsort(ids, kind="stable")
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    same = (ids[order][1:] == ids[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    back = np.full(n, n + 1, dtype=np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    found = []
    reach, longest = 1, int(np.diff(ends).max())
    while True:
        smallest = reach // 2 + 1
        need = max((exponent - 1) * smallest, least - reach, 1)
        if need + smallest > longest:
            break
        marked = np.zeros(n + 2, dtype=np.int8)
        marked[1:-1] = back <= reach
        edges = np.flatnonzero(np.diff(marked))
        starts, stops = edges[::2], edges[1::2]
        wide = stops - starts >= need
        found.append(np.stack([np.maximum(starts[wide] - reach, ends[doc[starts[wide]]]), stops[wide]], axis=1))
        reach *= 2
    spans = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    if not len(spans):
        return np.zeros((0, 3), dtype=np.int64)
    furthest = np.maximum.accumulate(spans[:, 1])
    # Spans never cross into another document, so touching ones of two documents stay apart.
    owner = doc[spans[:, 0]]
    opens = np.concatenate([[True], (spans[1:, 0] >= furthest[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(opens)
    return np.stack([owner[first], spans[first, 0], np.maximum.reduceat(spans[:, 1], first)], axis=1)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, and where each text's words begin and end among them; nulls have none."""
    texts = texts.fill_null("") if texts.null_count else texts
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets, words = offsets - offsets[0], lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), kept[offsets]


def find_runs(words: pa.Array, ends: np.ndarray, exponent: int, least: int) -> dict[int, list[Run]]:
    """Runs by document, sorted by start and period."""
    ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    out: dict[int, list[Run]] = {}
    own: list[int] = []
    at = -1
    for k, begin, end in candidates(ids, ends, exponent, least).tolist():
        if k != at:
            at, own = k, ids[ends[k] : ends[k + 1]].tolist()
        out.setdefault(k, []).extend(runs_within(own, begin - int(ends[k]), end - int(ends[k]), exponent, least))
    return {k: sorted(r) for k, r in out.items() if r}


def periodic_runs(docs: DataFrame, exponent: int = 4, least: int = 6, text_col: str = "text") -> DataFrame:
    """Every run of words with at least ``exponent`` periods and ``least`` words, and the text without its repeats.

    Adds to ``docs``: n_words; runs, an array of (start, length, period) sorted by start, then period;
    collapsed, the words joined by one space without those that a run contains after its first period.
    One narrow pass without shuffle, a text at a time: memory follows the longest stretch of a single
    text that may repeat itself, at some hundred bytes a word.

    Null and empty texts have no words and no run, and an empty collapsed text. Repeated rows get equal
    results each, an empty table gives none, ids are not read. Columns named like an output get ``_input``
    added. ``exponent`` is 2 or more.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    names = beside(docs.columns, {"n_words", "runs", "collapsed"})
    text_at = [c.lower() for c in docs.columns].index(text_col.lower())
    rows = docs.toDF(*names)
    added = [
        StructField("n_words", LongType()),
        StructField("runs", ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))),
        StructField("collapsed", StringType()),
    ]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, ends_of in text_slices(batch.column(text_at)):
                part = batch.slice(first, len(ends_of) - 1)
                words, ends = split_words(part.column(text_at))
                found = find_runs(words, ends, exponent, least)
                keep = np.ones(len(words), dtype=bool)
                flat = []
                for k, own in found.items():
                    for start, length, period in own:
                        keep[ends[k] + start + period : ends[k] + start + length] = False
                        flat.append((start, length, period))
                numbers = np.array(flat, dtype=np.int64).reshape(-1, 3)
                each = np.zeros(part.num_rows + 1, dtype=np.int32)
                each[[k + 1 for k in found]] = [len(r) for r in found.values()]
                structs = pa.StructArray.from_arrays([pa.array(numbers[:, c]) for c in range(3)], fields=list(kind.value_type))
                runs = pa.ListArray.from_arrays(pa.array(np.cumsum(each, dtype=np.int32)), structs)
                left = np.concatenate([[0], np.cumsum(keep)])[ends]
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.filter(pa.array(keep))), " ")
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(ends)), runs, joined], names=[*names, "n_words", "runs", "collapsed"]
                )

    return rows.mapInArrow(work, StructType([*rows.schema.fields, *added]))


def stuttered(text: Column, doc_id: Column) -> Column:
    """The contract's edit: one document in ten repeats itself from some word on; the others keep their text.

    With h the CRC-32 of the decimal id and g = floor(h / 10), texts with h % 10 = 0 and n > 0 words become
    their words joined by one space, where word i >= a = g % n is replaced by word a + (i - a) % p,
    p = 1 + floor((n - a) / (3 + g % 8)). Rows without id keep their text.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def edit(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.concat_ws(" ", F.transform(at, lambda i: F.get(words, i.cast("int"))))).otherwise(text)

    one = F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), 0)), edit)
    return F.when(h % 10 == 0, F.get(one, 0)).otherwise(text)


def runs_report(docs: DataFrame, exponent: int = 4, least: int = 6) -> DataFrame:
    """doc_id, number of runs, the run with greatest length / period, and digests of all runs and of the collapsed text.

    Ties go to the smallest start, then period; without a run its four columns are null. Handles rows as
    ``periodic_runs`` does.
    """
    rows = periodic_runs(docs.select("doc_id", "text"), exponent, least)

    def ahead(a: Column, b: Column) -> Column:
        # Runs come by start and period, so of equal ratios the first stays.
        return F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)

    best = F.aggregate(F.col("runs"), F.get("runs", 0), ahead)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
