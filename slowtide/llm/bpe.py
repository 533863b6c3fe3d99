"""BPE encoding with reuse of content-defined chunks, and decoding.

Texts are cut where a rolling hash over the last sixteen bytes has its low bits zero, so equal
passages fall into equal chunks wherever they stand. Chunks that occur again, in any document,
are encoded once for all their places; what lies between them is encoded in its place.
Ids next to a joint can differ from those of the whole text, so each joint is encoded anew over a
growing window until it agrees with both neighbours on the outermost words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.llm.common import Shipped, bit_filter, stored, text_slices
from slowtide.llm.tokenizer import Encoder
from slowtide.llm.words import mixed

LEAST_CHUNK, MEAN_BITS, MOST_CHUNK = 256, 10, 8192
#: Size of the filter that tells which chunks may occur again: 2^FILTER_BITS bits, whatever the input.
FILTER_BITS = 25
#: Occurrences that make a chunk common, and groups of tasks that each have such a chunk for themselves.
COMMON, SPREAD = 256, 32

_ROLL = np.uint64(0x9E3779B97F4A7C15)


def cut_points(flat: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each text, counted in bytes from the start of the slice; always between code points."""
    letters = mixed(np.arange(1, 257, dtype=np.uint64) * _ROLL)
    rolled = letters[flat]
    span, factor = 1, int(_ROLL)
    while span < 16:
        later = rolled.copy()
        later[span:] += rolled[:-span] * np.uint64(factor)
        rolled, span, factor = later, span * 2, factor * factor % (1 << 64)
    marks = np.flatnonzero((rolled >> np.uint64(64 - MEAN_BITS)) == 0) + 1
    inner = (flat & 0xC0) == 0x80
    out = []
    for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        own = marks[np.searchsorted(marks, begin + LEAST_CHUNK) : np.searchsorted(marks, end)].tolist()
        cuts, at, k = [], begin, 0
        while end - at > LEAST_CHUNK:
            while k < len(own) and own[k] < at + LEAST_CHUNK:
                k += 1
            to = min(own[k] if k < len(own) else end, at + MOST_CHUNK, end)
            while to < end and inner[to]:
                to += 1
            cuts.append(to)
            at = to
        if at < end:
            cuts.append(end)
        out.append(cuts)
    return out


def _digests(column: pa.Array) -> Iterator[list[tuple[bytes, bytes]]]:
    """For each text its chunks in order: digest and bytes."""
    for _, flat, ends in text_slices(column):
        data = flat.tobytes()
        for begin, cuts in zip(ends[:-1].tolist(), cut_points(flat, ends), strict=True):
            out = []
            for to in cuts:
                out.append((hashlib.blake2b(data[begin:to], digest_size=16).digest(), data[begin:to]))
                begin = to
            yield out


#: Text after which a task hands on what it has.
_FLUSH_BYTES = 4 << 20


def _number(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


class Joiner:
    """Token ids of a text from those of its consecutive parts."""

    def __init__(self, encoder: Encoder, window: int = 4096) -> None:
        self.encode, self.window = encoder.encode, window

    @staticmethod
    def _words_back(text: str, words: int) -> int:
        at = len(text)
        for _ in range(words):
            at = max(text.rfind(c, 0, at) for c in " \n\t\r")
            if at < 0:
                return 0
        return at

    @staticmethod
    def _words_on(text: str, words: int) -> int:
        at = -1
        for _ in range(words):
            found = [x for c in " \n\t\r" if (x := text.find(c, at + 1)) >= 0]
            if not found:
                return len(text)
            at = min(found)
        return at

    def _seam(self, left: str, whole: bool, left_ids: list[int], right: str, right_ids: list[int]) -> tuple[int, list[int], int] | None:
        """Ids to drop at the left, new ids, ids to skip at the right; None if ``left`` is but the end of a text and too short."""
        words = 2
        while True:
            a, b = self._words_back(left, words), self._words_on(right, words)
            if a == 0 and not whole:
                return None
            left_side, right_side = left[a:], right[:b]
            x, y, z = self.encode(left_side), self.encode(right_side), self.encode(left_side + right_side)
            outer_x = self.encode(left_side[: self._words_on(left_side[1:], 1) + 1])
            outer_y = self.encode(right_side[self._words_back(right_side, 1) :])
            left_agrees = a == 0 or bool(outer_x) and outer_x == x[: len(outer_x)] == z[: len(outer_x)] and left_ids[len(left_ids) - len(x) :] == x
            right_agrees = b == len(right) or bool(outer_y) and outer_y == y[len(y) - len(outer_y) :] == z[len(z) - len(outer_y) :] and right_ids[: len(y)] == y
            if left_agrees and right_agrees:
                return len(x) if a else len(left_ids), z, len(y) if b < len(right) else len(right_ids)
            words *= 2

    def join(self, parts: list[tuple[str, list[int]]]) -> list[int]:
        """Equal to encoding the joined texts: a joint is settled once a window around it, encoded with and
        without the joint, agrees on the outermost words, or covers both sides whole."""
        ids: list[int] = []
        done: list[str] = []
        kept, whole = "", True
        for text, own in parts:
            if not done:
                ids += own
            else:
                seam = self._seam(kept, whole, ids, text, own)
                if seam is None:
                    kept, whole = "".join(done), True
                    seam = self._seam(kept, whole, ids, text, own)
                drop, new, skip = seam
                del ids[len(ids) - drop :]
                ids += new
                ids += own[skip:]
            done.append(text)
            kept += text
            if len(kept) > self.window:
                kept, whole = kept[-self.window :], False
        return ids


#: What can be asked for each text.
OUTPUTS = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


class _Results:
    """The asked outputs of one text from its ids."""

    def __init__(self, encoder: Encoder, outputs: list[str]) -> None:
        self.encoder, self.outputs = encoder, outputs
        self.numbers = [str(i) for i in range(len(encoder.strings))]

    def of(self, ids: list[int]) -> list:
        out = {"n_tokens": len(ids), "ids": ids}
        if "ids_sha256" in self.outputs:
            out["ids_sha256"] = hashlib.sha256(" ".join(map(self.numbers.__getitem__, ids)).encode()).hexdigest()
        if "decoded" in self.outputs or "decoded_sha256" in self.outputs:
            out["decoded"] = self.encoder.decode(ids)
            out["decoded_sha256"] = hashlib.sha256(out["decoded"].encode()).hexdigest()
        return [out[c] for c in self.outputs]


_TYPES = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}


def encode_documents(docs: DataFrame, tokenizer_path: str, outputs: list[str], carry: list[str], text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """The columns ``carry`` of each row of ``docs`` and the asked ``outputs`` (see ``OUTPUTS``) for its text.

    Null texts count as empty: no tokens. Rows may repeat, any carried column may be null; an
    empty table gives no rows. ``carry`` may not name an output.

    1. Chunk digests are counted over all documents; those that occur again set bits in a filter of
       fixed size. A crowded filter sends more chunks the way of step 3, with equal results.
    2. Texts without such chunks are encoded where they are read. Of the others, such chunks become
       references and the text between them stays as it is.
    3. Each referenced chunk's text is joined to its references, which then follow one another, and
       is encoded for the first of them; a text's parts meet again and their joints are repaired.
       A common chunk is one of its own for each of ``SPREAD`` groups of tasks, so its references
       spread over as many tasks.
    """
    clash = sorted({c.lower() for c in carry} & {*OUTPUTS, "row", "part", "digest"})
    if clash:
        raise ValueError(f"carried columns clash with outputs: {clash}")
    spark = docs.sparkSession
    named = [F.col(c).alias(f"carry_{k}") for k, c in enumerate(carry)]
    source = docs.select(*named, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kept = source.columns[:-1]
    again = stored(source.select("text").mapInArrow(_digest_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1"), "bpe-again")
    told = Shipped(spark, bit_filter(again, "h", filter_bits))
    common = Shipped(spark, bit_filter(again.filter(F.col("n") >= COMMON), "h", filter_bits))

    carried = ", ".join(f"{c} {t}" for c, t in source.dtypes[:-1])
    asked = ", ".join(f"{c} {OUTPUTS[c]}" for c in outputs)
    first = stored(
        source.mapInArrow(_encode_or_cut(tokenizer_path, outputs, kept, told, common), f"{carried}, row long, part int, digest binary, text string, {asked}"),
        "bpe-parts",
    )
    pending = first.filter("part IS NOT NULL")
    # The join reads the one exchange of the texts by digest; ids are made behind it, so that texts travel no second time.
    shared = pending.filter("digest IS NOT NULL AND text IS NOT NULL").select("digest", "text").dropDuplicates(["digest"])
    references = pending.filter("digest IS NOT NULL").select(*kept, "row", "part", "digest").join(shared, "digest")
    references = references.sortWithinPartitions("digest").mapInArrow(_encode_chunks(tokenizer_path, kept), f"{carried}, row long, part int, text string, ids binary")
    between = pending.filter("digest IS NULL").select(*kept, "row", "part", "text", F.lit(None).cast("binary").alias("ids"))
    together = (
        references.unionByName(between)
        .groupBy("row")
        .agg(*(F.first(c).alias(c) for c in kept), F.array_sort(F.collect_list(F.struct("part", "text", "ids"))).alias("parts"))
    )
    joined = together.mapInArrow(_join_parts(tokenizer_path, outputs, kept), f"{carried}, {asked}")
    everything = first.filter("part IS NULL").select(*kept, *outputs).unionByName(joined)
    return everything.select(*(F.col(k).alias(c) for k, c in zip(kept, carry, strict=True)), *outputs)


def decode_documents(encoded: DataFrame, tokenizer_path: str, carry: list[str], ids_col: str = "ids") -> DataFrame:
    """The columns ``carry`` and ``decoded``, the text that the ids of each row stand for; null ids give null."""
    picked = encoded.select(*(F.col(c).alias(f"carry_{k}") for k, c in enumerate(carry)), F.col(ids_col).alias("ids"))
    kept = picked.columns[:-1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(tokenizer_path)
            texts = [None if ids is None else encoder.decode(ids) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(texts, pa.string())], [*kept, "decoded"])

    schema = ", ".join([*(f"{c} {t}" for c, t in picked.dtypes[:-1]), "decoded string"])
    return picked.mapInArrow(work, schema).select(*(F.col(k).alias(c) for k, c in zip(kept, carry, strict=True)), "decoded")


def _digest_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_number(d) for chunks in _digests(batch["text"]) for d, _ in chunks]
        h, n = np.unique(np.array(found, dtype=np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], ["h", "n"])


def _encode_or_cut(path: str, outputs: list[str], kept: list[str], told, common):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        row, group = task << 40, bytes([task % SPREAD])
        results, sent = None, set()
        none = [None] * len(outputs)
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.string(), *(_TYPES[OUTPUTS[c]] for c in outputs)]

        def flush(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
            of = pa.array([r[0] for r in rows], pa.int64())
            columns = [batch[c].take(of) for c in kept] + [pa.array([r[k + 1] for r in rows], t) for k, t in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, [*kept, "row", "part", "digest", "text", *outputs])

        for batch in batches:
            results = results or _Results(Encoder(path), outputs)
            rows: list[tuple] = []
            size = 0
            for k, (text, chunks) in enumerate(zip(batch["text"], _digests(batch["text"]), strict=True)):
                if size > _FLUSH_BYTES:
                    yield flush(batch, rows)
                    rows, size = [], 0
                size += sum(len(data) for _, data in chunks)
                numbers = np.array([_number(d) for d, _ in chunks], dtype=np.int64)
                hits = told.value.has(numbers).tolist()
                if not any(hits):
                    rows.append((k, None, None, None, None, *results.of(results.encoder.encode(text.as_py()))))
                    continue
                row, part, run = row + 1, 0, []
                for (digest, data), hit, many in zip(chunks, hits, common.value.has(numbers).tolist(), strict=True):
                    if not hit:
                        run.append(data)
                        continue
                    if many:
                        digest += group
                    if run:
                        rows.append((k, row, part, None, b"".join(run).decode(), *none))
                        run, part = [], part + 1
                    rows.append((k, row, part, digest, None if digest in sent else data.decode(), *none))
                    sent.add(digest)
                    part += 1
                if run:
                    rows.append((k, row, part, None, b"".join(run).decode(), *none))
            yield flush(batch, rows)

    return work


def packed(ids: list[int], most: int) -> bytes:
    """Ids below ``most`` in two bytes each where these are enough for all, else in four."""
    return np.array(ids, dtype="<u2" if most <= 1 << 16 else "<u4").tobytes()


def unpacked(data: bytes, most: int) -> list[int]:
    return np.frombuffer(data, dtype="<u2" if most <= 1 << 16 else "<u4").tolist()


def _encode_chunks(path: str, kept: list[str]):
    """Ids of each reference's chunk, from rows sorted by digest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = last = ids = None
        for whole in batches:
            encoder = encoder or Encoder(path)
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                found = []
                for digest, text in zip(batch["digest"].to_pylist(), batch["text"], strict=True):
                    if digest != last:
                        last, ids = digest, packed(encoder.encode(text.as_py()), len(encoder.strings))
                    found.append(ids)
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in [*kept, "row", "part", "text"]), pa.array(found, pa.binary())], [*kept, "row", "part", "text", "ids"])

    return work


def _join_parts(path: str, outputs: list[str], kept: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = joiner = most = None
        for whole in batches:
            if results is None:
                results = _Results(Encoder(path), outputs)
                joiner, most = Joiner(results.encoder), len(results.encoder.strings)
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                rows = []
                for parts in batch["parts"]:
                    own = [(p["text"], p["ids"]) for p in parts.as_py()]
                    rows.append(results.of(joiner.join([(t, results.encoder.encode(t) if ids is None else unpacked(ids, most)) for t, ids in own])))
                columns = [pa.array([r[k] for r in rows], _TYPES[OUTPUTS[c]]) for k, c in enumerate(outputs)]
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *columns], [*kept, *outputs])

    return work
