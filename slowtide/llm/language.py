"""Language identification with error-correcting output codes.

Every language has a codeword. For each bit a binary classifier over byte trigrams of the letters
tells whether the language is among those whose codeword has the bit; its margin is the mean, over
the text's trigrams, of log likelihood ratios. Decoding weighs each bit's loss with the margin and
takes the nearest codeword.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.llm.common import beside, text_slices
from slowtide.llm.words import mixed

UNKNOWN = "und"
FEATURES = 1 << 15
#: Labelled rows that a fit takes at most, about; which ones depends on a hash of their ids and texts.
FIT_ROWS = 20_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)


def trigrams(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of the trigram at each byte, and whether it counts: inside one text, not mere separators.

    ASCII letters in lower case and all bytes of other characters are kept, everything else is a separator.
    """
    letters = _FOLD[flat]
    n = len(letters)
    if n < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    wide = letters.astype(np.uint64)
    codes = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
    counts = (letters[1:-1] != 32) & ((letters[:-2] != 32) | (letters[2:] != 32))
    for edge in ends[1:-1]:
        counts[max(0, edge - 2) : edge] = False
    return (mixed(codes) >> np.uint64(64 - 15)).astype(np.int64), counts


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per class: all distinct two-way splits for up to 6 classes, else hashed bits.

    The hashed code has 15 bits per doubling of the classes; rows that agree in over a third of the
    columns less than chance would are not sought, its length makes them very unlikely.
    """
    if n <= 6:
        columns = [[1 if k == 0 or (split >> (k - 1)) & 1 else -1 for k in range(n)] for split in range((1 << max(n - 1, 0)) - 1)]
        return np.array(columns or [[1]] * 1, dtype=np.float64).T.reshape(n, -1) if n else np.zeros((0, 0))
    width = 15 * (n - 1).bit_length()
    cells = np.arange(n * width, dtype=np.uint64).reshape(n, width) + np.uint64(1)
    return np.where(mixed(cells * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63), 1.0, -1.0)


class LanguageModel:
    """Languages, their codewords, and for each bit a weight per feature."""

    def __init__(self, languages: list[str], counts: np.ndarray, smoothing: float = 0.5, sharpness: float = 8.0, gap: float = 0.02) -> None:
        self.languages, self.code, self.sharpness, self.gap = languages, codewords(len(languages)), sharpness, gap
        rates = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True) if len(languages) else counts
        bits = self.code.shape[1] if len(languages) else 0
        self.weights = np.zeros((bits, FEATURES), dtype=np.float32)
        for b in range(bits):
            on, off = rates[self.code[:, b] > 0], rates[self.code[:, b] < 0]
            if len(on) and len(off):
                self.weights[b] = np.log(on.mean(axis=0)) - np.log(off.mean(axis=0))

    @classmethod
    def restored(cls, fields: dict) -> "LanguageModel":
        """The model with these fields, as ``vars`` gives them."""
        out = cls.__new__(cls)
        vars(out).update(fields)
        return out

    def predict(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For slices of texts: first row, number of the language, score, and whether it is ambiguous."""
        for first, flat, ends in text_slices(column):
            features, counts = trigrams(flat, ends)
            n = len(ends) - 1
            margins = np.zeros((n, len(self.weights)))
            at = np.flatnonzero(counts)
            if len(at):
                own = features[at]
                edges = np.searchsorted(at, ends)
                some = np.flatnonzero(np.diff(edges))
                for b, weight in enumerate(self.weights):
                    margins[some, b] = np.add.reduceat(weight[own].astype(np.float64), edges[some])
                margins[some] /= np.diff(edges)[some, None]
            yield first, *self.decode(margins)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword by logistic loss; its share among all as score; ambiguous if the next is as near within ``gap``."""
        if not self.languages:
            return np.full(len(margins), -1), np.zeros(len(margins)), np.ones(len(margins), dtype=bool)
        loss = np.logaddexp(0.0, -self.sharpness * margins[:, None, :] * self.code[None]).mean(axis=2)
        shares = np.exp(loss.min(axis=1, keepdims=True) - loss)
        shares /= shares.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        ranked = np.sort(shares, axis=1)
        near = ranked[:, -1] - ranked[:, -2] < self.gap if shares.shape[1] > 1 else np.zeros(len(margins), dtype=bool)
        return best, shares[np.arange(len(margins)), best], near


def fold_of(id_col: str = "doc_id") -> Column:
    """The documents' fold, 0 to 3; ids without value are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4, F.lit(0))


def label_bound(sizes: list[int], most_rows: int) -> int:
    """Most rows of a label, so that all labels together have at most ``most_rows``; one at least."""
    left = most_rows
    for k, n in enumerate(sorted(sizes)):
        bound = left // (len(sizes) - k)
        if n > bound:
            return max(1, bound)
        left -= n
    return max(1, most_rows)


def fit(docs: DataFrame, most_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int | None = 2) -> LanguageModel:
    """A model from labelled documents outside the held-out fold; whole texts of a hashed sample of at most about ``most_rows``.

    The sample is bounded by label: one with no more rows than the bound keeps them all, others are
    thinned to about as many, so a rare label is learned however large the table is. Null or empty
    texts and null labels teach nothing. The driver gets one row per language and feature.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.col(lang_col) != UNKNOWN))
    if held_out is not None:
        labelled = labelled.filter(fold_of(id_col) != held_out)
    label = F.col(lang_col).cast("string")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy(label.alias("lang")).agg(F.count("*").alias("n")).collect()}
    bound = label_bound(list(sizes.values()), most_rows)
    if many := {k: n for k, n in sizes.items() if n > bound}:
        limits = F.create_map(*(F.lit(x) for k, n in many.items() for x in (k, int(bound / n * (1 << 30)))))
        drawn = F.pmod(F.xxhash64(F.lit("fit"), id_col, text_col), F.lit(1 << 30))
        labelled = labelled.filter(drawn < F.coalesce(limits[label], F.lit(1 << 30)))
    counted = (
        labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .mapInArrow(_feature_counts, "lang string, feature int, n long")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = sorted(set(counted["lang"].to_pylist()))
    counts = np.zeros((len(languages), FEATURES))
    if languages:
        row = np.searchsorted(np.array(languages, dtype=object), counted["lang"].to_numpy(zero_copy_only=False))
        counts[row, counted["feature"].to_numpy()] = counted["n"].to_numpy()
    return LanguageModel(languages, counts)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous``, from the text alone.

    A null text, or one without a letter, gives ``und`` with score 0, not ambiguous. With no language
    learned everything is ``und``. Ties go to the language first in order of name and are ambiguous.
    Columns named like an output come out with ``_input`` added to their name.
    """
    names = beside(docs.columns, {"lang_pred", "score", "ambiguous", "_letters"})
    text_col = names[[c.lower() for c in docs.columns].index(text_col.lower())]
    docs = docs.toDF(*names)
    # Plain values, which workers read without this package.
    told = docs.sparkSession.sparkContext.broadcast(vars(model))
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("_letters")
    source = docs.select("*", letters)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), "lang_pred string, score double, ambiguous boolean"])
    columns = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = LanguageModel.restored(told.value)
            best, score, near = np.full(len(batch), -1), np.zeros(len(batch)), np.zeros(len(batch), dtype=bool)
            for first, *found in known.predict(batch[text_col]):
                for whole, part in zip((best, score, near), found, strict=True):
                    whole[first : first + len(part)] = part
            none = ~batch["_letters"].to_numpy(zero_copy_only=False).astype(bool) | (best < 0)
            best[none], score[none], near[none] = len(known.languages), 0.0, False
            names = pa.array([*known.languages, UNKNOWN], pa.string()).take(pa.array(best))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), names, pa.array(score), pa.array(near)], [*columns, "lang_pred", "score", "ambiguous"])

    return source.mapInArrow(work, schema)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch["lang"].to_pylist(), dtype=object)
        for first, flat, ends in text_slices(batch["text"]):
            features, counts = trigrams(flat, ends)
            own = langs[first : first + len(ends) - 1]
            of = np.searchsorted(ends, np.flatnonzero(counts), side="right") - 1
            for lang in set(own):
                at = np.flatnonzero(counts)[own[of] == lang]
                totals[lang] = totals.get(lang, 0) + np.bincount(features[at], minlength=FEATURES)
    for lang, n in totals.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], ["lang", "feature", "n"])
