"""Words ``[^\\x20\\x09-\\x0D]+`` of texts as 64-bit hashes, and hashes of runs of words.

Work on UTF-8 bytes: the separators are single bytes there. A word's bytes are scrambled eight at a
time, each step on the result of the one before, and long words go through BLAKE2; a run's hash
scrambles those of its halves. No sum of positions is left in them whose terms could cancel, so n
different words or runs share a hash with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

import hashlib

import numpy as np

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LEFT = np.uint64(0xD1342543DE82EF95)
_RIGHT = np.uint64(0xA0761D6478BD642F)
#: Bytes above which a word goes through BLAKE2.
LONG_WORD = 64
#: Masks of the first 0 to 8 bytes of a little-endian number.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """One-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashes in this order."""
    return mixed(mixed(left + _GOLD) * _LEFT ^ right * _RIGHT)


class Hasher:
    """Hashes of words and of runs of words."""

    def __init__(self, lower: bool = False) -> None:
        self._bytes = np.arange(256, dtype=np.uint8)
        if lower:
            self._bytes[65:91] += 32
        space = np.zeros(256, dtype=bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        self._space = space

    def words(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end byte of each word, and where each text's words begin and end."""
        if not len(flat):
            none = np.zeros(0, dtype=np.int64)
            return np.zeros(0, dtype=np.uint64), none, none, np.zeros(len(ends), dtype=np.int64)
        inside = ~self._space[flat]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = ends[1:-1]
        edges = edges[edges < len(flat)]
        begins[edges] |= inside[edges]
        starts = np.flatnonzero(begins)
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        inner = edges[edges > 0] - 1
        closes[inner] |= inside[inner]
        stops = np.flatnonzero(closes) + 1
        return self._hashes(flat, starts, stops), starts, stops, np.searchsorted(starts, ends)

    def _hashes(self, flat: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        length = stops - starts
        out = mixed(length.astype(np.uint64) * _GOLD + _LEFT)
        plain = np.concatenate([self._bytes[flat], np.zeros(8, dtype=np.uint8)])
        eights = np.lib.stride_tricks.sliding_window_view(plain, 8)
        short = length <= LONG_WORD
        at = np.flatnonzero(short)
        for done in range(0, LONG_WORD, 8):
            at = at[length[at] > done]
            if not len(at):
                break
            part = eights[starts[at] + done].view("<u8")[:, 0]
            part &= _FIRST_BYTES[np.minimum(length[at] - done, 8)]
            out[at] = mixed((out[at] ^ part) + _GOLD)
        for k in np.flatnonzero(~short).tolist():
            out[k] = int.from_bytes(hashlib.blake2b(plain[starts[k] : stops[k]], digest_size=8).digest(), "little")
        return out

    def runs(self, hashes: np.ndarray) -> "Runs":
        return Runs(hashes)


class Runs:
    """Hashes of ``length`` consecutive words from given positions on, built from runs of 1, 2, 4, … words."""

    def __init__(self, hashes: np.ndarray) -> None:
        self._levels = [hashes]

    def _level(self, k: int) -> np.ndarray:
        while len(self._levels) <= k:
            last, half = self._levels[-1], 1 << (len(self._levels) - 1)
            self._levels.append(_joined(last[:-half], last[half:]) if len(last) > half else last[:0])
        return self._levels[k]

    def at(self, begin: np.ndarray, length: int) -> np.ndarray:
        out = np.full(len(begin), length, dtype=np.uint64)
        if not len(begin):
            return out
        done = 0
        for k in reversed(range(int(length).bit_length())):
            if length >> k & 1:
                out = _joined(out, self._level(k)[begin + done])
                done += 1 << k
        return out
