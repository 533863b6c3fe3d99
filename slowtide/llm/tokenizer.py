"""Pieces of a text as the tokenizer's own splitting makes them, and their token ids."""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

#: Code points below this, but for those in ``_ODD``, split by ``_PIECES`` as by the tokenizer's normaliser and splitter.
_PLAIN_END = 0x250
_ODD = np.zeros(_PLAIN_END, dtype=bool)
_ODD[0x1C:0x20] = _ODD[0x80:0xC0] = True
#: The splitting pattern of word_bpe_49k.json, its classes spelt out for those characters; the
#: alternatives begin with different characters but for the contractions, so those may come later.
_PIECES = re.compile("[a-zA-ZÀ-ÖØ-öø-ɏ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[\x00-\x08\x0e-\x1b!-/:-@\\[-`{-\x7f×÷̇]+")
#: The normaliser and the splitter that this module stands for; another tokenizer takes the library's own.
_KNOWN = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]


class Splitter:
    """Special strings and pieces of texts for one tokenizer file."""

    def __init__(self, path: str) -> None:
        # Spark runs a task per core; the library's own threads would only compete.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        kinds = [x["type"] for x in (self.spec["normalizer"] or {}).get("normalizers", [])], [x["type"] for x in (self.spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self._fast = kinds == _KNOWN
        self.special = {x["content"]: x["id"] for x in self.spec["added_tokens"]}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")

    def plain(self, text: str) -> bool:
        """Whether ``pieces`` may be used: no special string, and only characters whose splitting is spelt out here."""
        if not self._fast or not text:
            return self._fast
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        return int(codes.max()) < _PLAIN_END and not _ODD[codes].any() and not any(s in text for s in self.special)

    @staticmethod
    def pieces(text: str) -> list[str]:
        return _PIECES.findall(text.lower())

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """The text cut at special strings; those carry their id."""
        out: list[tuple[str, int | None]] = []
        at = 0
        for m in self._special.finditer(text):
            out += [(text[at : m.start()], None), (m[0], self.special[m[0]])]
            at = m.end()
        return [*out, (text[at:], None)]

    def library_pieces(self, text: str) -> list[str]:
        """Pieces of a text without special strings, byte for byte in the tokenizer's alphabet."""
        text = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in own}
    out.update({b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in out)})
    return out


class Encoder(Splitter):
    """Token ids of texts, as the library gives them without begin, end or added tokens.

    Distinct pieces go through the library once and are kept, ``most`` of them at a time; those not met
    again while half as many others came are forgotten.
    """

    def __init__(self, path: str, most: int = 200_000) -> None:
        super().__init__(path)
        self._known: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._most = most
        self._joined = self.spec["decoder"] is None
        del self.spec
        ids = self.library.get_vocab(with_added_tokens=True)
        self.strings = [""] * (max(ids.values(), default=-1) + 1)
        for s, i in ids.items():
            self.strings[i] = s
        # One object per id, whatever refers to it.
        self._ids = list(range(len(self.strings)))

    def encode(self, text: str) -> list[int]:
        if not self.plain(text):
            return self.library.encode(text, add_special_tokens=False).ids
        pieces = self.pieces(text)
        known = self._known
        new = set(pieces).difference(known)
        if new:
            if len(known) > self._most // 2:
                self._older, self._known = known, {}
                known, new = self._known, set(pieces)
            older, own, ask = self._older, self._ids, []
            for p in new:
                if (ids := older.get(p)) is None:
                    ask.append(p)
                else:
                    known[p] = ids
            for p, e in zip(ask, self.library.encode_batch_fast(ask, add_special_tokens=False), strict=True):
                known[p] = tuple([own[i] for i in e.ids])
        return list(chain.from_iterable(map(known.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> str:
        """As the library's decode with special tokens kept; without a decoder that joins token strings by a space."""
        if not self._joined:
            return self.library.decode(ids, skip_special_tokens=False)
        return " ".join(map(self.strings.__getitem__, ids))
