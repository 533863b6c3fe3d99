"""Token counts by a compiled tokenizer: a deterministic transducer over the bytes of a text.

State and transitions. Within a piece (what the tokenizer's splitting leaves together) a state
stands for everything that later bytes can depend on: every suffix of the bytes read that some
vocabulary token starts with, the last token of the encoding before it, and how many tokens were
emitted since. A transition on a byte carries the change of the token count; the last byte of a
piece has a transition of its own, as the vocabulary marks word ends. States are found while
reading and are kept, up to a limit, like the transitions: the machine is finite, and large
parts of it are never visited. White space leads back to the first state from any state.

Chunks. A text is cut into chunks of a fixed number of code points. A chunk's state map says what
the chunk does to any entry state: characters up to its first white space run on from the entry
state, the rest is a constant number of tokens and a constant exit state, named by the characters
that lead to it. Such maps compose associatively; a text's maps are folded pairwise in a tree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.llm.tokenizer import Splitter, byte_alphabet

CHUNK_CHARS = 1 << 14
_BLOCK_CHARS = 1 << 20
_RESET = re.compile("[ \t\n\r]")


class _Pieces(dict):
    """Counts of whole pieces; an unknown piece runs through the machine."""

    def __init__(self, machine: "CountTransducer") -> None:
        super().__init__()
        self._machine = machine

    def __missing__(self, piece: str) -> int:
        return self._machine.piece(piece)


class CountTransducer(Splitter):
    """Counts tokens of a byte-pair vocabulary with word-end marks; ``most_states`` bounds what is kept."""

    def __init__(self, path: str, most_states: int = 120_000, most_pieces: int = 300_000) -> None:
        super().__init__(path)
        model = self.spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("only byte-pair vocabularies without dropout, fallback or subword prefix can be compiled")
        self._mark = model.get("end_of_word_suffix") or ""
        self._most_states, self._most_pieces = most_states, most_pieces
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        self._rank = {m: k for k, m in enumerate(merges)}
        self._parts: dict[str, tuple[str, str]] = {}
        self._born: dict[str, int] = {}
        for (a, b), k in self._rank.items():
            whole = a + b
            if whole in model["vocab"] and whole not in self._parts:
                self._parts[whole] = (a, b)
                self._born[whole] = max(k, self._born.get(a, -1), self._born.get(b, -1))
        self._vocab = model["vocab"]
        self._starts = {t[:k] for t in self._vocab for k in range(1, len(t) + 1)}
        self._spines: dict[tuple[str, bool], list[tuple[str, int, float]]] = {}
        self._whole: dict[str, bool] = {}
        self._good = {t for t in self._vocab if self._reachable(t)}
        self._beside: dict[tuple[str, str], bool] = {}
        self._pieces = _Pieces(self)
        self._clear()

    def _clear(self) -> None:
        """Forget all states but the first; a state is (transitions, final transitions, what it stands for)."""
        first = (("", None, 0),)
        self._first = ({}, {}, first)
        self._states: dict[tuple, tuple] = {first: self._first}

    def _spine(self, token: str, right: bool) -> list[tuple[str, int, float]]:
        """Symbols at the right (or left) edge while ``token`` is merged: symbol, when it appears, when it goes."""
        key = (token, right)
        if key not in self._spines:
            out, gone, at = [], float("inf"), token
            while True:
                born = self._born.get(at, -1)
                out.append((at, born, gone))
                if at not in self._parts:
                    break
                gone, at = born, self._parts[at][right]
            self._spines[key] = out
        return self._spines[key]

    def _meets(self, a: str, b: str, but: tuple[str, str] | None = None) -> bool:
        """Whether merging the strings of ``a`` and ``b`` side by side merges across their border (at equal rank the left pair goes first)."""
        for x, born_x, gone_x in self._spine(a, True):
            for y, born_y, gone_y in self._spine(b, False):
                rank = self._rank.get((x, y))
                if rank is not None and (x, y) != but:
                    when = max(rank, born_x, born_y)
                    if when < gone_x and when <= gone_y:
                        return True
        return False

    def _reachable(self, token: str) -> bool:
        """Whether the token's own string encodes to the token."""
        if token not in self._whole:
            halves = self._parts.get(token)
            self._whole[token] = token in self._vocab and (
                len(token.removesuffix(self._mark)) == 1
                if halves is None
                else self._reachable(halves[0]) and self._reachable(halves[1]) and not self._meets(*halves, but=halves)
            )
        return self._whole[token]

    def _fits(self, before: str, token: str) -> bool:
        if len(self._beside) > 500_000:
            self._beside.clear()
        self._beside[before, token] = out = not self._meets(before, token)
        return out

    def _step(self, state: tuple, char: str) -> tuple[tuple, int]:
        """Compile the transition on a byte within a piece: next state and change of the count."""
        good, beside, starts = self._good, self._beside, self._starts
        token, change, after = "", 0, []
        for s, before, since in state[2]:
            longer = s + char
            if not token and longer in good:
                fits = True if before is None else beside.get((before, longer))
                if fits or fits is None and self._fits(before, longer):
                    token, change = longer, 1 - since
            if longer in starts:
                after.append((longer, before, since))
        if not token:
            raise ValueError(f"no token covers {char!r}")
        if change:
            after = [(s, before, since + change) for s, before, since in after]
        after.append(("", token, 0))
        key = tuple(after)
        to = self._states.get(key)
        if to is None:
            self._states[key] = to = ({}, {}, key)
        state[0][char] = out = to, change
        return out

    def _end(self, state: tuple, char: str) -> int:
        """Compile the transition on a piece's last byte: change of the count."""
        char_end, good = char + self._mark, self._good
        for s, before, since in state[2]:
            token = s + char_end
            if token in good:
                fits = True if before is None else self._beside.get((before, token))
                if fits or fits is None and self._fits(before, token):
                    state[1][char] = 1 - since
                    return 1 - since
        raise ValueError(f"no token covers the final {char!r}")

    def _run(self, symbols: str) -> int:
        """Tokens of one piece, given in the tokenizer's byte alphabet."""
        if len(self._states) > self._most_states:
            self._clear()
        state, total = self._first, 0
        for c in symbols[:-1]:
            state, change = state[0].get(c) or self._step(state, c)
            total += change
        c = symbols[-1]
        last = state[1].get(c)
        return total + (self._end(state, c) if last is None else last)

    def piece(self, piece: str) -> int:
        """Tokens of one piece as it stands in a text; kept, as a path of the machine taken as a whole."""
        if len(self._pieces) > self._most_pieces:
            self._pieces.clear()
        n = self._run(piece if piece.isascii() and piece.isprintable() else "".join(map(_ALPHABET.__getitem__, piece.encode())))
        self._pieces[piece] = n
        return n

    def count(self, text: str) -> int:
        """Tokens from the first state through the whole of ``text``, which ends there."""
        if self.plain(text):
            return sum(map(self._pieces.__getitem__, self.pieces(text)))
        total = 0
        for part, special in self.parts(text):
            total += 1 if special is not None else sum(map(self._run, self.library_pieces(part))) if part else 0
        return total

    def state_map(self, chunk: str) -> "StateMap":
        first = _RESET.search(chunk)
        if first is None:
            return StateMap(chunk, False, 0, "")
        a = first.start()
        z = max(chunk.rfind(c) for c in " \t\n\r")
        return StateMap(chunk[:a], True, self.count(chunk[a:z]), chunk[z + 1 :])

    def compose(self, a: "StateMap", b: "StateMap") -> "StateMap":
        """What ``a`` and then ``b`` do; associative."""
        if not a.resets:
            return StateMap(a.head + b.head, b.resets, b.tokens, b.tail)
        if not b.resets:
            return StateMap(a.head, True, a.tokens, a.tail + b.head)
        return StateMap(a.head, True, a.tokens + self.count(a.tail + b.head) + b.tokens, b.tail)

    def fold(self, maps: list["StateMap"]) -> int:
        """Tokens of a text from the maps of its chunks in order, composed pairwise level by level."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        if not maps:
            return 0
        m = maps[0]
        return self.count(m.head) + m.tokens + (self.count(m.tail) if m.resets else 0)


class StateMap(NamedTuple):
    """``head`` runs on from the entry state; if the chunk resets, ``tokens`` follow and ``tail`` leads to the exit state."""

    head: str
    resets: bool
    tokens: int
    tail: str


_ALPHABET = byte_alphabet()


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one for each row of ``docs``.

    Null texts count as empty: no bytes, no tokens. Ids may be null or repeat, further columns
    are ignored, an empty table gives no rows. Texts of one chunk are counted where they are
    read; chunks of longer texts are dealt out, and only their state maps meet again.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    chars = F.char_length("text")
    pieces = F.expr(
        f"flatten(transform(sequence(0, greatest(char_length(text) - 1, 0) div {_BLOCK_CHARS}), b -> transform("
        f"sequence(0, greatest(least(char_length(text) - b * {_BLOCK_CHARS}, {_BLOCK_CHARS}) - 1, 0) div {CHUNK_CHARS}), "
        f"c -> struct(cast(b as long) * {_BLOCK_CHARS // CHUNK_CHARS} + c as no, "
        f"substring(substring(text, b * {_BLOCK_CHARS} + 1, {_BLOCK_CHARS}), c * {CHUNK_CHARS} + 1, {CHUNK_CHARS}) as chunk))))"
    )
    whole = base.filter(chars <= CHUNK_CHARS).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = whole.mapInArrow(_count_texts(tokenizer_path), "doc_id long, n_bytes long, n_tokens long")
    cut = base.filter(chars > CHUNK_CHARS).select(
        "doc_id", F.xxhash64("text").alias("row_hash"), F.octet_length("text").cast("long").alias("n_bytes"), F.explode(pieces).alias("c")
    )
    dealt = cut.select("doc_id", "row_hash", "n_bytes", "c.no", "c.chunk").repartition(F.xxhash64("doc_id", "row_hash", "no"))
    maps = dealt.mapInArrow(
        _map_chunks(tokenizer_path), "doc_id long, row_hash long, n_bytes long, no long, head string, resets boolean, tokens long, tail string"
    )
    together = (
        maps.groupBy("doc_id", "row_hash", "n_bytes")
        .agg(F.array_sort(F.collect_set(F.struct("no", "head", "resets", "tokens", "tail"))).alias("maps"), F.count_if(F.col("no") == 0).alias("copies"))
    )
    folded = together.mapInArrow(_fold_maps(tokenizer_path), "doc_id long, n_bytes long, n_tokens long")
    return counted.unionByName(folded).withColumn("over_limit", F.col("n_tokens") > limit)


def _count_texts(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = None
        for batch in batches:
            machine = machine or CountTransducer(path)
            n = [machine.fold([machine.state_map(t.as_py())]) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return work


def _map_chunks(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = None
        for batch in batches:
            machine = machine or CountTransducer(path)
            maps = [machine.state_map(t.as_py()) for t in batch["chunk"]]
            columns = [pa.array([m[k] for m in maps], t) for k, t in enumerate((pa.string(), pa.bool_(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch[c] for c in ("doc_id", "row_hash", "n_bytes", "no")] + columns, ["doc_id", "row_hash", "n_bytes", "no", "head", "resets", "tokens", "tail"])

    return work


def _fold_maps(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = None
        for batch in batches:
            machine = machine or CountTransducer(path)
            out: list[tuple[int | None, int, int]] = []
            for doc_id, n_bytes, maps, copies in zip(*(batch[c].to_pylist() for c in ("doc_id", "n_bytes", "maps", "copies")), strict=True):
                n = machine.fold([StateMap(m["head"], m["resets"], m["tokens"], m["tail"]) for m in maps])
                out += [(doc_id, n_bytes, n)] * copies
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["doc_id", "n_bytes", "n_tokens"])

    return work
