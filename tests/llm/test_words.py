"""Hashes of words and runs, on words that sums of positions cannot tell apart."""

from __future__ import annotations

import random

import numpy as np
import pytest

from slowtide.llm import jaccard, substrings
from slowtide.llm.words import Hasher


def hashes(text, lower=False):
    data = np.frombuffer(text.encode(), np.uint8)
    return Hasher(lower).words(data, np.array([0, len(data)]))[0]


def thue_morse(n, letters="ab"):
    return [letters[k.bit_count() & 1] for k in range(n)]


@pytest.mark.parametrize("n", [4, 8, 63, 64, 65, 1024, 4096])
def test_complementary_words_differ(n):
    a, b = hashes(f"{''.join(thue_morse(n))} {''.join(thue_morse(n, 'ba'))}")
    assert a != b


def test_distinct_words_get_distinct_hashes_and_equal_ones_the_same():
    rng = random.Random(1)
    words = list({"".join(rng.choices("abcé", k=rng.randint(1, 90))) for _ in range(20_000)})
    found = hashes("\t".join(words))
    assert len(set(found.tolist())) == len(found) == len(words)
    assert hashes("\n ".join(words)).tolist() == found.tolist()
    assert hashes("ABé aBÉ", lower=True).tolist()[0] == hashes("abé")[0] != hashes("abÉ")[0]


def test_runs_depend_on_every_word_and_the_order():
    seq = thue_morse(2048) + thue_morse(2048, "ba") + thue_morse(2048)
    runs = Hasher().runs(hashes(" ".join(seq)))
    for n in (1, 2, 3, 5, 50, 1000, 2048):
        a, b, c = runs.at(np.array([0, 2048, 4096]), n)
        assert a == c != b
    every = runs.at(np.arange(len(seq) - 6), 7)
    assert len(set(every.tolist())) == len({tuple(seq[k : k + 7]) for k in range(len(seq) - 6)})


def test_such_words_are_neither_linked_nor_removed(spark, make):
    a, b = "".join(thue_morse(1024)), "".join(thue_morse(1024, "ba"))
    rest = [f"w{k}" for k in range(49)]
    docs = make([(1, a), (2, b), (3, " ".join([a, *rest])), (4, " ".join([b, *rest])), (5, " ".join([b, *rest]))])
    links = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in jaccard.jaccard_join(docs, num=99, den=100, words=3).collect()}
    assert links == {1: (1, 0), 2: (2, 0), 3: (3, 0), 4: (4, 1), 5: (4, 1)}
    removed = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(docs, ["n_removed"]).collect()}
    assert removed == {1: 0, 2: 0, 3: 0, 4: 0, 5: 50}
