"""Ranked search against scores of all documents by brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from slowtide.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    big_n, big_l = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in wanted.items():
        scores = []
        for i, b in bags:
            m = 10 + (90 * sum(b.values()) * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in own if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string").repartition(5)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in search.search(d, q, **options).collect()), key=str)


def corpus(rng, n):
    words = [f"{rng.choice(['W', 'w', 'é', '中文', 'Ü'])}{k}" for k in range(300)]
    chance = [1 / (k + 1) for k in range(300)]
    text = lambda m: rng.choice([" ", "_", "\n", " -"]).join(rng.choices(words, chance, k=m))
    return [(i, text(rng.randint(0, 60))) for i in range(n)], [(i, text(rng.randint(0, 25))) for i in range(20)]


@pytest.mark.parametrize("options", [{"k": 10}, {"k": 3, "block_pairs": 40}, {"k": 1000}])
def test_ranks_equal_scores_of_all_documents(spark, options):
    docs, items = corpus(random.Random(1), 500)
    assert found(spark, docs, items, **options) == brute(docs, items, options["k"])


def test_ties_repeats_nulls_and_empty_texts(spark):
    docs = [(k % 7, "blue moon") for k in range(30)] + [(None, "blue moon"), (99, None), (100, ""), (101, " ,;\x00 "), (102, "BLUE"), (103, "x" * 50)]
    docs += [(200 + k, "filler words") for k in range(80)] + [(300, "Moon " * 100_000)]
    items = [(1, "Moon, blue"), (1, "moon"), (2, None), (3, "..."), (None, "blue"), (4, "absent"), (5, "moon moon MOON")]
    assert found(spark, docs, items, k=10) == brute(docs, items, 10)
    assert found(spark, docs, items, k=50) == brute(docs, items, 50)


def test_empty_tables_give_no_rows(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == [] and found(spark, [(1, None)], [(1, "a"), (2, None)]) == []


def test_a_word_in_all_documents_weighs_little_but_counts(spark):
    docs = [(k, "every") for k in range(40)]
    assert found(spark, docs, [(1, "every")], k=5) == brute(docs, [(1, "every")], 5)


def weights_of(documents, length, pairs, phase):
    """Weights of a block with the pairs (item, term, weight, most)."""
    pairs = sorted(pairs, key=lambda p: p[1])
    item, term, weight, most = (np.array(c, dtype=np.int64) for c in zip(*pairs, strict=True))
    phase = np.array(phase)
    adds = np.zeros((phase.max() + 1, item.max() + 1), dtype=np.int64)
    np.add.at(adds, (phase[term], item), most)
    return search.Weights(documents, length, item, weight, np.searchsorted(term, np.arange(len(phase) + 1)), phase, adds.sum(axis=0) - np.cumsum(adds, axis=0))


def test_accumulators_stop_but_go_on_being_updated():
    # Item 0 has the rare term 0 and the frequent term 1; item 1 the frequent one alone.
    weights = weights_of(10, 100, [(0, 0, 50, 500), (0, 1, 2, 20), (1, 1, 2, 20)], [0, 1])
    doc, term, part = np.array([0, 0, 1, 2]), np.array([0, 1, 1, 0]), np.array([10, 7, 9, 1])
    run = lambda phases, stop, floor: {(d, i): s for d, i, s in zip(*search.accumulate(weights, phases, np.array(stop), np.array(floor), doc, term, part, 3), strict=True)}
    assert run(1, [2, 2], [0, 0]) == {(0, 0): 500, (2, 0): 50}
    assert run(2, [2, 2], [0, 0]) == {(0, 0): 514, (1, 0): 18, (2, 0): 50, (0, 1): 14, (1, 1): 18}
    # Item 0 adds none after phase 0, so document 1 gets no accumulator and document 0 its frequent term all the same.
    assert run(2, [0, 2], [0, 0]) == {(0, 0): 514, (2, 0): 50, (0, 1): 14, (1, 1): 18}
    # 50 and at most 20 more cannot reach 500, so document 2 leaves.
    assert run(2, [0, 2], [500, 0]) == {(0, 0): 514, (0, 1): 14, (1, 1): 18}


def test_very_long_documents_do_not_overflow():
    weights = search.Weights(10**12, 10**14, *[np.zeros(0, np.int64)] * 5)
    assert weights.dampened(np.array([3]), np.array([10**8])).tolist() == [3 * 10**9 // (3000 + 8 * (10 + 90 * 10**8 * 10**12 // 10**14))]
