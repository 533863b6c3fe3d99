"""Runs of words against a plain search over all periods, and the query's digests against a plain version."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from slowtide.llm import periodic
from slowtide.llm.catalog import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(words, exponent=4, least=6):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            own = words[start : start + length]
            smallest = not any(all(own[k] == own[k - p] for k in range(p, length)) for p in range(1, q))
            if length >= max(least, exponent * q) and smallest:
                out.append((start, length, q))
            i = j
    return sorted(out)


def collapse(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def random_words(rng):
    n, letters = rng.randint(0, 60), rng.randint(1, 4)
    words = [rng.choice("abcdé"[:letters]) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, 8)
        words = [words[a + (i - a) % p] if i >= a and a + (i - a) % p < n else words[i] for i in range(n)]
    return words


@pytest.mark.parametrize(("exponent", "least"), [(4, 6), (2, 1), (3, 10)])
def test_runs_equal_a_search_over_all_periods(exponent, least):
    rng = random.Random(exponent)
    for _ in range(700):
        docs = [random_words(rng) for _ in range(3)]
        flat = pa.array([w for d in docs for w in d], pa.string())
        found = periodic.find_runs(flat, np.cumsum([0] + [len(d) for d in docs]), exponent, least)
        for k, words in enumerate(docs):
            assert found.get(k, []) == brute(words, exponent, least)


def test_every_run_of_two_periods_closes_a_square():
    rng = random.Random(9)
    for _ in range(500):
        words = random_words(rng)
        ids = [ord(w) for w in words]
        closed = set(periodic.squares(ids))
        for end, q in closed:
            assert ids[end - q + 1 : end + 1] == ids[end - 2 * q + 1 : end - q + 1]
        for start, _, q in brute(words, 2, 1):
            assert (start + 2 * q - 1, q) in closed


def test_nulls_empty_repeats_and_clashing_names(spark):
    text = " x\ty z  y z\ny z y z "
    rows = [(1, text, "a"), (1, text, "a"), (None, "a " * 7, "b"), (3, None, None), (4, "", "c"), (5, " \n", "d")]
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string"))
    assert got.columns == ["doc_id", "text", "runs_input", "n_words", "runs", "collapsed"]
    found = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.runs_input or "") for r in got.collect())
    assert found == [
        (0, 7, [(0, 7, 1)], "a", "b"),
        (1, 9, [(1, 8, 2)], "x y z", "a"),
        (1, 9, [(1, 8, 2)], "x y z", "a"),
        (3, 0, [], "", ""),
        (4, 0, [], "", "c"),
        (5, 0, [], "", "d"),
    ]
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        periodic.periodic_runs(got.select("doc_id", "text"), exponent=1)


def test_long_text_with_nested_and_wide_periods(spark):
    rng = random.Random(2)
    wide = [str(rng.randint(0, 10**6)) for _ in range(30_000)]
    words = [*wide * 5, *["same"] * 50_000, "end"]
    got = periodic.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [tuple(r) for r in got.runs] == [(0, 150_000, 30_000), (150_000, 50_000, 1)]
    assert got.collapsed == " ".join([*wide, "same", "end"])


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapse(words, runs)))


def test_query_equals_a_plain_version(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(random_words(rng)) + rng.choice(["", "\n", " q q q q q q"])) for i in range(400)]
    rows += [(None, "a b a b a b a b"), (7, None), (7, ""), (-3, "é " * 6), (11, " ".join(f"w{k % 90}" for k in range(400)))]
    pq.write_table(pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]}), tmp_path / "documents.parquet")
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted((expected(*r) for r in rows), key=key)
