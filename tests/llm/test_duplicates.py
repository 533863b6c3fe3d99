from __future__ import annotations

import math
import random
import re

import numpy as np

from slowtide.llm import components, jaccard, neardup, substrings
from slowtide.llm.common import BitFilter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def planted(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)

    def words(n: int) -> list[str]:
        return ["".join(rng.choice("abcde") for _ in range(5)) for _ in range(n)]

    base, passage, rows = words(300), words(60), []
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 12)):
            copy[rng.randrange(len(copy))] = words(1)[0]
        rows.append(" ".join(copy).upper() if rng.random() < 0.3 else "\t".join(copy))
    for k in range(40):
        own = words(rng.randint(1, 120))
        rows.append(" ".join(own + (passage if k % 3 == 0 else []) + words(5)))
    rows += ["", None, "one", "one two", "ONE two", "a b c d", " \n ", rows[0], rows[70], "z" * 30_000 + " y"]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    out = list(zip(ids, rows, strict=True))
    return out + [out[3], (None, "free " + " ".join(passage))]


def groups(n: int, links: list[tuple[int, int]]) -> list[int]:
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def test_jaccard_equals_brute_force(spark, make):
    rows = planted()
    for num, words in ((90, 3), (80, 5)):
        sets = []
        for _, t in rows:
            w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
            sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
        links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
        of = groups(len(rows), links)
        least: dict = {}
        for (i, _), g in zip(rows, of, strict=True):
            if i is not None:
                least[g] = min(least.get(g, i), i)
        want = sorted((-1 if i is None else i, len(s), -1 if (c := least.get(g)) is None else c) for (i, _), s, g in zip(rows, sets, of, strict=True))
        for bits in (6, 25):  # a filter that lets everything pass changes nothing
            got = jaccard.jaccard_components(make(rows), num, 100, words, filter_bits=bits).collect()
            assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == want
    assert jaccard.jaccard_components(make([])).count() == 0


def test_points_keep_small_and_large_counts():
    rng = np.random.default_rng(5)
    counts = np.stack([rng.integers(0, most, jaccard.GROUPS) for most in (2, 256, 257, 100_000)])
    counts[1, 0], counts[2, 0] = 255, 256
    packed = [jaccard.point_bytes(c) for c in counts]
    assert [len(p) // jaccard.GROUPS for p in packed] == [1, 1, 4, 4]
    assert (jaccard.point_counts(packed) == counts).all()


def test_tree_join_drops_no_pair_that_reaches_the_overlap():
    rng = np.random.default_rng(2)
    threshold = jaccard.Threshold(80, 100)
    a, b = (rng.poisson(1.0, size=(n, 256)).astype(np.uint32) for n in (70, 45))
    b[:20] = a[:20]
    sa, sb = a.sum(axis=1).astype(np.int64), b.sum(axis=1).astype(np.int64)
    x, y = jaccard.tree_join(jaccard.Tree(a, sa), jaccard.Tree(b, sb), threshold)
    want = {(i, j) for i in range(70) for j in range(45) if np.minimum(a[i], b[j]).sum() >= threshold.least_overlap(sa[i] + sb[j])}
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == want and len(want) >= 20


def test_repeats_equal_brute_force(spark, make):
    rows = planted(7)
    for window in (50, 8):
        first: dict = {}
        for i, t in rows:
            w = WORD.findall(t or "")
            for k in range(len(w) - window + 1):
                if i is not None:
                    first[tuple(w[k : k + window])] = min(first.get(tuple(w[k : k + window]), i), i)
        want = []
        for i, t in rows:
            w = WORD.findall(t or "")
            gone = {p for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k : k + window])] < i for p in range(k, k + window)}
            want.append((-1 if i is None else i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
        for bits in (6, 25):
            got = substrings.remove_repeats(make(rows), ["n_words", "n_removed", "kept", "spans"], window, filter_bits=bits).collect()
            assert sorted((-1 if r[0] is None else r[0], *r[1:4]) for r in got) == sorted(want)
            assert all(sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_removed"] for r in got)
    assert substrings.remove_repeats(make([]), ["kept"]).count() == 0
    assert substrings.remove_repeats(make([(1, "a"), (2, "b")]), ["n_removed"]).collect()[0]["n_removed"] == 0


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 64))
    vectors = np.concatenate([base[k] + rng.normal(scale=0.2, size=(1 + 4 * (k % 6), 64)) for k in range(40)])
    rows = [(int(k), [float(x) for x in v]) for k, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, rows[3][1]), (n + 1, [x * 7 for x in rows[3][1]]), (n + 2, rows[5][1])]
    clean = len(rows)
    rows += [(n + 10, None), (n + 11, []), (n + 12, [0.0] * 64), (n + 13, [math.nan] * 64), (n + 14, [math.inf] + [1.0] * 63), (n + 15, [None] * 64), (n + 16, [1.0, 2.0]), (None, rows[3][1])]
    unit = np.array([r[1] for r in rows[:clean]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    of = groups(clean, list(zip(*map(list, np.nonzero(near)), strict=True)))
    want = {r[0]: (int(near[k].sum()), of[k], of[k] == k) for k, r in enumerate(rows[:clean])}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()}
    assert len(got) == len(rows) and {k: got[k] for k in want} == want and near.sum() > 500
    assert all(got[k] == (0, k, True) for k in range(n + 10, n + 17)) and got[None] == (0, None, False)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_points_of_different_widths_bound_the_overlap():
    rng = np.random.default_rng(8)
    whole = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    one_group = np.arange(600, dtype=np.uint64) << np.uint64(8)
    sets = [whole[:n] for n in (1, 9, 128, 129, 700, 3000)] + [np.sort(np.concatenate([one_group, whole[:100]])), whole[50:200]]
    points = [jaccard.group_counts(s) for s in sets]
    assert len({len(p) for p in points}) > 3 and all(p.sum() == len(s) for p, s in zip(points, sets, strict=True))
    for x, p in zip(sets, points, strict=True):
        for y, q in zip(sets, points, strict=True):
            both = jaccard.point_counts([jaccard.point_bytes(p), jaccard.point_bytes(q)])
            assert both[0].sum() == len(x) and np.minimum(*both).sum() >= len(np.intersect1d(x, y))


def test_linked_sets_share_the_cells_that_are_asked_for():
    rng = np.random.default_rng(12)
    filters = [BitFilter(8, np.zeros(4, dtype=np.uint64)), BitFilter(8, rng.integers(0, 1 << 63, 4).astype(np.uint64) | rng.integers(0, 1 << 63, 4).astype(np.uint64))]
    for num in (10, 50, 80, 90, 100):
        threshold = jaccard.Threshold(num, 100)
        linked = 0
        for _ in range(600):
            n = int(rng.integers(1, 160))
            base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            out = rng.random(len(base)) < rng.random() * (1 - num / 100) * 1.2
            more = rng.integers(0, 1 << 63, int(rng.integers(0, 1 + len(base) * (100 - num) // 100))).astype(np.uint64)
            other = np.unique(np.concatenate([base[~out], more]))
            if not len(other) or not threshold.linked(base, other):
                continue
            linked += 1
            for frequent in filters:
                both = len(np.intersect1d(threshold.cells(base, frequent), threshold.cells(other, frequent)))
                for x in (base, other):
                    assert both >= threshold.shared(threshold.kept(len(x))) >= 1
        assert linked > 100


def test_every_link_is_counted(spark, make, monkeypatch):
    monkeypatch.setattr(jaccard, "PART_SETS", 16)
    rng = random.Random(9)
    rows = planted() + [(900 + k, " ".join(f"t{rng.randint(0, 3) if p % 97 == 0 else p}" for p in range(400))) for k in range(80)]
    rows += [rows[20], (None, rows[5][1]), (None, rows[5][1]), (990, "one pair only of words here"), (991, "ONE pair only of words here"), (992, "one pair only of words here x")]
    docs: dict = {}
    for k, (i, t) in enumerate(rows):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        s = frozenset(tuple(w[p : p + 5]) for p in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())
        docs.setdefault(s, set()).add((None, k) if i is None else i)
    links = {s: sum(len(docs[o]) for o in docs if s and 100 * len(s & o) >= 80 * len(s | o)) for s in docs}
    want = {(-1 if isinstance(i, tuple) else i, len(s), max(links[s] - 1, 0)) for s, ids in docs.items() for i in ids}
    got = jaccard.jaccard_join(make(rows), 80, 100, 5).collect()
    assert {(-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], r["n_links"]) for r in got} == want and len(got) == len(rows)
    assert max(n for _, _, n in want) == 79
    assert jaccard.jaccard_join(make([])).count() == 0


def test_overlaps_of_blocks(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 32)
    rng = np.random.default_rng(4)
    left, right = ([np.unique(rng.integers(0, 400, n).astype(np.uint64)) for n in rng.integers(1, 200, m)] for m in (17, 9))
    right.append(np.array([1 << 63], dtype=np.uint64))
    assert (jaccard.overlaps(left, right) == [[len(np.intersect1d(x, y)) for y in right] for x in left]).all()
    assert (jaccard.overlaps(left, right[-1:]) == 0).all()


def test_plan_follows_width_and_cosine():
    assert neardup.plan(2000, 64)[0] in (7, 8, 9) and neardup.plan(1, 1)[0] >= 1
    for dims, cosine in ((64, 0.9), (256, 0.9), (64, 0.8)):
        tables, rotations = neardup.plan(1000, dims, cosine)
        rng = np.random.default_rng(21)
        a = neardup.unit_rows(rng.normal(size=(1000, dims)))
        side = rng.normal(size=a.shape)
        side = neardup.unit_rows(side - (side * a).sum(axis=1, keepdims=True) * a)
        machine = neardup.CrossPolytope(dims, tables, rotations)
        x, y = machine.buckets(a), machine.buckets(cosine * a + np.sqrt(1 - cosine**2) * side)
        found = ((x == y[:, :, :1]) | (y == x[:, :, :1])).any(axis=(1, 2))
        assert (~found).sum() <= 5
    assert neardup.plan(1000, 256)[0] > neardup.plan(1000, 64)[0] and neardup.plan(1000, 64, 0.8)[0] > neardup.plan(1000, 64)[0]


def test_cells_that_stay_join_every_linked_pair():
    rng = np.random.default_rng(4)
    none, every = (BitFilter(6, np.full(1, x, dtype=np.uint64)) for x in (0, (1 << 64) - 1))
    for num, size in ((90, 240), (80, 60), (50, 9)):
        threshold = jaccard.Threshold(num, 100)
        base = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        crowded = BitFilter(16, rng.integers(0, 1 << 63, 1 << 10, dtype=np.uint64) & rng.integers(0, 1 << 63, 1 << 10, dtype=np.uint64))
        sets = []
        for _ in range(40):
            gone = rng.random(len(base)) < rng.uniform(0, 1.2 * (1 - num / 100) / 2)
            sets.append(np.unique(np.concatenate([base[~gone], rng.integers(0, 1 << 63, gone.sum(), dtype=np.uint64)])))
        known, held = np.unique(np.concatenate(sets), return_counts=True)
        several = set(known[held > 1].tolist())
        linked = 0
        for seen in (none, every, crowded):
            cells = []
            for s in sets:
                own = threshold.cells(s, none)
                own = own[[c in several for c in own.tolist()]]
                cells.append(set(threshold.stayed(len(s), own, seen).tolist()))
                assert len(cells[-1]) == max(0, len(own) - threshold.shared(threshold.kept(len(s))) + 1)
            for i in range(len(sets)):
                for j in range(i):
                    if threshold.linked(sets[i], sets[j]):
                        linked += 1
                        assert cells[i] & cells[j]
        assert linked > 100


def test_members_of_meetings_are_fewer_than_cells_of_sets(spark, make, monkeypatch):
    """One template in many documents: each stands in fewer cells than it has in common with others."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(240)]
    rows = []
    for k in range(120):
        copy = list(base)
        for at in rng.sample(range(240), 6):
            copy[at] = f"own{k}x{at}"
        rows.append((k, " ".join(copy)))
    held = []
    monkeypatch.setattr(jaccard, "stored", lambda df, label, stored=jaccard.stored: held.append((label, stored(df, label))) or held[-1][1])
    out = jaccard.jaccard_components(make(rows), 90, 100, 3)
    assert out.count() == 120
    seen = dict(held)
    threshold = jaccard.Threshold(90, 100)
    cells = [(r["n_shingles"], len(r["cells"])) for r in seen["jaccard-sets"].collect()]
    assert cells and all(c <= n - threshold.kept(n) + threshold.shared(n) - threshold.shared(threshold.kept(n)) + 1 for n, c in cells)


def test_rounds_of_components_write_as_many_files_as_links_need(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(components, "stored", lambda df, label, stored=components.stored: tables.append(stored(df, label)) or tables[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = spark.createDataFrame([(k, k + 1) for k in range(60) if k != 30] + [(7, 7), (None, 3)], "a long, b long")
        got = {tuple(r) for r in components.components(links).collect()}
        assert got == {(k, 0 if k <= 30 else 31) for k in range(61)}
        assert len(tables) > 2 and all(len(t.inputFiles()) == 1 for t in tables[1:])
        assert components.components(links.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_tasks_hold_no_table_of_their_cells(spark, make, monkeypatch):
    """What a task keeps of its documents' cells does not grow with them: a portion is summed up and handed on."""
    cells = [np.array(c, dtype=np.uint64) for c in ([9, 1 << 63, 4], [4], [4, 9, 7])]
    got = jaccard._cell_rows(cells, [5, -3, 8]).to_pylist()
    assert [tuple(r.values()) for r in got] == [(-(1 << 63), 5, 5, 1), (4, -3, 8, 3), (7, 8, 8, 1), (9, 5, 8, 2)]
    plans = {}
    monkeypatch.setattr(jaccard, "stored", lambda df, label, stored=jaccard.stored: plans.update({label: df._jdf.queryExecution().executedPlan().toString()}) or stored(df, label))
    rows = [(k, f"a b c d e f g{k // 2}") for k in range(8)]
    assert jaccard.jaccard_components(make(rows)).groupBy("component_id").count().collect()
    tasks = plans["jaccard-cells"].split("Exchange")
    assert len(tasks) == 2 and "Aggregate" in tasks[0] and "Aggregate" not in tasks[1]


def test_vectors_of_many_regions_blocks_and_rounds(spark, monkeypatch):
    """Each vector is dealt to its few nearest corners, worked out once; regions, blocks and rounds change no link."""
    held = {}
    monkeypatch.setattr(neardup, "stored", lambda df, label, stored=neardup.stored, **options: held.setdefault(label, []).append(stored(df, label, **options)) or held[label][-1])
    for name, value in {"BLOCK": 64, "LEAST_BLOCK": 16, "LEAST_ROUND": 1, "GATHER_BYTES": 1 << 15, "ROW_BYTES": 1 << 11, "TILE": (16, 32)}.items():
        monkeypatch.setattr(neardup, name, value)
    rng = np.random.default_rng(17)
    base = rng.normal(size=(90, 64))
    vectors = np.concatenate([base[k] + rng.normal(scale=0.25, size=(150 if k == 0 else 1 + 3 * (k % 5), 64)) for k in range(90)]).astype(np.float32)
    short = (rng.normal(size=(30, 1, 8)) + rng.normal(scale=0.2, size=(30, 4, 8))).reshape(-1, 8).astype(np.float32)
    rows, want, first = [], {}, 0
    for part in (vectors, short):
        unit = part.astype(float) / np.linalg.norm(part.astype(float), axis=1, keepdims=True)
        near = unit @ unit.T >= 0.9
        np.fill_diagonal(near, False)
        of = groups(len(part), list(zip(*map(list, np.nonzero(near)), strict=True)))
        want |= {first + k: (int(near[k].sum()), first + of[k], of[k] == k) for k in range(len(part))}
        rows += [(first + k, v.tolist()) for k, v in enumerate(part)]
        first += len(part)
    again = [rows[k] for k in (0, 0, 7, first - 1)]
    for kind in ("float", "double"):
        held.clear()
        found = neardup.near_duplicates(spark.createDataFrame(rows + again, f"vec_id long, embedding array<{kind}>")).collect()
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
        assert len(found) == len(rows) + len(again) and sum(got[k] != want[k] for k in want) <= 2 and max(n for n, _, _ in got.values()) > 100
        rotations, most = neardup.layout(len(vectors), 64, 0.9)
        codes = held["vector-classes"][0].filter("code >= 64 * shiftleft(1L, 32)")
        assert rotations and len(held["vector-links"]) > 1 and codes.agg({"n": "sum"}).first()[0] == most * len(vectors)
        assert most < sum(neardup.plan(len(vectors), 64))


def test_layout_of_regions_misses_few_pairs():
    for n, dims, cosine in ((50_000, 64, 0.9), (3_000_000, 64, 0.9), (50_000, 256, 0.9), (50_000, 64, 0.8), (9000, 8, 0.9)):
        rotations, near = neardup.layout(n, dims, cosine)
        rng = np.random.default_rng(23)
        a = neardup.unit_rows(rng.normal(size=(4000, dims)))
        side = rng.normal(size=a.shape)
        side = neardup.unit_rows(side - (side * a).sum(axis=1, keepdims=True) * a)
        machine = neardup.CrossPolytope(dims, 1, rotations)
        x, y = (machine.nearest(v.astype(np.float32), near) for v in (a, cosine * a + np.sqrt(1 - cosine**2) * side))
        assert rotations and (~(x[:, :, None] == y[:, None, :]).any(axis=(1, 2))).sum() <= 8
    # Few vectors, or a cosine that no region narrows down, meet all.
    assert neardup.layout(5000, 64, 0.9) == neardup.layout(10**6, 64, 0.0) == (0, 1)


def test_nearest_corners_are_the_nearest():
    rng = np.random.default_rng(29)
    for dims, rotations, near in ((64, 50, 10), (64, 3, 7), (100, 9, 5), (8, 3, 3)):
        machine = neardup.CrossPolytope(dims, 1, rotations)
        vectors = neardup.unit_rows(rng.normal(size=(300, dims)))
        one = np.stack([machine.corners(vectors, 0, r)[:, 0] + r * 2 * machine.width for r in range(rotations)], axis=1)
        got = machine.nearest(vectors.astype(np.float32), near)
        assert all(len(set(g)) == near and g[0] in o for g, o in zip(got.tolist(), one.tolist(), strict=True))
        sizes = np.abs(np.take_along_axis(vectors @ machine.directions, got // 2, axis=1))
        rest = np.sort(np.abs(vectors @ machine.directions), axis=1)[:, -near:][:, ::-1]
        assert np.allclose(sizes, rest, atol=1e-6)
