"""Operator 13 against brute force, and its trees against all pairs."""

import math

import numpy as np
import pytest

from biblioforge.llm import hard_negatives as H

DDL = "vec_id long, embedding array<float>, label int, rank string, q int, cell string"


def brute(rows, every=100, positives=5, negatives=10):
    seen = {}
    for i, v, l in rows:
        if i is None or l is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        l = (l + 1) % 10 if i % 7 == 0 else l
        seen[(i, l, tuple(math.floor(256 * float(np.float32(x))) for x in v))] = True
    kept = sorted(seen)
    anchors = {}
    for r in kept:
        if r[0] % every == 0:
            anchors.setdefault(r[0], r)
    out = []
    for a in anchors.values():
        scored = [(-sum(x * y for x, y in zip(a[2], c[2], strict=True)), c[0], c[1] == a[1]) for c in kept if c[0] != a[0]]
        for ps, pid, _ in sorted(x for x in scored if x[2])[:positives]:
            window = [(s, i) for s, i, same in scored if not same and 30 * -ps <= 100 * -s <= 90 * -ps]
            out += [(a[0], pid, n, i, -ps, -s) for n, (s, i) in enumerate(sorted(window)[:negatives], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 1, "y") for i, v, l in rows], DDL)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("seed,grid,slice_bytes", [(1, 0, 1 << 23), (2, 3, 1 << 23), (3, 0, 8 * 16 * 3), (4, 2, 8 * 16 * 5)])
def test_equals_brute_force(spark, monkeypatch, seed, grid, slice_bytes):
    """A coarse grid gives ties and copies; small slices and blocks give many passes and trees."""
    monkeypatch.setattr(H, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(H, "BLOCK_BYTES", slice_bytes)
    r = np.random.default_rng(seed)
    x = r.normal(size=(900, 16)) / 3 + 0.2
    if grid:
        x = np.round(x * grid) / grid
        x[300:600] = x[5]  # a third of all rows is one vector
    rows = [(int(i), [float(np.float32(v)) for v in x[i]], int(r.integers(0, 4))) for i in r.permutation(900)]
    want = brute(rows, every=50)
    assert want and got(H.hard_negatives(table(spark, rows).repartition(3), every=50)) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(9)
    fine = [(i * 20, [float(np.float32(v)) for v in r.normal(size=8) + 0.5], i % 3) for i in range(40)]
    odd = [(100, None, 1), (200, [], 1), (300, [nan] * 8, 1), (400, [inf] + [0.0] * 7, 0), (500, [None] + [0.0] * 7, 0), (None, [1.0] * 8, 0), (600, [1.0] * 8, None)]
    more = [fine[5], fine[5], (100, [0.5] * 8, 2), (20, [0.25] * 8, 0), (0, [-1.0] * 8, 1), (-100, [0.75] * 8, -3)]  # repeats, ids on two vectors
    assert got(H.hard_negatives(table(spark, odd + fine + more))) == brute(odd + fine + more)
    assert got(H.hard_negatives(table(spark, []))) == got(H.hard_negatives(table(spark, odd))) == got(H.hard_negatives(table(spark, fine[1:5]))) == []
    with pytest.raises(Exception, match="must be below"):
        H.hard_negatives(table(spark, [(1, [1e7] * 8, 1)])).collect()


def test_trees_prune_groups():
    """Well-separated clusters: most node pairs fall at once, and no wanted pair is lost."""
    r = np.random.default_rng(3)
    centres = 200 * r.normal(size=(12, 16))
    a, c = (np.round(centres[np.arange(n) % 12] + r.normal(size=(n, 16))) for n in (240, 6000))
    ta, tc = H.BallTree(a, np.arange(240), np.zeros(240, np.int64), 16), H.BallTree(c, np.arange(6000), np.zeros(6000, np.int64), 32)
    assert sorted(ta.order) == list(range(240)) and (ta.q == a[ta.order]).all()
    exact = ta.q @ tc.q.T
    floor = np.sort(exact, 1)[:, -5]
    least = ta.over_nodes(floor, np.minimum, np.inf)
    assert all(least[n] == floor[s:e].min() for n, (s, e) in enumerate(zip(ta.start, ta.stop)))
    i, j, looked = H.leaf_pairs(ta, tc, lambda i, j, low, high: high >= least[i])
    seen = np.zeros(exact.shape, bool)
    for x, y in zip(i, j):
        seen[ta.start[x] : ta.stop[x], tc.start[y] : tc.stop[y]] = True
    assert seen[exact >= floor[:, None]].all() and seen.mean() < 0.2
    assert looked < 0.5 * len(ta.start) * len(tc.start)
