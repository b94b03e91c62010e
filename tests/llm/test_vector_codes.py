"""Operator 11 against plain integer Lloyd rounds, ties and odd rows included."""

import hashlib
import math

import numpy as np
import pytest

from biblioforge.llm import vector_codes as V
from biblioforge.llm.common import Scratch

DDL = "vec_id long, embedding array<float>, label int, code string, q int, seen string"


def lloyd(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows: (vec_id, vector, label) -> {(vec_id, vector): (code, error, label_error)}, digest; in plain Python."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], l) for i, v, l in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    d = len(kept[0][1]) // parts
    cut = [[r[1][p * d : (p + 1) * d] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [[min((dist(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, a in zip(cut, own, strict=True) if a[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    own = assign()
    errors = {}
    for r, a in zip(kept, own, strict=True):
        errors[r[2]] = errors.get(r[2], 0) + sum(x for x, _ in a)
    digest = hashlib.sha256(",".join(str(x) for p in range(parts) for e in books[p] for x in e).encode()).hexdigest()
    return sorted(((r[0], r[2], "".join(f"{k:02x}" for _, k in a), sum(x for x, _ in a), errors[r[2]]) for r, a in zip(kept, own, strict=True)), key=repr), digest


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 1, "y") for i, v, l in rows], DDL)


def got(df):
    rows = df.collect()
    assert df.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(((r.vec_id, r.label, r.code, r.error, r.label_error) for r in rows), key=repr), {r.codebooks_sha256 for r in rows}


@pytest.mark.parametrize("seed,grid", [(1, 0), (2, 0), (3, 4), (4, 2)])
def test_equals_plain_lloyd(spark, seed, grid):
    """A coarse grid gives many equal distances, copies and entries without parts."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(240, 32)) / 5
    if grid:
        x = np.round(x * grid) / grid
        x[100:180] = x[7]  # a third of all rows is one vector
    rows = [(int(i), [float(np.float32(v)) for v in x[i]], int(i % 3) if i % 5 else None) for i in r.permutation(240)]
    want, digest = lloyd(rows)
    found, digests = got(V.compress_vectors(table(spark, rows).repartition(5)))
    assert found == want and digests == {digest}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    fine = [(i, [0.25 * ((i * 7 + j) % 5) - 0.5 for j in range(16)], i % 2) for i in range(9)]
    odd = [(20, None, 1), (21, [], 1), (22, [nan] * 16, 1), (23, [inf] + [0.0] * 15, 0), (24, [-inf] + [0.0] * 15, 0), (25, [None] + [0.0] * 15, 0)]
    more = [fine[3], (None, [0.5] * 16, None), (4, [0.25] * 16, 0)]  # a repeated row, a null id, an id on two vectors
    want, digest = lloyd(fine + more)
    found, digests = got(V.compress_vectors(table(spark, odd + fine + more)))
    assert found == want and digests == {digest} and len(found) == 12
    assert got(V.compress_vectors(table(spark, []))) == ([], set()) == got(V.compress_vectors(table(spark, odd)))
    with pytest.raises(ValueError, match="multiple of 8"):
        V.compress_vectors(table(spark, [(1, [1.0] * 12, 1)]))
    with pytest.raises(ValueError, match="below"):
        V.compress_vectors(table(spark, [(1, [1e6] * 16, 1)]))


def test_bounds_spare_distances(spark):
    """Clusters that hardly move: later rounds look at few distances, with the same result."""
    r = np.random.default_rng(5)
    centres = r.normal(size=(16, 16))
    x = centres[np.arange(3000) % 16] + r.normal(size=(3000, 16)) / 50
    rows = [(i, [float(np.float32(v)) for v in x[i]], 0) for i in range(3000)]
    coded, books, work = V.fit_codes(table(spark, rows), Scratch(spark, "t"))
    full = 3000 * 8 * 16
    assert work[0] >= full and len(work) == 7 and max(work[3:]) < full / 4
    want, digest = lloyd(rows)
    assert V.codebooks_digest(books) == digest and sorted((c.vec_id, c.label, c.code, c.error) for c in coded.collect()) == sorted(w[:4] for w in want)
