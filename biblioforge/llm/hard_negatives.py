"""Hard-negative mining by dual-tree search (operator 13).

All rows are range-partitioned by label, by the nearest of some pivots and by a principal axis, and cut into blocks, each
with a ball tree of its rows. The anchors, sorted the same way, are taken in slices of bounded size with a ball tree
each. A pass sends one slice's tree to all blocks. In a block the two trees are walked together: the balls of a node
pair bound its inner products from both sides, and the pair is dropped at once for the whole anchor group if no anchor
in it can use such a score (too low for the best ones so far, above all its windows, or of the wrong labels). Leaf pairs
are scored exactly: components are integers, and their products stay below 2**53.

The first pass finds the positives, the second the negatives in the window of each positive. Every task gives its best
rows per anchor, and a window function with a row limit merges them. Pivots and axis are fitted on a bounded sample
(SAMPLE rows); they, and the first bounds taken from the sample, only save work. The anchors are a stated query set
against all rows in blocks; in the worst case, when no pair can be dropped, the work is their product.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioforge.llm.common import Scratch
from biblioforge.llm.vector_codes import integer_matrix, kept_vectors

SCALE, EVERY, RELABEL, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
SAMPLE, PIVOTS, LEAF = 4096, 64, 64
SLICE_BYTES, BLOCK_BYTES = 1 << 23, 1 << 22
ORDER = ["label", "cell", "along", "vec_id", "q"]


class BallTree:
    """Rows (q, ids, labels) in tree order; a node has rows start..stop, a ball (centre, radius) and the range of its labels."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int = LEAF):
        order, nodes, centres = np.arange(len(q)), [], []
        todo = [(0, len(q), -1, 0)]
        while todo:
            start, stop, parent, side = todo.pop()
            x = q[order[start:stop]]
            centre = x.mean(0)
            away = ((x - centre) ** 2).sum(1)
            number = len(nodes)
            own = labels[order[start:stop]]
            nodes.append([start, stop, -1, -1, own.min(), own.max()])
            centres.append((centre, float(np.sqrt(away.max()))))
            if parent >= 0:
                nodes[parent][side] = number
            if stop - start > leaf:
                # Between the two far points, or at the median if that leaves one side with few rows.
                far = x[away.argmax()]
                other = x[((x - far) ** 2).sum(1).argmax()]
                along = x @ (far - other)
                order[start:stop] = order[start:stop][np.argsort(along, kind="stable")]
                below = int((along < (far + other) @ (far - other) / 2).sum())
                middle = start + (below if len(x) <= 8 * min(below, len(x) - below) else len(x) // 2)
                todo += [(start, middle, number, 2), (middle, stop, number, 3)]
        self.q, self.ids, self.labels, self.order = q[order], ids[order], labels[order], order
        self.start, self.stop, self.left, self.right, self.low, self.high = np.array(nodes, np.int64).T
        self.centre, self.radius = np.array([c for c, _ in centres]), np.array([r for _, r in centres])
        self.norm = np.sqrt((self.centre**2).sum(1))

    def over_nodes(self, values: np.ndarray, take: np.ufunc, none: float) -> np.ndarray:
        """take (minimum or maximum) of a value per row over the rows of each node."""
        return take.reduceat(np.append(values, none), np.stack([self.start, self.stop], 1).ravel())[::2]


def leaf_pairs(a: BallTree, c: BallTree, wanted: Callable) -> tuple[np.ndarray, np.ndarray, int]:
    """Leaf pairs whose node pairs all pass wanted(i, j, least, most), and how many node pairs were looked at."""
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    found, looked = [], 0
    while len(i):
        looked += len(i)
        middle = np.einsum("nd,nd->n", a.centre[i], c.centre[j])
        reach = a.radius[i] * c.norm[j] + c.radius[j] * a.norm[i] + a.radius[i] * c.radius[j]
        reach += 1e-3 + 1e-9 * (np.abs(middle) + reach)  # more than floats can be off
        keep = wanted(i, j, middle - reach, middle + reach)
        i, j = i[keep], j[keep]
        leaf_i, leaf_j = a.left[i] < 0, c.left[j] < 0
        found.append((i[leaf_i & leaf_j], j[leaf_i & leaf_j]))
        by_i = ~leaf_i & (leaf_j | (a.radius[i] >= c.radius[j]))
        by_j = ~by_i & ~leaf_j
        i, j = np.concatenate([a.left[i[by_i]], a.right[i[by_i]], i[by_j], i[by_j]]), np.concatenate([j[by_i], j[by_i], c.left[j[by_j]], c.right[j[by_j]]])
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]), looked


class Best:
    """The k best (score, smaller id first) of each of n lists."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.id = k, np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(lists):
            return
        some = np.unique(lists)
        at = np.concatenate([np.repeat(some, self.k), lists])
        score, own = np.concatenate([self.score[some].ravel(), scores]), np.concatenate([self.id[some].ravel(), ids])
        order = np.lexsort((own, -score, at))
        at, score, own = at[order], score[order], own[order]
        first = np.searchsorted(at, some)
        pick = first[:, None] + np.arange(self.k)  # each list has k entries at least
        self.score[some], self.id[some] = score[pick], own[pick]


class Slice:
    """Anchors with their tree; floor: a score that the k-th best positive has at least; later the windows of the positives."""

    def __init__(self, tree: BallTree, fragments: np.ndarray, floor: np.ndarray):
        self.tree, self.fragments, self.floor = tree, fragments, floor

    def visit(self, c: BallTree, wanted: Callable, take: Callable) -> None:
        """take(rows of the anchors, rows of the block, exact scores) for each anchor leaf with its candidate leaves."""
        i, j, _ = leaf_pairs(self.tree, c, wanted)
        if not len(i):
            return
        order = np.lexsort((j, i))
        i, j = i[order], j[order]
        for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1):
            a = slice(self.tree.start[i[part[0]]], self.tree.stop[i[part[0]]])
            rows = np.concatenate([np.arange(c.start[k], c.stop[k]) for k in j[part]])
            take(np.arange(a.start, a.stop), rows, self.tree.q[a] @ c.q[rows].T)

    def positives(self, blocks: Iterator[BallTree], k: int) -> Best:
        """The best rows of the anchor's label with another id."""
        t, best = self.tree, Best(len(self.tree.ids), k)
        for c in blocks:
            floor = np.maximum(self.floor, best.score[:, -1])
            least = t.over_nodes(floor, np.minimum, np.inf)

            def wanted(i, j, low, high, least=least, c=c):
                return (high >= least[i]) & (t.low[i] <= c.high[j]) & (c.low[j] <= t.high[i])

            def take(a, rows, scores, floor=floor, c=c):
                fits = (t.labels[a][:, None] == c.labels[rows]) & (t.ids[a][:, None] != c.ids[rows]) & (scores >= floor[a][:, None])
                x, y = np.nonzero(fits)
                best.add(a[x], scores[x, y], c.ids[rows[y]])

            self.visit(c, wanted, take)
        return best

    def negatives(self, blocks: Iterator[BallTree], low: np.ndarray, high: np.ndarray, k: int) -> list[Best]:
        """For each column of the windows (low, high: anchors x positives, low above high where there is none) the best rows of other labels in it."""
        t, best = self.tree, [Best(len(self.tree.ids), k) for _ in range(low.shape[1])]
        top = t.over_nodes(np.where(low <= high, high, -np.inf).max(1), np.maximum, -np.inf)
        for c in blocks:
            floors = np.stack([np.maximum(low[:, p], b.score[:, -1]) for p, b in enumerate(best)], 1)
            least = t.over_nodes(np.where(low <= high, floors, np.inf).min(1), np.minimum, np.inf)

            def wanted(i, j, at_least, at_most, least=least, c=c):
                alike = (t.low[i] == t.high[i]) & (c.low[j] == c.high[j]) & (t.low[i] == c.low[j])
                return (at_most >= least[i]) & (at_least <= top[i]) & ~alike

            def take(a, rows, scores, floors=floors, c=c):
                other = t.labels[a][:, None] != c.labels[rows]
                for p, b in enumerate(best):
                    x, y = np.nonzero(other & (scores >= floors[a, p][:, None]) & (scores <= high[a, p][:, None]))
                    b.add(a[x], scores[x, y], c.ids[rows[y]])

            self.visit(c, wanted, take)
        return best


def _fit(sample: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """Pivots by some Lloyd rounds, and the main axis, of a sample; as integers, so that all rows are placed exactly."""
    x = sample.astype(float)
    c = x[np.linspace(0, len(x) - 1, min(pivots, len(x))).astype(int)]
    for _ in range(4):
        own = (x @ c.T - (c**2).sum(1) / 2).argmax(1)
        c = np.array([x[own == g].mean(0) if (own == g).any() else c[g] for g in range(len(c))])
    axis = np.linalg.svd(x - x.mean(0), full_matrices=False)[2][0]
    return np.round(c), np.round(axis / max(np.abs(axis).max(), 1e-9) * 64)


def _place(dim: int, pivots: np.ndarray, axis: np.ndarray):
    """Rows with cell, along and q as bytes. Sums stay exact integers, so equal vectors are placed alike."""
    limit = int(np.sqrt(2**52 / dim))

    def run(batches):
        for b in batches:
            q = integer_matrix(b.column("q"), dim)
            if len(q) and max(q.max(), -q.min()) >= limit:
                raise ValueError(f"scaled components must be below {limit}")
            x = q.astype(float)
            cell = (2 * (x @ pivots.T) - (pivots**2).sum(1)).argmax(1).astype(np.int32)
            raw = pa.array([r.tobytes() for r in q.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(cell), pa.array(x @ axis), raw], names=["vec_id", "label", "cell", "along", "q"])

    return run


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dim).astype(float)


def _blocks(dim: int):
    """Sorted rows -> one pickled tree per batch. A row equal to the one before it is that row again."""
    size = max(LEAF, BLOCK_BYTES // (8 * dim))

    def run(batches):
        last = None
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                b = whole.slice(at, size)
                q, ids, labels = _matrix(b.column("q"), dim), b.column("vec_id").to_numpy(), b.column("label").to_numpy()
                again = np.zeros(len(q), bool)
                again[1:] = (ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1]) & (q[1:] == q[:-1]).all(1)
                again[0] = last is not None and last[0] == ids[0] and last[1] == labels[0] and (last[2] == q[0]).all()
                last = (ids[-1], labels[-1], q[-1])
                if not again.all():
                    tree = BallTree(q[~again], ids[~again], labels[~again])
                    tree.q = tree.q.astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tree)], pa.binary())], names=["tree"])

    return run


def _trees(batches) -> Iterator[BallTree]:
    for b in batches:
        for cell in b.column("tree"):
            tree = pickle.loads(cell.as_py())
            tree.q = tree.q.astype(float)
            yield tree


def _anchor_rows(dim: int, sample: np.ndarray, sample_ids: np.ndarray, sample_labels: np.ndarray, k: int):
    """Sorted anchors -> fragment (partition, and run of rows in it) and floor: the k-th best of the anchor's label in the sample, which all rows can only beat."""
    size = max(1, SLICE_BYTES // (8 * dim))
    pool = sample.T.astype(float)

    def run(batches):
        seen, part = 0, TaskContext.get().partitionId()
        for b in batches:
            q, ids, labels = _matrix(b.column("q"), dim), b.column("vec_id").to_numpy(), b.column("label").to_numpy()
            floor = np.full(len(q), -np.inf)
            for at in range(0, len(q), 256):
                s = slice(at, at + 256)
                fits = (labels[s][:, None] == sample_labels) & (ids[s][:, None] != sample_ids)
                scores = np.where(fits, q[s] @ pool, -np.inf)
                if scores.shape[1] >= k:
                    floor[s] = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
            fragment = (np.int64(part) << 32) + (seen + np.arange(len(q))) // size
            seen += len(q)
            yield pa.RecordBatch.from_arrays([pa.array(fragment), b.column("vec_id"), b.column("label"), b.column("q"), pa.array(floor)], names=["fragment", "vec_id", "label", "q", "floor"])

    return run


def _slices(counts: list, size: int) -> list[tuple[int, int]]:
    """Ranges of fragments with `size` anchors at most (a fragment never has more)."""
    out, held = [], 0
    for fragment, n in counts:
        if out and held + n <= size:
            out[-1], held = (out[-1][0], fragment), held + n
        else:
            out.append((fragment, fragment))
            held = n
    return out


def _first(found: DataFrame, by: list[str], score: str, number: str, name: str, k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(score), number)
    return found.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


FOUND = "fragment bigint, anchor_id bigint, positive_id bigint, positive_score bigint"
HARD = "anchor_id bigint, at int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank (int, from 1), negative_id, positive_score, negative_score.

    vectors: vec_id, embedding, label; other columns are ignored. Rows with a null vec_id or label and rows whose vector
    is null, empty or holds a null or non-finite component take no part. Anchors are the vec_ids divisible by `every`;
    scores and windows are as the module says, with low * positive_score <= 100 * negative_score <= high *
    positive_score. Equal rows are one row; different rows with one vec_id are candidates each, and the first of them by
    label and vector is the anchor. Ties go to the smaller vec_id. Anchors without positives or negatives give no rows;
    an empty table gives an empty one. Vectors of unequal lengths and scaled components whose products could leave
    2**53 are errors.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    label = F.col("label").cast("long")
    rows = kept_vectors(vectors, SCALE).where("vec_id is not null and label is not null")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % RELABEL == 0, (label + 1) % LABELS).otherwise(label))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "q").limit(SAMPLE).toArrow()
    nothing = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    if not sample.num_rows:
        return nothing
    dim = len(sample.column("q")[0])
    sample_q = integer_matrix(sample.column("q").combine_chunks(), dim)
    pivots, axis = _fit(sample_q, PIVOTS)
    placed = rows.mapInArrow(_place(dim, pivots, axis), "vec_id bigint, label bigint, cell int, along double, q binary")
    in_order = lambda df: df.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    blocks = scratch.keep(in_order(placed).mapInArrow(_blocks(dim), "tree binary"), "blocks")
    firsts = placed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "q", "cell", "along")).alias("x")).select("vec_id", "x.*")
    seed = _anchor_rows(dim, sample_q, np.asarray(sample.column("vec_id")), np.asarray(sample.column("label")), positives)
    anchors = scratch.keep(in_order(firsts).mapInArrow(seed, "fragment bigint, vec_id bigint, label bigint, q binary, floor double"), "anchors")
    counts = [tuple(r) for r in anchors.groupBy("fragment").count().orderBy("fragment").collect()]
    slices = _slices(counts, max(1, SLICE_BYTES // (8 * dim)))
    if not slices:
        return nothing

    def slice_of(span: tuple[int, int]) -> Slice:
        t = anchors.where(F.col("fragment").between(*span)).toArrow().sort_by([("vec_id", "ascending")])
        tree = BallTree(_matrix(t.column("q"), dim), t.column("vec_id").to_numpy(), t.column("label").to_numpy(), 32)
        return Slice(tree, t.column("fragment").to_numpy()[tree.order], t.column("floor").to_numpy()[tree.order])

    def passes(search, ddl: str, name: str) -> DataFrame:
        """search(slice, its windows) on all blocks, one slice after the other; all that was found."""
        paths = []
        for span in slices:
            told = spark.sparkContext.broadcast(search(slice_of(span), span))  # SLICE_BYTES of vectors at most
            paths.append(scratch.path(name))
            blocks.mapInArrow(lambda batches, told=told: told.value(_trees(batches)), ddl).write.parquet(paths[-1])
            told.destroy()
        return spark.read.schema(ddl).parquet(*paths)

    found = passes(lambda s, _: _FindPositives(s, positives), FOUND, "positives")
    chosen = scratch.keep(_first(found, ["fragment", "anchor_id"], "positive_score", "positive_id", "at", positives), "chosen")

    def windows(s: Slice, span: tuple[int, int]):
        own = chosen.where(F.col("fragment").between(*span)).toArrow()
        place = {int(v): i for i, v in enumerate(s.tree.ids)}
        ids, scores = np.zeros((len(place), positives), np.int64), np.zeros((len(place), positives), np.int64)
        floor, top = np.full(ids.shape, np.inf), np.full(ids.shape, -np.inf)
        a = np.array([place[v] for v in own.column("anchor_id").to_pylist()], np.int64)
        p, score = np.asarray(own.column("at"), np.int64) - 1, np.asarray(own.column("positive_score"), np.int64)
        ids[a, p], scores[a, p] = np.asarray(own.column("positive_id"), np.int64), score
        floor[a, p], top[a, p] = -(-low * score // 100), high * score // 100
        return _FindNegatives(s, ids, scores, floor, top, negatives)

    hard = passes(windows, HARD, "negatives")
    out = _first(hard, ["anchor_id", "at"], "negative_score", "negative_id", "rank", negatives)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


class _FindPositives:
    def __init__(self, anchors: Slice, k: int):
        self.anchors, self.k = anchors, k

    def __call__(self, blocks: Iterator[BallTree]):
        t, best = self.anchors.tree, self.anchors.positives(blocks, self.k)
        a, j = np.nonzero(np.isfinite(best.score))
        cells = [self.anchors.fragments[a], t.ids[a], best.id[a, j], best.score[a, j].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in cells], names=[x.split()[0] for x in FOUND.split(", ")])


class _FindNegatives:
    def __init__(self, anchors: Slice, ids, scores, low, high, k: int):
        self.anchors, self.ids, self.scores, self.low, self.high, self.k = anchors, ids, scores, low, high, k

    def __call__(self, blocks: Iterator[BallTree]):
        t = self.anchors.tree
        for p, best in enumerate(self.anchors.negatives(blocks, self.low, self.high, self.k)):
            a, j = np.nonzero(np.isfinite(best.score))
            cells = [t.ids[a], np.full(len(a), p, np.int32), self.ids[a, p], self.scores[a, p], best.id[a, j], best.score[a, j].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cells], names=[x.split()[0] for x in HARD.split(", ")])
