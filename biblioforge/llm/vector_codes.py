"""Vector code compression by Yinyang Lloyd (operator 11).

Vectors become integers and are cut into equal parts; each part position has a codebook that integer Lloyd rounds
improve. The entries of a codebook are clustered into groups once. A vector keeps, for each part, an upper bound of the
distance to its entry and one lower bound per group for the other entries. A round moves the bounds by the entries'
drifts; a part whose upper bound is below all its lower bounds keeps its entry unseen, and otherwise only the groups
whose bound fails are scanned. Distances are squared in integers, so ties go to the lower index exactly; bounds are
rounded outwards, so a skipped group holds neither a nearer entry nor a tie.

Vectors travel in blocks (one row per Arrow batch) with their bounds and the block's sums per entry. A round is one pass
over the blocks, written to the shared folder, and one aggregate of the sums; only codebooks reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.llm.common import Scratch

PARTS, ENTRIES, ROUNDS, SCALE, GROUPS = 8, 16, 6, 4096, 4
#: Components from here on (before the square of a difference leaves 64 bits) are refused.
LARGEST = 1 << 28
BLOCK_BYTES = 1 << 22


def kept_vectors(vectors: DataFrame, scale: int, column: str = "embedding") -> DataFrame:
    """vec_id, label, q (floor of scale * x per component) of the rows whose vector has components, all of them finite."""
    x = F.col(column)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    fine = x.isNotNull() & (F.size(x) > 0) & ~odd
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("q"))


def integer_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column as a matrix; another length than dim is an error."""
    if pa.types.is_large_list(column.type) or pa.types.is_list(column.type):
        lengths = np.asarray(column.value_lengths())
        if (lengths != dim).any():
            raise ValueError(f"all vectors must have {dim} components")
        return np.asarray(column.flatten()).reshape(len(column), dim)
    raise TypeError(column.type)


def entry_groups(entries: np.ndarray, groups: int) -> list[np.ndarray]:
    """Indices of codebook entries in up to `groups` clusters: farthest points as first centres, then some Lloyd rounds."""
    x = entries.astype(float)
    centres = [x[0]]
    while len(centres) < min(groups, len(x)):
        far = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0)
        centres.append(x[int(far.argmax())])
    c = np.array(centres)
    for _ in range(5):
        own = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        c = np.array([x[own == g].mean(0) if (own == g).any() else c[g] for g in range(len(c))])
    return [np.flatnonzero(own == g) for g in range(len(c)) if (own == g).any()]


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def reassign(x: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray, book: np.ndarray, groups: list[np.ndarray], drift: np.ndarray) -> int:
    """One part position of a block, in place: code, upper and lower after the entries of `book` drifted. Returns the number of distances.

    x: (n, d) integers; code: (n,); upper: (n,); lower: (n, len(groups)) bounds of the entries but the own one.
    """
    own = code.astype(np.int64)
    high = upper + drift[own]
    low = lower - np.array([drift[g].max() for g in groups])
    upper[:], lower[:] = _up(high), _down(low)
    todo = np.flatnonzero(high >= low.min(1))
    if not len(todo):
        return 0
    y, was, low = x[todo], own[todo], low[todo]
    here = ((y - book[was]) ** 2).sum(1)
    best, at, seen = here.copy(), was.copy(), len(todo)
    nearest, second, first = np.full(low.shape, np.inf), np.full(low.shape, np.inf), np.full(low.shape, -1)
    for g, members in enumerate(groups):
        scan = np.flatnonzero(low[:, g] <= np.nextafter(np.sqrt(best.astype(float)), np.inf))
        if not len(scan):
            continue
        d = ((y[scan][:, None] - book[members][None]) ** 2).sum(2)
        seen += d.size
        k = d.argmin(1)  # members ascend, so ties go to the lower index
        least = d[np.arange(len(scan)), k]
        nearest[scan, g], first[scan, g] = np.sqrt(least.astype(float)), members[k]
        if len(members) > 1:
            second[scan, g] = np.sqrt(np.partition(d, 1, axis=1)[:, 1].astype(float))
        better = (least < best[scan]) | ((least == best[scan]) & (members[k] < at[scan]))
        best[scan[better]], at[scan[better]] = least[better], members[k][better]
    scanned = first >= 0
    bound = np.where(first == at[:, None], second, nearest)
    new = np.where(scanned, bound, low)
    # The entry that was left belongs to the others of its group now.
    group_of = np.empty(len(book), np.int64)
    for g, members in enumerate(groups):
        group_of[members] = g
    left = np.flatnonzero(at != was)
    left = left[~scanned[left, group_of[was[left]]]]
    new[left, group_of[was[left]]] = np.minimum(new[left, group_of[was[left]]], np.sqrt(here[left].astype(float)))
    code[todo], upper[todo], lower[todo] = at, _up(np.sqrt(best.astype(float))), _down(new)
    return seen


class Lloyd:
    """What the tasks of a round need: codebooks (parts, entries, d), groups per part, drifts of the entries."""

    def __init__(self, books: np.ndarray, groups: list[list[np.ndarray]], drift: np.ndarray):
        self.books, self.groups, self.drift = books, groups, drift

    def assign(self, q: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
        """All parts of a block, in place. q: (n, parts, d); lower: (n, parts, most groups)."""
        return sum(reassign(q[:, p], code[:, p], upper[:, p], lower[:, p, : len(self.groups[p])], self.books[p], self.groups[p], self.drift[p]) for p in range(len(self.books)))

    def moved(self, sums: np.ndarray) -> Lloyd:
        """After replacing each entry by the floored mean of its parts; sums: (parts, entries, 1 + d), Python integers, counts first."""
        counts = sums[:, :, :1]
        books = np.where(counts > 0, sums[:, :, 1:] // np.maximum(counts, 1), self.books.astype(object)).astype(np.int64)
        return Lloyd(books, self.groups, np.nextafter(np.sqrt(((books - self.books) ** 2).sum(2).astype(float)), np.inf))


def _sums(q: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """(parts, entries, 1 + d): count and component sums of the parts at each entry, exact below 2**53."""
    n, parts, d = q.shape
    out = np.empty((parts, entries, 1 + d), np.int64)
    for p in range(parts):
        own = code[:, p].astype(np.int64)
        out[p, :, 0] = np.bincount(own, minlength=entries)
        for j in range(d):
            out[p, :, 1 + j] = np.bincount(own, weights=q[:, p, j], minlength=entries)
    return out


def _first_blocks(dim: int, parts: int):
    """Rows -> blocks (q, ids, labels) without bounds."""
    size = max(1, BLOCK_BYTES // (4 * dim))

    def blocks(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                b = whole.slice(at, size)
                q = integer_matrix(b.column("q"), dim)
                if len(q) and (q.min() <= -LARGEST or q.max() >= LARGEST):
                    raise ValueError(f"scaled components must be below {LARGEST}")
                yield q.reshape(len(q), parts, dim // parts), b.column("vec_id"), b.column("label")

    return blocks


def _block(q, ids: pa.Array, labels: pa.Array, code, upper, lower, sums, seen, schema: pa.Schema) -> pa.RecordBatch:
    one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
    raw = lambda a, t: pa.array([np.ascontiguousarray(a, t).tobytes()], pa.binary())
    cells = [one(ids), one(labels), raw(q, "<i4"), raw(code, np.uint8), raw(upper, "<f4"), raw(lower, "<f4"), one(pa.array(sums.ravel())), pa.array([seen], pa.int64())]
    return pa.RecordBatch.from_arrays(cells, names=schema)


NAMES = ["ids", "labels", "q", "code", "upper", "lower", "sums", "seen"]


def _state(b: pa.RecordBatch, i: int, dim: int, parts: int, groups: int):
    cell = lambda name, t, *shape: np.frombuffer(b.column(name)[i].as_py(), t).reshape(-1, *shape).copy()
    q = cell("q", "<i4", parts, dim // parts).astype(np.int64)
    return q, b.column("ids")[i].values, b.column("labels")[i].values, cell("code", np.uint8, parts), cell("upper", "<f4", parts), cell("lower", "<f4", parts, groups)


def fit_codes(vectors: DataFrame, scratch: Scratch, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, groups: int = GROUPS) -> tuple[DataFrame | None, np.ndarray | None, list[int]]:
    """(coded vectors, final codebooks, distances computed per pass). Coded vectors: vec_id, label, code (hex), error. All None or empty without vectors."""
    spark: SparkSession = vectors.sparkSession
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte")
    kept = kept_vectors(vectors, scale)
    seeds = kept.orderBy(F.asc_nulls_last("vec_id"), "q").limit(entries).select("q").collect()
    if not seeds:
        return None, None, []
    dim = len(seeds[0].q)
    if dim % parts or any(len(s.q) != dim for s in seeds):
        raise ValueError(f"all vectors must have one length, a multiple of {parts}")
    books = np.array([s.q for s in seeds], np.int64).reshape(-1, parts, dim // parts).transpose(1, 0, 2)
    if np.abs(books).max() >= LARGEST:
        raise ValueError(f"scaled components must be below {LARGEST}")
    clustered = [entry_groups(b, groups) for b in books]
    lloyd = Lloyd(books, clustered, np.zeros(books.shape[:2]))
    most, n_entries = max(map(len, clustered)), books.shape[1]
    label_type = kept.schema["label"].dataType.simpleString()
    ddl = f"ids array<bigint>, labels array<{label_type}>, q binary, code binary, upper binary, lower binary, sums array<bigint>, seen bigint"
    first = _first_blocks(dim, parts)

    def begin(batches):
        for q, ids, labels in first(batches):
            code, upper, lower = np.zeros((len(q), parts), np.uint8), np.full((len(q), parts), np.inf, np.float32), np.full((len(q), parts, most), -np.inf, np.float32)
            seen = start.assign(q, code, upper, lower)
            yield _block(q, ids, labels, code, upper, lower, _sums(q, code, n_entries), seen, NAMES)

    def again(now: Lloyd):
        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    q, ids, labels, code, upper, lower = _state(b, i, dim, parts, most)
                    seen = now.assign(q, code, upper, lower)
                    yield _block(q, ids, labels, code, upper, lower, _sums(q, code, n_entries), seen, NAMES)

        return run

    start, work = lloyd, []
    blocks = scratch.keep(kept.mapInArrow(begin, ddl), "round")
    for number in range(rounds):
        sums = blocks.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
        work.append(blocks.agg(F.sum("seen")).first()[0])
        flat = np.zeros(books.size + books.shape[0] * n_entries, object)
        for r in sums:
            flat[r["at"]] = int(r["v"])
        lloyd = lloyd.moved(flat.reshape(parts, n_entries, -1))
        if number < rounds - 1:
            now = scratch.keep(blocks.mapInArrow(again(lloyd), ddl), "round")
            scratch.drop(blocks)
            blocks = now

    def end(now: Lloyd):
        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    q, ids, labels, code, upper, lower = _state(b, i, dim, parts, most)
                    seen = now.assign(q, code, upper, lower)
                    error = sum(((q[:, p] - now.books[p][code[:, p]]) ** 2).sum(1) for p in range(parts))
                    text = code.tobytes().hex()
                    codes = [text[j : j + 2 * parts] for j in range(0, len(text), 2 * parts)]
                    share = np.zeros(len(q), np.int64)
                    share[:1] = seen
                    yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes, pa.string()), pa.array(error), pa.array(share)], names=["vec_id", "label", "code", "error", "seen"])

        return run

    coded = scratch.keep(blocks.mapInArrow(end(lloyd), f"vec_id bigint, label {label_type}, code string, error bigint, seen bigint"), "coded")
    scratch.drop(blocks)
    work.append(coded.agg(F.sum("seen")).first()[0])
    return coded.drop("seen"), lloyd.books, work


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every vector that is kept.

    vectors: vec_id, embedding (array of numbers), label; other columns are ignored. Rows whose vector is null, empty or
    holds a null or non-finite component are dropped. The first entries are the vectors with the smallest vec_ids (null
    ids last, one id on several rows by their components); with fewer vectors there are fewer entries. Repeated rows and
    equal vectors are coded each. Null labels are one label. Vectors of unequal lengths, a length that parts doesn't
    divide, and scaled components of 2**28 and more are errors. An empty table gives an empty one.
    """
    scratch = Scratch(vectors.sparkSession, "vector-codes")
    coded, books, _ = fit_codes(vectors, scratch, parts, entries, rounds, scale)
    if coded is None:
        label = vectors.schema["label"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id bigint, label {label}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    # Written first, so that Spark knows its size: a few labels are broadcast, many are joined with skew splitting.
    totals = scratch.keep(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "totals")
    out = coded.join(totals, coded.label.eqNullSafe(totals["_label"])).drop("_label")
    return out.withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))
