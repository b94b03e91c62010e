"""N-gram Jaccard join (operator 1): grouped prefix join over word shingles, and its connected components.

How it works

1. Rarity pass over all documents. Each task hashes the shingles of its documents and sends them, sorted and
   packed, to hash buckets; a bucket counts in how many documents each shingle occurs and answers, per document,
   how many of its shingles occur nowhere else. In the order "rarest first" a document of n shingles has a prefix
   of n - ceil(0.75 n) + 1 shingles, and a partner must share one of them. A document with at least that many
   shingles of its own therefore has no partner, whatever the rest holds. Copies with equal sets are one class.
2. The classes left (those with something to share) get exact document frequencies the same way, and with them
   their prefixes; common passages stand last in the order and so stay out of prefixes.
3. Classes with identical prefix and size form one group. Groups that share a prefix shingle are compared through a
   few pivots of each shingle first; pairs that are already in one component need no comparison. What is still
   apart is compared pair by pair, so that no link between two components is lost. Verified with the whole sets.

Nothing is capped or sampled; shuffled data grow in proportion to the input. Buckets get one entry per task block
for a shingle at most, so a shingle in a third of all documents is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.llm.common import Scratch, mix, plan_bytes, shingle_set
from biblioforge.llm.components import connected_components

BLOCK = 1_000_000  # shingles that a task holds before it sends them
BUCKET_BYTES = 4 << 20  # input bytes per hash bucket
PIVOTS, ROUNDS = 2, 2  # pivots of a shingle in a round; rounds
BLOCK_NODES = 256  # documents that are compared with as many others at once
MULTI = 0xFFFF


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def _pack(h: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as byte planes of their differences; the upper planes are mostly zero and compress away."""
    return np.ascontiguousarray(np.diff(h, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list, list, list[np.ndarray]]]:
    """Documents of a partition in blocks of about BLOCK shingles: (block id, ids, text hashes, sets).

    Block ids depend on the order of the rows, so the rows must come straight from files, which a repeated task reads
    in the same order.
    """
    from pyspark import TaskContext

    part, number, held = TaskContext.get().partitionId(), 0, 0
    ids, texts, sets = [], [], []
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            piece = batch.slice(k, 256)
            for i, th, text in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                s = shingle_set(text, size)
                ids.append(i)
                texts.append(th)
                sets.append(s)
                held += len(s)
                if held >= BLOCK or len(ids) >= MULTI - 1:
                    yield part << 24 | number, ids, texts, sets
                    ids, texts, sets, held, number = [], [], [], 0, number + 1
    if ids:
        yield part << 24 | number, ids, texts, sets


def _cut(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets present, bounds in h, low 32 bits below the bucket bits) of sorted hashes."""
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    present, first = np.unique(bucket, return_index=True)
    low = ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    return present, np.append(first, len(h)), low


def _send(size: int, bits: int, whole: bool):
    """Map side. kind 0: shingles of a block for a bucket; kind 1: the block's header, back to itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, texts, sets in _blocks(batches, size):
            n = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            own = np.repeat(np.arange(len(sets), dtype=np.uint16), n)
            order = np.argsort(flat, kind="stable")
            h, own = flat[order], own[order]
            if len(h):
                new = np.concatenate(([True], h[1:] != h[:-1]))
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(h)))
                h, own = h[first], np.where(times > 1, MULTI, own[first]).astype(np.uint16)
            else:
                times = np.empty(0, np.int64)
            rows = {"key": [], "block": [], "kind": [], "a": [], "b": []}

            def put(key, kind, a, b, rows=rows, block=block):
                for name, v in zip(rows, (key, block, kind, a, b), strict=True):
                    rows[name].append(v)

            if len(h):
                present, bounds, low = _cut(h, bits)
                for b, lo, hi in zip(present.tolist(), bounds[:-1], bounds[1:], strict=True):
                    put(b, 0, _pack(low[lo:hi]), (times[lo:hi].astype(np.uint16) if whole else own[lo:hi]).tobytes())
            known = np.array([i is not None for i in ids])
            head = np.array([i or 0 for i in ids], np.int64).tobytes() + n.tobytes() + np.array(texts, np.int64).tobytes() + known.tobytes()
            if whole:
                put(-1 - block, 1, head, flat.tobytes())
            else:
                keys = np.array([[int(np.bitwise_xor.reduce(mix(s))), int(np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))))] if len(s) else [0, 0] for s in sets], np.uint64)
                put(-1 - block, 1, head, keys.tobytes())
            yield pa.RecordBatch.from_pydict(rows, schema=SENT)

    return run


SENT = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("kind", pa.int8()), ("a", pa.binary()), ("b", pa.binary())])
SENT_DDL = "key long, block long, kind byte, a binary, b binary"
ANSWER_DDL = "block long, kind byte, key long, a binary, b binary"
ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.int8()), ("key", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])


def _count(whole: bool):
    """Bucket side: per block, how many shingles of each document occur in it alone, or each shingle's documents."""

    def run(table: pa.Table) -> pa.Table:
        kinds, blocks, a, b = (table.column(c).to_pylist() for c in ("kind", "block", "a", "b"))
        out = {"block": blocks, "kind": kinds, "key": table.column("key").to_pylist(), "a": a, "b": b}
        if kinds[0] == 1:
            return pa.table(out, schema=ANSWER)
        low = [_unpack(x) for x in a]
        more = [np.frombuffer(x, np.uint16) for x in b]
        flat = np.concatenate(low)
        values, back = np.unique(flat, return_inverse=True)
        if whole:
            df = np.bincount(back, weights=np.concatenate(more)).astype(np.int64)[back]
            df = np.minimum(df, 65535).astype(np.uint16)
            ends = np.cumsum([len(x) for x in low])
            out["a"] = [x.tobytes() for x in np.split(df, ends[:-1])]
            out["b"] = [b""] * len(a)
            return pa.table(out, schema=ANSWER)
        alone = np.bincount(back)[back] == 1
        start, out["a"], out["b"] = 0, [], []
        for x in more:
            mine = x[alone[start : start + len(x)]]
            start += len(x)
            docs, times = np.unique(mine[mine != MULTI], return_counts=True)
            out["a"].append(docs.astype(np.uint16).tobytes())
            out["b"].append(times.astype(np.uint16).tobytes())
        return pa.table(out, schema=ANSWER)

    return run


def _header(a: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    count = len(a) // 25
    ids = np.frombuffer(a, np.int64, count).tolist()
    n, texts = (np.frombuffer(a, np.int64, count, k * count) for k in (8, 16))
    known = np.frombuffer(a, bool, count, 24 * count)
    return [i if k else None for i, k in zip(ids, known, strict=True)], n, texts


PROFILE_DDL = "doc_id long, th long, n long, k1 long, k2 long, shares boolean"


def _profile(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["kind"] == 1)
        ids, n, texts = _header(head["a"])
        keys = np.frombuffer(head["b"], np.uint64).view(np.int64).reshape(-1, 2)
        alone = np.zeros(len(ids), np.int64)
        for r in rows:
            if r["kind"] == 0:
                alone[np.frombuffer(r["a"], np.uint16)] += np.frombuffer(r["b"], np.uint16)
        return pa.table(
            {"doc_id": pa.array(ids, pa.int64()), "th": texts, "n": n, "k1": keys[:, 0], "k2": keys[:, 1], "shares": (n > 0) & (alone < prefix_length(n, percent))}
        )

    return run


SET_DDL = "node long, n long, pkey long, prefix array<long>, shingles array<long>"


def _prefixes(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["kind"] == 1)
        ids, n, _ = _header(head["a"])
        flat = np.frombuffer(head["b"], np.uint64)
        answers = sorted((r["key"], r["a"]) for r in rows if r["kind"] == 0)
        df = np.concatenate([np.frombuffer(x, np.uint16) for _, x in answers]) if answers else np.empty(0, np.uint16)
        _, back = np.unique(flat, return_inverse=True)
        df = df[back] if len(df) else df
        out = {"node": [], "n": [], "pkey": [], "prefix": [], "shingles": []}
        ends = np.cumsum(n)
        for i, size, lo, hi in zip(ids, n.tolist(), ends - n, ends, strict=True):
            if not size:
                continue
            h, f = flat[lo:hi], df[lo:hi]
            best = np.lexsort((h, f))[: int(prefix_length(np.int64(size), percent))]
            out["node"].append(i)
            out["n"].append(size)
            out["pkey"].append(int(np.add.reduce(mix(h[best])).view(np.int64)))
            out["prefix"].append(h[best][f[best] > 1].view(np.int64))
            out["shingles"].append(h.view(np.int64))
        kinds = {"node": pa.int64(), "n": pa.int64(), "pkey": pa.int64(), "prefix": pa.list_(pa.int64()), "shingles": pa.list_(pa.int64())}
        return pa.table({k: pa.array(out[k], t) for k, t in kinds.items()})

    return run


def _exchange(docs: DataFrame, size: int, whole: bool, finish, ddl: str) -> DataFrame:
    bits = min(30, max(4, (plan_bytes(docs) // BUCKET_BYTES).bit_length()))
    sent = docs.mapInArrow(_send(size, bits, whole), SENT_DDL)
    counted = sent.groupBy("key").applyInArrow(_count(whole), ANSWER_DDL)
    return counted.groupBy("block").applyInArrow(finish, ddl)


def _similar(percent: int, na: str, nb: str, both: str):
    return F.expr(f"100 * {both} >= {percent} * ({na} + {nb} - {both})")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) node pairs whose whole sets are similar. The set of b travels to a once per pair."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    met = pairs.select("a", "b").distinct().join(right, "b").join(left, "a")
    met = met.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return met.withColumn("common", F.expr("size(array_intersect(sa, sb))")).where(_similar(percent, "na", "nb", "common")).select("a", "b")


def _classes(docs: DataFrame, size: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Profile of all rows (doc_id, th: text hash, n, k1, k2, shares), and the classes of equal sets among rows with words and an id: n, k1, k2, component_id, first.

    first: doc_id and text hash of the row that stands for the component.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"), F.col("text").cast("string").alias("text"))
    profile = scratch.keep(_exchange(docs, size, False, _profile(percent), PROFILE_DDL), "profile")
    classes = profile.where("n > 0 and doc_id is not null").groupBy("n", "k1", "k2").agg(F.min(F.struct("doc_id", "th")).alias("first"), F.max("shares").alias("shares"))
    # Nodes are numbers of their own: a doc_id may stand on different texts. They are written once, so they stay as they are.
    classes = scratch.keep(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    sharing = classes.where("shares").select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.th").alias("th"))
    left = docs.join(sharing, ["doc_id", "th"]).groupBy("node").agg(F.first("th").alias("th"), F.first("text").alias("text"))
    left = scratch.keep(left, "texts")
    sets = scratch.keep(_exchange(left, size, True, _prefixes(percent), SET_DDL), "sets")
    comps = _link(sets, percent, scratch)
    scratch.drop(left, sets)
    linked = classes.join(comps, "node").select("n", "k1", "k2", "comp", "first")
    firsts = linked.groupBy("comp").agg(F.min("first").alias("least"))
    least = linked.join(firsts, "comp").select("n", "k1", "k2", "least")
    named = classes.join(least, ["n", "k1", "k2"], "left").select("n", "k1", "k2", F.coalesce("least", "first").alias("first"))
    return profile, named.select("n", "k1", "k2", F.col("first.doc_id").alias("component_id"), "first")


def similarity_components(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """Components of documents linked by shingle Jaccard >= percent / 100.

    docs: doc_id long, text string; other columns are ignored. Returns doc_id, n_shingles, component_id for every
    row. Null or empty texts: n_shingles 0, alone. A null doc_id: its own n_shingles, component_id null, linked with
    nothing. Repeated rows are documents of their own with equal results; so are rows with one doc_id and different
    texts, which the id doesn't link. Empty tables give empty results.
    """
    scratch = Scratch(docs.sparkSession, "ngram-jaccard")
    profile, classes = _classes(docs, size, percent, scratch)
    alone = profile.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return profile.where("n > 0 and doc_id is not null").join(classes, ["n", "k1", "k2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(alone)


def _link(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(node, comp) of the nodes in sets that have links."""
    light = sets.select("node", "n", "pkey", "prefix")
    same = light.groupBy("n", "pkey").agg(F.min("node").alias("gid")).join(light, ["n", "pkey"]).where("node <> gid")
    links = scratch.keep(_verify(same.select(F.col("node").alias("a"), F.col("gid").alias("b")), sets, percent), "same")
    comps = connected_components(links, scratch)
    # A group: identical prefix and size, and (after its own check) one component.
    nodes = light.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    nodes = scratch.keep(nodes.join(nodes.groupBy("n", "pkey", "comp").agg(F.min("node").alias("gid")), ["n", "pkey", "comp"]), "nodes")
    members = nodes.select("gid", "node")
    posts = scratch.keep(nodes.where("node = gid").select("gid", "n", F.explode("prefix").alias("h")), "posts")
    shared = posts.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h")
    posts = scratch.keep(posts.join(shared, "h"), "posts")
    comp_of = nodes.select(F.col("node").alias("gid"), "comp")
    for number in range(ROUNDS):
        now = _undecided(posts, comp_of)
        fits = f"ca <> cb and 100 * least(na, nb) >= {percent} * greatest(na, nb)"
        mine = now.select("h", F.col("gid").alias("ga"), F.col("n").alias("na"), F.col("comp").alias("ca"))
        seeds = [F.min_by(F.struct("gid", "n", "comp"), F.xxhash64("gid", F.lit(number * PIVOTS + i))) for i in range(PIVOTS)]
        pivots = now.groupBy("h").agg(F.array(*seeds).alias("p")).select("h", F.explode("p").alias("p"))
        pairs = mine.join(pivots.select("h", F.col("p.gid").alias("gb"), F.col("p.n").alias("nb"), F.col("p.comp").alias("cb")), "h").where(fits)
        pairs = pairs.select("ga", "gb").distinct()
        pairs = pairs.join(members.select(F.col("gid").alias("ga"), F.col("node").alias("a")), "ga").join(members.select(F.col("gid").alias("gb"), F.col("node").alias("b")), "gb")
        found = scratch.keep(_verify(pairs, sets, percent), "found")
        links = scratch.keep(links.union(found), "all-links")
        comps = connected_components(links, scratch)
        comp_of = nodes.select(F.col("node").alias("gid")).join(comps.withColumnRenamed("node", "gid"), "gid", "left").withColumn("comp", F.coalesce("comp", "gid"))
        comp_of = scratch.keep(comp_of, "comp")
    now = scratch.keep(_undecided(posts, comp_of), "undecided")
    if not now.limit(1).count():
        return comps
    found = _between_blocks(now, members, comp_of, sets, percent, scratch)
    return connected_components(scratch.keep(links.union(found), "all-links"), scratch)


def _undecided(posts: DataFrame, comp_of: DataFrame) -> DataFrame:
    """h, gid, n, comp of the shingles that are shared by groups of different components."""
    now = posts.join(comp_of, "gid")
    mixed = now.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("h")
    return now.join(mixed, "h").select("h", "gid", "n", "comp")


def _between_blocks(now: DataFrame, members: DataFrame, comp_of: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links between components, one for each two components of two blocks at least.

    Groups that shared shingles chain together are a cluster; its members stand in blocks of about BLOCK_NODES, with
    large components in blocks of their own. Two blocks are compared as a whole in one task, set against set, so
    their pairs are never rows; blocks of one component aren't compared.
    """
    star = now.join(now.groupBy("h").agg(F.min("gid").alias("b")), "h").select(F.col("gid").alias("a"), "b").distinct()
    cluster = connected_components(star, scratch).select(F.col("node").alias("gid"), F.col("comp").alias("cluster"))
    part = scratch.keep(cluster.join(comp_of, "gid").join(members, "gid").select("cluster", "comp", "node"), "clusters")
    size = part.groupBy("cluster", "comp").agg(F.count("*").alias("c"))
    small = size.groupBy("cluster").agg(F.sum(F.when(F.col("c") * 2 <= BLOCK_NODES, F.col("c")).otherwise(0)).alias("rest"))
    wide = lambda n: F.ceil(F.col(n) / BLOCK_NODES).cast("long")
    one = F.col("c") * 2 > BLOCK_NODES
    placed = part.join(size, ["cluster", "comp"]).join(small, "cluster")
    placed = placed.select("cluster", "comp", "node", F.when(one, F.col("comp")).alias("alone"), F.when(one, F.pmod(F.xxhash64("node"), wide("c"))).otherwise(F.pmod(F.xxhash64("comp"), F.greatest(wide("rest"), F.lit(1)))).alias("sub"))
    full = placed.join(sets.select("node", "n", "shingles"), "node")
    blocks = full.groupBy("cluster", "alone", "sub").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.collect_list(F.struct("node", "comp", "shingles")).alias("m"))
    blocks = scratch.keep(blocks.withColumn("id", F.struct(F.coalesce("alone", F.lit(-1)).alias("k"), "sub")), "blocks")
    light = blocks.select("cluster", "id", "alone", "lo", "hi")
    two = light.alias("x").join(light.alias("y"), F.expr(f"x.cluster = y.cluster and x.id <= y.id and not (x.alone <=> y.alone and x.alone is not null) and 100 * x.hi >= {percent} * y.lo and 100 * y.hi >= {percent} * x.lo"))
    two = two.select("x.cluster", F.col("x.id").alias("i"), F.col("y.id").alias("j"))
    met = two.join(blocks.select("cluster", F.col("id").alias("i"), F.col("m").alias("x")), ["cluster", "i"]).join(blocks.select("cluster", F.col("id").alias("j"), F.col("m").alias("y")), ["cluster", "j"])
    return scratch.keep(met.select("x", "y").mapInArrow(_compare(percent), "a long, b long"), "found")


def _compare(percent: int):
    def flat(block):
        m = block.values
        lists = m.field("shingles")
        n = np.diff(np.asarray(lists.offsets))
        n = n[: len(m)]
        h = np.asarray(lists.flatten())
        return np.asarray(m.field("node")), np.asarray(m.field("comp")), n, h, np.repeat(np.arange(len(n)), n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                (xi, xc, xn, xh, xo), (yi, yc, yn, yh, yo) = flat(x), flat(y)
                order = np.argsort(yh, kind="stable")
                yh, yo = yh[order], yo[order]
                lo, hi = np.searchsorted(yh, xh, "left"), np.searchsorted(yh, xh, "right")
                common = np.zeros((len(xi), len(yi)), np.int64)
                for i, start in enumerate(np.cumsum(xn) - xn):  # one document against the other block
                    lo_i, len_i = lo[start : start + xn[i]], (hi - lo)[start : start + xn[i]]
                    if len_i.sum():
                        at = np.repeat(lo_i - np.cumsum(len_i) + len_i, len_i) + np.arange(len_i.sum())
                        common[i] = np.bincount(yo[at], minlength=len(yi))
                like = (100 * common >= percent * (xn[:, None] + yn[None, :] - common)) & (xc[:, None] != yc[None, :])
                i, j = np.nonzero(like)
                _, first = np.unique(np.column_stack((xc[i], yc[j])), axis=0, return_index=True)
                a.append(xi[i[first]])
                b.append(yi[j[first]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a) if a else [], pa.int64()), pa.array(np.concatenate(b) if b else [], pa.int64())], names=["a", "b"])

    return run


def keep_one_per_component(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """The rows of docs, all columns, less near copies: of each component the row with the smallest doc_id stays.

    Rows without words or without doc_id stay. Rows with one doc_id and one text are one document and one of them
    stays; a doc_id on different texts stands for different documents, and of those in one component the text with the
    smallest hash stays.
    """
    scratch = Scratch(docs.sparkSession, "ngram-jaccard")
    profile, classes = _classes(docs, size, percent, scratch)
    rows = profile.where("n > 0 and doc_id is not null").join(classes, ["n", "k1", "k2"])
    verdict = rows.groupBy("doc_id", "th").agg(F.count("*").alias("times"), F.first("first").alias("first"))
    verdict = verdict.select("doc_id", "th", F.expr("first <> struct(doc_id, th)").alias("goes"), F.expr("times > 1").alias("again")).where("goes or again")
    verdict = scratch.keep(verdict.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("goes").alias("__goes"), F.col("again").alias("__again")), "verdict")
    match = (docs.doc_id.cast("long") == F.col("__id")) & (F.xxhash64(docs.text.cast("string")) == F.col("__th"))
    again = scratch.keep(verdict.where("__again and not __goes").select("__id", "__th"), "again")  # a table of its own: mostly small enough for a broadcast
    once = docs.join(verdict, match, "left_anti")
    stays = docs.join(again, match, "left_semi")
    return once.unionByName(stays.dropDuplicates(["doc_id", "text"]))
