"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 8).

A document holds a benchmark item if an item-sized window of its words is within `share` of the item's length in word
edit distance. Each window runs through the CGK random walk: it copies the word under the cursor and moves on if a
random bit of (step, word) says so, which maps a small edit distance to a small Hamming distance of two walks. Per
repetition SAMPLED positions of the walk are hashed to a key; items and windows meet on equal keys. Walks of L words end
near step 2 L; positions are drawn before that, and a repetition with a position where the walk has ended has no key, so
that ends never meet. Walks at 20 % of edits agree in about 0.7 of their positions (measured for 5 to 60 words), so they
meet with probability 1 - (1 - 0.7**SAMPLED)**REPEATS, over 0.99; unrelated ones share a word at a position seldom
and SAMPLED of them hardly ever. Every meeting is verified by exact edit distance.

Before the walk, windows that can't match are left out without loss: d edits leave at least L - 1 - 2d of the L - 1
neighbouring word pairs of an item, so a window needs that many pairs from the item's own.

The items are a stated query set: they go to all executors in blocks of bounded size, each block against all rows.
"""

from __future__ import annotations

import functools
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioforge.llm.bpe import groups
from biblioforge.llm.common import hashed_words, mix, word_hashes, word_spans

SHARE = 0.2  # edits allowed, as a share of the item's words
MIN_WORDS = 5  # shorter items are no evidence; a parameter of the operator, with 1 all items count
SAMPLED, REPEATS = 4, 24
BLOCK_WORDS = 1_000_000  # words of the items that travel at once
_SEP = b"\n"


def allowed(length: int, share: float = SHARE) -> int:
    return int(length * share)


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Word edit distance."""
    if len(a) == len(b) and (n := int((a != b).sum())) <= 1:
        return n
    steps = np.arange(len(b) + 1)
    row = steps
    for i, x in enumerate(a.tolist(), 1):
        best = np.empty(len(b) + 1, np.int64)
        best[0] = i
        np.minimum(row[1:] + 1, row[:-1] + (b != x), out=best[1:])
        row = np.minimum.accumulate(best - steps) + steps
    return int(row[-1])


def walk_steps(length: int) -> int:
    """Steps from which positions are drawn: most walks are still inside the text."""
    return max(1, 7 * length // 4)


def sampled_positions(length: int) -> np.ndarray:
    """REPEATS x SAMPLED positions of the walk over sequences of this length; the same on all executors."""
    return np.random.default_rng(length).integers(0, walk_steps(length), (REPEATS, SAMPLED))


def walks(words: np.ndarray, steps: int) -> np.ndarray:
    """Cursor of each walk at each step: (steps, rows, REPEATS) for a (rows, width) matrix of word hashes, 0 beyond a text.

    A walk doesn't know the item length; whoever samples it for a length takes a cursor beyond it as the end.
    """
    rows, width = words.shape
    padded = np.concatenate((words, np.zeros((rows, 1), np.uint64)), axis=1)
    cursor = np.zeros((rows, REPEATS), np.int32)
    out = np.empty((steps, rows, REPEATS), np.int32)
    at_row = np.arange(rows)[:, None]
    repeat = np.arange(1, REPEATS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for step in range(steps):
        out[step] = cursor
        here = padded[at_row, cursor]
        coin = (here ^ (repeat + np.uint64(step))) * np.uint64(0xD6E8FEB86659FD93)
        cursor = np.minimum(cursor + ((coin >> np.uint64(47)) & np.uint64(1)).astype(np.int32), width)
    return out


def sampled_keys(words: np.ndarray, cursors: np.ndarray, length: int) -> np.ndarray:
    """(rows, REPEATS) keys of the walks for items of this length; 0 where a sampled walk has ended."""
    picks = sampled_positions(length)
    padded = np.concatenate((words, np.zeros((len(words), 1), np.uint64)), axis=1)
    at_row, repeats = np.arange(len(words))[:, None], np.arange(REPEATS)
    key = np.broadcast_to(repeats.astype(np.uint64) + np.uint64(length << 8), (len(words), REPEATS))
    inside = np.ones(key.shape, bool)
    for k in range(SAMPLED):
        cursor = cursors[picks[:, k], at_row, repeats]
        word = np.where(cursor < length, padded[at_row, cursor], np.uint64(0))
        inside &= word != 0
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + word)
    return np.where(inside, key, np.uint64(0))


class Items:
    """Items of one block: word hashes by length, their pairs and their LSH tables."""

    def __init__(self, items: list[tuple[int, str]], share: float = SHARE, min_words: int = MIN_WORDS):
        self.words = {i: w for i, t in items if len(w := hashed_words(t, lower=True)) >= max(1, min_words)}
        self.share = share
        self.pairs = {i: np.unique(self.pair(w)) for i, w in self.words.items()}
        self.all_pairs = np.unique(np.concatenate(list(self.pairs.values()))) if self.pairs else np.empty(0, np.uint64)
        self.table: dict[int, dict[int, list[int]]] = {}
        by_length: dict[int, list[int]] = {}
        for i, w in self.words.items():
            by_length.setdefault(len(w), []).append(i)
        self.lengths = sorted(by_length)
        for n, own in by_length.items():
            table = self.table[n] = {}
            for k in range(0, len(own), self.rows(n)):
                part = own[k : k + self.rows(n)]
                w = np.stack([self.words[i] for i in part])
                for i, keys in zip(part, sampled_keys(w, walks(w, walk_steps(n)), n).tolist(), strict=True):
                    for x in filter(None, keys):
                        table.setdefault(x, []).append(i)
        # Which lengths of items each pair belongs to: bit k stands for the k-th length, and every 64th after it.
        self.bit = {n: k % 64 for k, n in enumerate(self.lengths)}
        self.mask = np.zeros(len(self.all_pairs), np.uint64)
        for i, p in self.pairs.items():
            self.mask[np.searchsorted(self.all_pairs, p)] |= np.uint64(1 << self.bit[len(self.words[i])])
        self.word_sets = {i: set(w.tolist()) for i, w in self.words.items()}
        self.pair_sets = {i: set(p.tolist()) for i, p in self.pairs.items()}
        # Few bits of the hash tell most foreign pairs at once.
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.all_pairs >> np.uint64(42)).astype(np.int64)] = True

    @staticmethod
    def pair(w: np.ndarray) -> np.ndarray:
        return mix(w[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[1:])

    def pair_at(self, w: np.ndarray, places: np.ndarray) -> np.ndarray:
        return mix(w[places] * np.uint64(0x9E3779B97F4A7C15) + w[places + 1])

    def known_pairs(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs that stand in an item, and their masks."""
        at = np.flatnonzero(self.bits[(pairs >> np.uint64(42)).astype(np.int64)])
        where = np.minimum(np.searchsorted(self.all_pairs, pairs[at]), len(self.all_pairs) - 1)
        same = self.all_pairs[where] == pairs[at]
        return at[same], self.mask[where[same]]

    @staticmethod
    def rows(length: int) -> int:
        """Walks at once, for bounded memory."""
        return max(8, (1 << 23) // (2 * length * REPEATS))

    def find(self, texts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first word, distance) of the items that texts hold; a text: its words, and known_pairs of its pairs."""
        wanted: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (text, start) -> (count of known pairs, length)
        for t, (w, places, masks) in enumerate(texts):
            totals = ((masks[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(0)
            for n in self.lengths:
                limit = allowed(n, self.share)
                size, need = min(n, len(w)), n - 1 - 2 * limit
                if size < n - limit:
                    break
                if totals[self.bit[n]] < need:
                    continue
                own = places[(masks >> np.uint64(self.bit[n])) & np.uint64(1) == 1]
                sums = np.zeros(len(w) + 1, np.int64)
                sums[own + 1] = 1
                sums = np.cumsum(sums)  # sums[k]: known pairs before place k
                count = sums[size - 1 : len(w)] - sums[: len(w) - size + 1]
                for s in np.flatnonzero(count >= need).tolist():
                    wanted.setdefault((t, s), []).append((int(count[s]), n))
        if not wanted:
            return
        # The windows with the most known pairs first: what they confirm needs no further look.
        order = sorted(wanted, key=lambda x: (x[0], -max(wanted[x])[0], x[1]))
        width = max(self.lengths)
        pairs_of = functools.lru_cache(4)(lambda t: self.pair_at(texts[t][0], texts[t][1]))
        found: set[tuple[int, int]] = set()
        far: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (text, item) -> windows that don't match, with their distance
        own_places: dict[tuple[int, int], list[int]] = {}  # (text, item) -> places of the item's pairs
        for k in range(0, len(order), self.rows(width)):
            part = order[k : k + self.rows(width)]
            words = np.zeros((len(part), width), np.uint64)
            for r, (t, s) in enumerate(part):
                w = texts[t][0][s : s + width]
                words[r, : len(w)] = w
            cursors = walks(words, max(walk_steps(n) for x in part for _, n in wanted[x]))
            by_length: dict[int, list[int]] = {}
            for r, x in enumerate(part):
                for _, n in wanted[x]:
                    by_length.setdefault(n, []).append(r)
            for n, at in by_length.items():
                table, limit = self.table[n], allowed(n, self.share)
                for r, keys in zip(at, sampled_keys(words[at], cursors[:, at], n).tolist(), strict=True):
                    t, s = part[r]
                    for i in {i for x in keys if x in table for i in table[x]}:
                        if (t, i) in found:
                            continue
                        w, places, _ = texts[t]
                        if (t, i) not in own_places:
                            own = self.pair_sets[i]
                            own_places[t, i] = [p for p, x in zip(places.tolist(), pairs_of(t).tolist(), strict=True) if x in own]
                        size = min(n, len(w) - s)
                        if bisect_left(own_places[t, i], s + size - 1) - bisect_left(own_places[t, i], s) < n - 1 - 2 * limit:
                            continue
                        if sum([x in self.word_sets[i] for x in w[s : s + size].tolist()]) < n - limit:  # an edit costs one word of the item at most
                            continue
                        # A window one word on is at most two edits away, so near a window that is far off none can match.
                        if any(d - 2 * abs(s - at) > limit for at, d in far.get((t, i), ())):
                            continue
                        d = edit_distance(w[s : s + size], self.words[i])
                        if d <= limit:
                            found.add((t, i))
                            yield t, i, s, d
                        else:
                            far.setdefault((t, i), []).append((s, d))


FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("distance", pa.int64())])


def _search(items: list[tuple[int, str]], share: float, min_words: int):
    made: list[Items] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:  # once per task
            made.append(Items(items, share, min_words))
        known = made[0]
        if not known.lengths:
            return
        least = min(n - 1 - 2 * allowed(n, share) for n in known.lengths)
        for ids, texts in groups(batches, 1 << 20):
            data = [(t or "").encode().lower() for t in texts]
            raw = np.frombuffer(_SEP.join(data), np.uint8)
            starts, ends = word_spans(raw)
            words = word_hashes(raw, starts, ends)
            size = np.array([len(d) + 1 for d in data])
            first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(size))))
            places, masks = known.known_pairs(known.pair(words)) if len(words) > 1 else (np.empty(0, np.int64), np.empty(0, np.uint64))
            owner = np.searchsorted(first, places, side="right") - 1
            inside = places + 1 < first[owner + 1]  # a pair across two documents is none
            places, masks, owner = places[inside], masks[inside], owner[inside]
            cuts = np.searchsorted(owner, np.arange(len(data) + 1))
            near = [k for k in np.flatnonzero(np.diff(cuts) >= least).tolist() if first[k + 1] > first[k]]
            spans = [(words[first[k] : first[k + 1]], places[cuts[k] : cuts[k + 1]] - first[k], masks[cuts[k] : cuts[k + 1]]) for k in near]
            out = [(ids[near[t]], *x) for t, *x in known.find(spans)]
            cols = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=FOUND)

    return run


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    block, held = [], 0
    for r in rows.dropDuplicates(["item_id", "text"]).toLocalIterator():
        block.append((r.item_id, r.text))
        held += len(r.text) // 2
        if held >= BLOCK_WORDS:
            yield block
            block, held = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, item_id, first_word, distance: the items that each document holds (its closest-looking window first).

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored. Words are split at ASCII white space and
    A-Z folded. Null or empty texts hold nothing; null items and items under min_words words match nothing; a null
    doc_id stays null. Repeated rows give repeated results; empty tables give none.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ddl = "doc_id long, item_id long, first_word long, distance long"
    out = docs.sparkSession.createDataFrame([], ddl)
    for block in _item_blocks(benchmark):
        out = out.union(docs.mapInArrow(_search(block, share, min_words), ddl))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """docs, all columns, without the documents that hold an item; rows are dropped where they are read."""
    at = docs.columns.index("text")
    for block in _item_blocks(benchmark):
        search = _search(block, share, min_words)

        def run(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = pa.RecordBatch.from_arrays([pa.array(np.arange(b.num_rows)), b.column(at).cast(pa.string())], names=["doc_id", "text"])
                keep = np.ones(b.num_rows, bool)
                for found in search(iter([rows])):
                    keep[np.asarray(found.column(0))] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
