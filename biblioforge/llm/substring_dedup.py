"""Substring dedup with a compressed FM-index per shard (operator 12).

A window of `size` words that also starts anywhere else is repeated, and every word of it goes. Documents are cut into
segments: the runs of windows that have the same minimizer (the leftmost 12-word shingle with the least hash). Equal
windows have equal minimizers at equal places, so all copies of a window lie in segments of one minimizer, and no two
windows of one segment are equal. Shards are made of whole minimizers: each window meets its copies in one shard, and the
work grows with the text, not with shards times documents.

1. Minimizers are counted; what occurs once has no copies and leaves.
2. Equal segments of a minimizer are one class. All windows of a segment whose class has two occurrences are repeated;
   copies of whole documents and passages end here.
3. Different segments of one minimizer may still share windows, at the edges of passages and of edits. One segment of
   each class goes to the minimizer's shard. There they are indexed together: suffix array by prefix doubling over word
   ids, its Burrows-Wheeler transform in a wavelet matrix of packed bits, and LCP values. The segments that occur once are
   streamed, all at a time from right to left: a backward search step prepends a word; where fewer than two suffixes are
   left, the match is cut to its parent interval. That gives each position's matching statistic (the longest word
   sequence from there that occurs twice), and positions with `size` words or more start repeated windows.
4. A minimizer with more than `limit` different segments (a phrase in very many contexts) is split into its windows
   instead: each is a segment of its own, so rule 2 decides it exactly and no shard grows with the phrase.

Words and shingles are 64-bit hashes; shingle and segment hash together are a segment's name. Only hashes and positions
are shuffled, besides the two joins that bring decisions to the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioforge.llm.common import Scratch, _power_tables, hashed_words, mix, window_hashes, word_hashes, word_spans

SIZE, SHINGLE = 35, 12
GROUP_BYTES = 1 << 20
SHARD_WORDS, LIMIT = 300_000, 2000
#: An occurrence: 27 bits of the text's hash, 32 of the first word's number, 5 of the number of windows.
_START, _COUNT = 37, 5


class WaveletMatrix:
    """A sequence of symbols as one packed bit vector per bit, with block counts."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, now = bits, [], symbols
        for b in range(bits - 1, -1, -1):
            bit = (now >> b & 1).astype(bool)
            padded = np.zeros((len(now) // 64 + 1) * 64, bool)
            padded[: len(now)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((words, before, int((~bit).sum())))
            now = np.concatenate([now[~bit], now[bit]])
        self.base = self.place(np.arange(1 << bits), np.zeros(1 << bits, np.int64))

    def place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the positions `at` lead on the paths of the symbols."""
        for b, (words, before, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            block = at >> 6
            ones = before[block] + np.bitwise_count(words[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(symbols >> b & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        return self.place(symbols, at) - self.base[symbols]


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of pieces of words (numbers from 1) in order, and the longest common prefix of each with the next. Piece ends (0) differ from each other, so no prefix goes across one."""
    n = len(text)
    ends = text == 0
    rank = text + int(ends.sum()) - 1
    rank[ends] = np.arange(ends.sum())
    rank = np.unique(rank, return_inverse=True)[1]
    ranks, step = [rank], 1
    while rank.max() < n - 1:
        next_rank = np.full(n, -1)
        next_rank[: n - step] = rank[step:]
        key = rank * (n + 1) + next_rank + 1
        order = np.argsort(key)
        fresh = np.ones(n, np.int64)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        ranks.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    # LCP of neighbours from the ranks at each depth.
    same = np.zeros(n - 1, np.int64)
    for depth in range(len(ranks) - 1, -1, -1):
        a, b = order[:-1] + same, order[1:] + same
        inside = np.maximum(a, b) < n
        equal = inside & (ranks[depth][np.minimum(a, n - 1)] == ranks[depth][np.minimum(b, n - 1)])
        same[equal] += 1 << depth
    return order, same


def joined(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One text of pieces of word hashes for suffix_array(), and where each begins."""
    lengths = np.array([len(p) for p in pieces])
    ends = np.cumsum(lengths + 1) - 1
    text = np.zeros(int(ends[-1]) + 1, np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.unique(np.concatenate(pieces), return_inverse=True)[1] + 1
    return text, ends - lengths


class FMIndex:
    """Index of pieces of words (numbers from 1). Piece ends (0) differ from each other, so no match goes across one."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        order, same = suffix_array(text)
        self.n, self.lcp = n, np.concatenate([[-1], same, [-1]])
        self.before, self.after = self._smaller()
        counts = np.bincount(text)
        self.first = np.cumsum(counts) - counts
        self.bwt = WaveletMatrix(text[order - 1], max(1, int(text.max()).bit_length()))

    def _smaller(self) -> tuple[np.ndarray, np.ndarray]:
        """For each LCP value the nearest smaller one before and after it. Pieces are short, so there are few values."""
        at = np.arange(self.n + 1)
        before, after = np.zeros(self.n + 1, np.int64), np.full(self.n + 1, self.n)
        for v in np.unique(self.lcp):
            here = np.flatnonzero(self.lcp == v)
            before[here] = np.maximum.accumulate(np.where(self.lcp < v, at, 0))[here]
            after[here] = np.minimum.accumulate(np.where(self.lcp < v, at, self.n)[::-1])[::-1][here]
        return before, after

    def extend(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[words] + self.bwt.rank(words, at)

    def matching_statistics(self, pieces: np.ndarray) -> np.ndarray:
        """pieces: (rows, columns) of words, padded with 0 at the end -> length of the longest match from each word that occurs twice in the index."""
        rows, columns = pieces.shape
        low, high, length = np.zeros(rows, np.int64), np.full(rows, self.n), np.zeros(rows, np.int64)
        out = np.zeros(pieces.shape, np.int64)
        for j in range(columns - 1, -1, -1):
            todo = np.flatnonzero(pieces[:, j])
            while len(todo):
                w = pieces[todo, j]
                lo, hi = self.extend(w, low[todo]), self.extend(w, high[todo])
                fits = hi - lo >= 2
                done = todo[fits]
                low[done], high[done] = lo[fits], hi[fits]
                length[done] += 1
                todo = todo[~fits & (length[todo] > 0)]
                # The parent interval: the next shorter match that occurs more often.
                lo, hi = low[todo], high[todo]
                depth = np.maximum(self.lcp[lo], self.lcp[hi])
                low[todo] = np.where(self.lcp[lo] == depth, self.before[lo], lo)
                high[todo] = np.where(self.lcp[hi] == depth, self.after[hi], hi)
                root = depth <= 0
                low[todo[root]], high[todo[root]] = 0, self.n
                length[todo] = np.maximum(depth, 0)
            out[:, j] = length
        return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least value of each window, by doubling."""
    n = len(values) - width + 1
    best, at, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        keep = best[: len(best) - step] <= best[step:]
        at = np.where(keep, at[: len(at) - step], at[step:])
        best = np.minimum(best[: len(best) - step], best[step:])
        span += step
    return at[:n]


def segments(texts: list[bytes], size: int, shingle: int, named: bool) -> tuple[np.ndarray, ...]:
    """(minimizer, name, text number, first word, number of windows) of the segments of some texts; names only if asked for."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, ends = word_spans(raw)
    none = np.empty(0, np.int64)
    if len(starts) < size:
        return (none,) * 5
    words = word_hashes(raw, starts, ends)
    of = np.searchsorted(offsets, starts, "right") - 1
    keys = window_hashes(words, shingle)
    at = _least(keys, size - shingle + 1)
    valid = of[: len(at)] == of[size - 1 :]
    cut = np.flatnonzero((at[1:] != at[:-1]) | (valid[1:] != valid[:-1])) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]])
    first, last = first[valid[first]], last[valid[first]]
    name = none
    if named:
        up, down = _power_tables(len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=sums[1:])
        end = last + size - 1
        name = mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64)).view(np.int64)
    text = of[first]
    return keys[at[first]].view(np.int64), name, text, first - np.searchsorted(starts, offsets)[text], last - first


def _segment_rows(size: int, shingle: int, named: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
            ids, th = b.column("doc_id").to_numpy(), b.column("th").to_numpy()
            at = 0
            while at < len(texts):
                stop, held = at, 0
                while stop < len(texts) and (stop == at or held + len(texts[stop]) <= GROUP_BYTES):
                    held += len(texts[stop])
                    stop += 1
                m, name, text, first, n = segments(texts[at:stop], size, shingle, named)
                if named:
                    o = (th[at:stop][text] << _START) | (first << _COUNT) | n
                    yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(name), pa.array(ids[at:stop][text]), pa.array(o)], names=["m", "h", "doc_id", "o"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(m)], names=["m"])
                at = stop

    return run


def _pieces(size: int):
    """Texts with the segments that are wanted of them -> their word hashes; of crowded minimizers, their windows' hashes."""

    def run(batches):
        for b in batches:
            out = []
            for doc, th, text, wanted in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "text", "wanted")), strict=True):
                words = hashed_words(text)
                windows = None
                for x in wanted:
                    o = x["o"]
                    first, n = o >> _COUNT & 0xFFFFFFFF, o & 31
                    if x["crowded"]:
                        windows = window_hashes(words, size).view(np.int64) if windows is None else windows
                        out += [(x["m"], int(windows[i]), doc, (th << _START) | (i << _COUNT) | 1, x["many"], None) for i in range(first, first + n)]
                    else:
                        out.append((x["m"], None, doc, o, x["many"], words[first : first + n + size - 1].tobytes()))
                if len(out) > 5000:
                    yield _piece_batch(out)
                    out = []
            yield _piece_batch(out)

    return run


_PIECE = "m bigint, h bigint, doc_id bigint, o bigint, many boolean, words binary"


def _piece_batch(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
    cells = list(zip(*rows, strict=True)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=[x.split()[0] for x in _PIECE.split(", ")])


def repeated_starts(pieces: list[np.ndarray], asked: np.ndarray, size: int) -> list[np.ndarray]:
    """Pieces of word hashes, all different, in one index -> for each piece asked for, the places from which `size` words occur twice."""
    lengths = np.array([len(p) for p in pieces])
    text, begins = joined(pieces)
    index = FMIndex(text)
    some = np.flatnonzero(asked)
    table = np.zeros((len(some), lengths.max()), np.int64)
    for row, p in enumerate(some):
        table[row, : lengths[p]] = text[begins[p] : begins[p] + lengths[p]]
    found = index.matching_statistics(table) >= size
    return [np.flatnonzero(f) for f in found]


def _search_shard(size: int):
    def run(table: pa.Table) -> pa.Table:
        pieces = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
        asked = ~np.asarray(table.column("many"), bool)
        ids, o = np.asarray(table.column("doc_id")), np.asarray(table.column("o"))
        out_id, out_th, out_lo, out_hi = [], [], [], []
        if asked.any() and len(pieces) > 1:
            for p, starts in zip(np.flatnonzero(asked), repeated_starts(pieces, asked, size), strict=True):
                if len(starts):
                    runs = np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1)
                    first = int(o[p]) >> _COUNT & 0xFFFFFFFF
                    for r in runs:
                        out_id.append(int(ids[p]))
                        out_th.append(int(o[p]) >> _START)
                        out_lo.append(first + int(r[0]))
                        out_hi.append(first + int(r[-1]) + size)
        return pa.table([pa.array(x, pa.int64()) for x in (out_id, out_th, out_lo, out_hi)], names=["doc_id", "th", "lo", "hi"])

    return run


def _hashed(docs: DataFrame) -> tuple[Column, Column]:
    return F.col("doc_id").cast("long"), F.shiftright(F.xxhash64(F.col("text").cast("string")), _START)


def repeated_spans(docs: DataFrame, scratch: Scratch, size: int = SIZE, shingle: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """doc_id, th (27 bits of the text's hash), spans: the word ranges (lo << 32 | hi) of the documents that repeated windows cover."""
    if not shingle <= size < shingle + 31:
        raise ValueError("windows must be longer than shingles, by 30 words at most")
    doc_id, th = _hashed(docs)
    plain = docs.select(doc_id.alias("doc_id"), th.alias("th"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    shared = plain.mapInArrow(_segment_rows(size, shingle, False), "m bigint").groupBy("m").count().where("count > 1").select("m")
    shared = scratch.keep(shared, "shared")
    occurrences = plain.mapInArrow(_segment_rows(size, shingle, True), "m bigint, h bigint, doc_id bigint, o bigint")
    occurrences = scratch.keep(occurrences.join(shared, "m", "left_semi"), "occurrences")

    def classes(rows: DataFrame) -> DataFrame:
        """One occurrence of each class; many: whether there are others. A repeated row of docs is no other."""
        other = (F.min("doc_id") != F.max("doc_id")) | (F.min("o") != F.max("o"))
        return rows.groupBy("m", "h").agg(other.alias("many"), F.first("doc_id").alias("doc_id"), F.first("o").alias("o"))

    def all_of(rows: DataFrame, named: DataFrame) -> DataFrame:
        """Spans of all occurrences of the classes that have several."""
        named = named.where("many").select("m", "h")
        out = rows.join(named, ["m", "h"], "left_semi")
        lo = F.shiftright("o", _COUNT).bitwiseAND(0xFFFFFFFF)
        return out.select("doc_id", F.shiftright("o", _START).alias("th"), lo.alias("lo"), (lo + F.col("o").bitwiseAND(31) + size - 1).alias("hi"))

    named = scratch.keep(classes(occurrences), "classes")
    sizes = scratch.keep(named.groupBy("m").agg(F.count("*").alias("different"), F.count_if(~F.col("many")).alias("open")).where("different > 1 and open > 0"), "sizes")
    total = sizes.where(F.col("different") <= limit).agg(F.sum("different")).first()[0] or 0
    shards = total * (2 * size - shingle) // SHARD_WORDS + 1
    wanted = named.join(sizes.select("m", (F.col("different") > limit).alias("crowded")), "m")
    item = F.struct("m", "o", "many", "crowded")
    wanted = wanted.groupBy("doc_id", F.shiftright("o", _START).alias("th")).agg(F.collect_list(item).alias("wanted"))
    # Rows that repeat a document would give its pieces again.
    fetched = plain.join(wanted, ["doc_id", "th"]).groupBy("doc_id", "th").agg(F.first("text").alias("text"), F.first("wanted").alias("wanted"))
    pieces = scratch.keep(fetched.mapInArrow(_pieces(size), _PIECE), "pieces")
    spans = pieces.where("words is not null").groupBy(F.pmod(F.xxhash64("m"), F.lit(shards)).alias("shard")).applyInArrow(_search_shard(size), "doc_id bigint, th bigint, lo bigint, hi bigint")
    spans = spans.union(all_of(occurrences, named))
    windows = pieces.where("h is not null")
    spans = spans.union(all_of(windows.where("not many"), scratch.keep(classes(windows), "windows")))
    packed = F.shiftleft(F.col("lo"), 32).bitwiseOR(F.col("hi"))
    return scratch.keep(spans.groupBy("doc_id", "th").agg(F.collect_list(packed).alias("spans")), "spans")


def _without(text: pa.Array, spans: pa.Array) -> pa.Array:
    kept, n_words, n_removed = [], [], []
    for t, own in zip(text.to_pylist(), spans.to_pylist(), strict=True):
        words = (t or "").encode("utf-8", "surrogatepass").split()  # at \x20 and \x09-\x0D alone
        n_words.append(len(words))
        if own:
            edge = np.zeros(len(words) + 1, np.int64)
            own = np.array(own, np.int64)
            np.add.at(edge, own >> 32, 1)
            np.add.at(edge, own & 0xFFFFFFFF, -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
        n_removed.append(n_words[-1] - len(words))
        kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
    return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=["text", "n_words", "n_removed"])


def dedup_substrings(docs: DataFrame, size: int = SIZE, shingle: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """All columns of docs with `text` as its kept words, joined by one space, and n_words, n_removed, which replace columns of these names.

    docs: doc_id, text and any other columns. A null text has no words and becomes empty. Rows without doc_id lose
    nothing and are no copies of others. Rows that repeat doc_id and text are one document with one result; a doc_id on
    different texts is several documents. A window that overlaps its own copy (a word over and over) is repeated too.
    Texts under `size` words stay whole. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    doc_id, th = _hashed(docs)
    spans = repeated_spans(docs, scratch, size, shingle, limit)
    # Rows travel as one column, so no name of docs can clash with the join's.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), doc_id.alias("doc_id"), th.alias("th"), F.col("text").cast("string").alias("text"))
    # The same join at every size, so that the shuffle grows with the input alone.
    out = rows.join(spans.hint("merge"), ["doc_id", "th"], "left")
    out = out.withColumn("kept", F.arrow_udf(_without, "text string, n_words bigint, n_removed bigint")("text", "spans"))
    new = ["n_words", "n_removed"]
    return out.select(*[(F.col("kept.text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c not in new], *[F.col(f"kept.{c}").alias(c) for c in new])
