"""Shared n-grams of two sides of texts: packed texts, and blocks of them whose pairs are counted in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc

#: Pairs of grams that a block keeps of its rows at most; more, and its postings are counted instead.
MOST_PAIRS = 12_000_000
#: Hits that are sorted at a time, and rows of a batch that goes out.
HITS, ROWS = 1 << 18, 1 << 19
#: Ids of a text that travel with one copy of it.
COPIES = 64
PACKS = "_n long, _chars long, _packed binary"


def gram_codes(texts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of every n-gram of the texts as ngrams() has them; equal grams have equal codes, also in other calls for n up to 3."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    grams = np.maximum(sizes - n + 1, 1)
    row = np.repeat(np.arange(len(texts)), grams)
    at = np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams)
    start, size = np.repeat(np.cumsum(sizes) - sizes, grams), np.repeat(sizes, grams)
    code = np.zeros(len(row), np.int64)
    for k in range(n):
        inside = at + k < size  # a text shorter than n is one gram, filled up with what no text holds
        code = (code << 21) | np.where(inside, chars[np.where(inside, start + at + k, 0)], 0x1FFFFF)
    return row, code


def pack_texts(most_chars: int):
    """Arrow iterator: rows (id, text), equal texts side by side -> compressed tables (text, ids) of at most so many characters, numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        for b in batches:
            if not b.num_rows:
                continue
            texts, ids = b.column("text").to_pylist(), b.column("id")
            starts = [0]
            for k in range(1, len(texts)):
                if texts[k] != texts[k - 1] or k - starts[-1] == COPIES:
                    starts.append(k)
            starts.append(len(texts))
            sizes = np.cumsum([len(texts[k]) for k in starts[:-1]])
            first = 0
            while first < len(sizes):
                before = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, before + most_chars, "right")))
                own = starts[first : last + 1]
                lists = pa.ListArray.from_arrays(pa.array([k - own[0] for k in own], pa.int32()), ids.slice(own[0], own[-1] - own[0]))
                t = pa.table({"text": pa.array([texts[k] for k in own[:-1]], pa.large_string()), "ids": lists})
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_table(t)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sizes[last - 1] - before], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["_n", "_chars", "_packed"])
                number, first = number + 1, last

    return run


def _unpack(packs: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, where the ids of each begin, and the ids."""
    t = pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in packs])
    sizes = t["ids"].combine_chunks().value_lengths().to_numpy()
    return t["text"].to_pylist(), np.concatenate(([0], np.cumsum(sizes))), t["ids"].combine_chunks().flatten().to_numpy()


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the runs."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _sorted_pairs(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) by a, then b, each once; b is under `most`. As one number each, which sorts faster than two."""
    key = a * most + b
    key.sort()
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    a = key // most
    return a, key - a * most


class Block:
    """Index texts in arrays: which of them share enough grams with a text.

    Grams are dealt into `m` groups. A row that shares t different grams with a query shares at least
    least_hits(t, m) pairs of grams that lie in one group. Pairs are far rarer than grams, so the rows with that many common
    pairs are few; their shared grams are then counted. Where few grams are asked for, or pairs are as frequent as grams, a counter for each
    row is added up over the postings of the query's grams.
    """

    def __init__(self, texts: list[str], n: int):
        self.n, self.rows = n, len(texts)
        row, code = gram_codes(texts, n)
        self.codes = np.unique(code)
        self.row, self.gram = _sorted_pairs(row, np.searchsorted(self.codes, code), len(self.codes))
        chars = [((self.codes >> s) & 0x1FFFFF) * 0x9E3779B1 & 0xFFFFFFFF for s in (21, 0)]
        mixed = (self.codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        self.group = (chars[0] > chars[1]) | (mixed.astype(np.int64) << 1)  # grams side by side in a text are seldom in one group
        gram, row = _sorted_pairs(self.gram, self.row, self.rows)
        self.postings, self.begin = row.astype(np.int32), np.searchsorted(gram, np.arange(len(self.codes) + 1))
        self.pairs: dict[int, tuple | None] = {}
        self.wide: np.ndarray | None = None

    def _pairs(self, row: np.ndarray, gram: np.ndarray, m: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, bucket) of each pair of a row's grams in one of m groups."""
        group, gram = _sorted_pairs(row * m + (self.group[gram] & (m - 1)), gram, len(self.codes))
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        before = _runs(np.diff(np.append(first, len(gram))))
        left = np.repeat(np.arange(len(gram)), before)
        right = left - 1 - _runs(before)
        mixed = gram[left].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + gram[right].astype(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return group[left] // m, (mixed >> np.uint64(64 - bits)).astype(np.int64)

    def _index(self, m: int) -> tuple | None:
        """Rows by buckets of pairs; the last two asked for are kept."""
        if m not in self.pairs:
            sizes = np.bincount(self.row * m + (self.group[self.gram] & (m - 1)))
            number = int((sizes * (sizes - 1) // 2).sum())
            found = None
            if 0 < number <= MOST_PAIRS:
                bits = min(max(int(number).bit_length(), 8), 23)
                # The rows a stretch at a time: what lies between is several times as large as the index.
                both, done = np.empty(number, np.uint64), 0
                step = max(1, self.rows * (1 << 20) // number)
                for k in range(0, self.rows, step):
                    lo, hi = np.searchsorted(self.row, [k, k + step])
                    row, bucket = self._pairs(self.row[lo:hi], self.gram[lo:hi], m, bits) if hi > lo else (np.empty(0, np.int64),) * 2
                    both[done : done + len(row)] = (bucket.astype(np.uint64) << np.uint64(32)) | row.astype(np.uint64)
                    done += len(row)
                both.sort()
                begin = np.zeros((1 << bits) + 1, np.int32)
                for k in range(0, number, 1 << 20):
                    bucket, times = np.unique(both[k : k + (1 << 20)] >> np.uint64(32), return_counts=True)
                    begin[bucket.astype(np.int64) + 1] += times.astype(np.int32)
                found = bits, np.cumsum(begin, dtype=np.int32), (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            while len(self.pairs) > 1:
                del self.pairs[next(iter(self.pairs))]
            self.pairs[m] = found
        return self.pairs[m]

    def shared(self, texts: list[str], overlap: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, row, shared) of texts and index rows with at least max(1, int(overlap * grams)) shared grams, repeats of a query's gram counted."""
        q, code = gram_codes(texts, self.n)
        need = np.maximum(1, np.floor(np.bincount(q) * overlap)).astype(np.int64)
        gram = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[gram] == code
        q, gram = q[known], gram[known]
        one_q, one_gram = _sorted_pairs(q, gram, len(self.codes))
        held, different = np.bincount(q, minlength=len(texts)), np.bincount(one_q, minlength=len(texts))
        least = np.maximum(need - (held - different), 1)  # that many different grams at least
        ends, one_ends = (np.searchsorted(x, np.arange(len(texts) + 1)) for x in (q, one_q))
        can = held >= need
        for t in np.unique(least[can]).tolist():
            own = np.flatnonzero(can & (least == t))
            m = 2 if t == 3 else 1 << max(t // 2, 1).bit_length() - 1
            index = self._index(m) if t > 1 else None
            step = 1024 if index else len(own)
            for k in range(0, len(own), step):
                part = own[k : k + step]
                found = None
                if index:
                    sizes = np.diff(one_ends)[part]
                    at = np.repeat(one_ends[part], sizes) + _runs(sizes)
                    found = self._by_pairs(np.repeat(np.arange(len(part)), sizes), one_gram[at], t, m, index, part, q, gram, ends, need)
                yield from self._counted(part, gram, ends, need) if found is None else found

    def _by_pairs(self, row, one, t, m, index, part, q, gram, ends, need) -> list | None:
        """Results of queries that need t different grams; none where counting all rows takes less time."""
        bits, begin, rows = index
        pair_q, bucket = self._pairs(row, one, m, bits)
        lo, hi = begin[bucket], begin[bucket + 1]
        some = hi > lo
        pair_q, lo, size = pair_q[some], lo[some].astype(np.int64), (hi - lo)[some].astype(np.int64)
        added = int((self.begin[one + 1] - self.begin[one]).sum())
        if 6 * int(size.sum()) > added + len(part) * (self.rows // 10 + 4000):  # a hit costs some six additions
            return None
        hits, out = least_hits(t, m), []
        ahead = np.cumsum(size)
        cuts = np.searchsorted(pair_q, np.arange(len(part) + 1))
        total = np.concatenate(([0], ahead))[cuts]  # hits before each query
        k = 0
        while k < len(part):
            last = max(k + 1, int(np.searchsorted(total, total[k] + HITS, "right")) - 1)
            a, b = cuts[k], cuts[last]
            n = size[a:b]
            kind = np.uint32 if (last - k) * self.rows < 1 << 32 else np.int64
            stop = np.cumsum(n)
            at = np.repeat((lo[a:b] - (stop - n)).astype(np.int32), n)
            at += np.arange(len(at), dtype=np.int32)
            key = rows[at].astype(kind, copy=False)
            key += np.repeat(((pair_q[a:b] - k) * self.rows).astype(kind), n)
            key.sort()
            often = key[: len(key) - hits + 1][key[hits - 1 :] == key[: len(key) - hits + 1]] if len(key) >= hits else key[:0]
            if len(often):
                often = often[np.concatenate(([True], often[1:] != often[:-1]))].astype(np.int64)
                out += self._exact(part[often // self.rows + k], often % self.rows, gram, ends, need)
            k = last
        return out

    def _exact(self, q: np.ndarray, r: np.ndarray, gram, ends, need) -> list:
        """The shared grams of pairs, of those with enough."""
        out = []
        if self.wide is None:
            sizes = np.bincount(self.row, minlength=self.rows)
            self.sizes, width = sizes, int(min(sizes.max(), 4 * len(self.row) // self.rows + 1))
            at = _runs(sizes)
            fits = at < width
            kind = np.uint16 if len(self.codes) < 65_534 else np.int32
            self.wide = np.full((width, self.rows), len(self.codes), kind)
            self.wide[at[fits], self.row[fits]] = self.gram[fits]
            self.key = None
        lengths = ends[q + 1] - ends[q]
        fits = (self.sizes[r] <= len(self.wide)) & (lengths * len(self.wide) <= 2048)
        for own, count in ((fits, self._by_columns), (~fits, self._by_search)):
            qs, rs = q[own], r[own]
            for k in range(0, len(qs), 1 << 13):
                a, b = qs[k : k + (1 << 13)], rs[k : k + (1 << 13)]
                shared = count(a, b, gram, ends)
                enough = shared >= need[a]
                if enough.any():
                    out.append((a[enough], b[enough], shared[enough]))
        return out

    def _by_columns(self, q, r, gram, ends):
        rows = self.wide[:, r]
        sizes, shared = ends[q + 1] - ends[q], np.zeros(len(q), np.int32)
        for k in range(int(sizes.max())):
            own = np.where(k < sizes, gram[np.minimum(ends[q] + k, len(gram) - 1)], len(self.codes) + 1).astype(self.wide.dtype)
            shared += np.bitwise_or.reduce((rows == own).view(np.uint8), axis=0)
        return shared

    def _by_search(self, q, r, gram, ends):
        if self.key is None:
            self.key = self.row * len(self.codes) + self.gram
        shared = []
        for a, b in zip(q.tolist(), r.tolist()):  # long texts, few of them
            key = b * len(self.codes) + gram[ends[a] : ends[a + 1]]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            shared.append(int((self.key[at] == key).sum()))
        return np.array(shared, np.int32)

    def _counted(self, part, gram, ends, need):
        kind = np.uint8 if int((ends[part + 1] - ends[part]).max()) < 256 else np.int32
        counter, one = np.zeros(self.rows, kind), kind(1)
        lo, hi, ends = self.begin[gram].tolist(), self.begin[gram + 1].tolist(), ends.tolist()
        out, size = [], 0
        for q in part.tolist():
            for g in range(ends[q], ends[q + 1]):
                counter[self.postings[lo[g] : hi[g]]] += one
            found = np.flatnonzero(counter >= need[q])
            if len(found):
                out.append((np.full(len(found), q), found, counter[found].astype(np.int32)))
                size += len(found)
                if size > ROWS:
                    yield tuple(np.concatenate(x) for x in zip(*out))
                    out, size = [], 0
            counter[:] = 0
        if out:
            yield tuple(np.concatenate(x) for x in zip(*out))


def least_hits(t: int, m: int) -> int:
    """The fewest pairs in one group that t things in m groups make: those of groups as even as can be."""
    a, b = divmod(t, m)
    return m * (a * (a - 1) // 2) + a * b


def meet(left: pa.Table, right: pa.Table) -> pa.Table:
    """Arrow cogroup: a cell's packs of queries and of index rows -> the index packs (side 0), then the queries (side 1)."""
    if not left.num_rows or not right.num_rows:
        left, right = left.slice(0, 0), right.slice(0, 0)
    sides = [pa.table([pa.array([k] * t.num_rows, pa.int32()), t["_packed"].cast(pa.binary())], names=["side", "_packed"]) for k, t in enumerate((right, left))]
    return pa.concat_tables(sides)


def count_cells(overlap: float, n: int):
    """Arrow iterator: cells as meet() gives them, one after the other -> (q, r, shared), in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: list[bytes] = []
        block, begin, ids = None, None, None
        for b in batches:
            for side, packed in zip(b.column("side").to_pylist(), b.column("_packed")):
                if side == 0:
                    block = None
                    packs.append(packed.as_py())
                    continue
                if block is None:
                    texts, begin, ids = _unpack(packs)
                    block, packs = Block(texts, n), []
                texts, own_begin, own = _unpack([packed.as_py()])
                waiting, size = [], 0
                for q, r, shared in block.shared(texts, overlap):
                    many = (own_begin[q + 1] - own_begin[q]) * (begin[r + 1] - begin[r])
                    ahead = np.cumsum(many)
                    k = 0
                    while k < len(q):
                        before = ahead[k - 1] if k else 0
                        last = max(k + 1, int(np.searchsorted(ahead, before + ROWS, "right")))
                        x, y, times = q[k:last], r[k:last], many[k:last]
                        inner, width = _runs(times), np.repeat(begin[y + 1] - begin[y], times)
                        waiting.append((own[np.repeat(own_begin[x], times) + inner // width], ids[np.repeat(begin[y], times) + inner % width], np.repeat(shared[k:last], times)))
                        size += len(inner)
                        if size > ROWS:
                            yield _rows(waiting)
                            waiting, size = [], 0
                        k = last
                if size:
                    yield _rows(waiting)

    return run


def _rows(parts: list) -> pa.RecordBatch:
    q, r, shared = (np.concatenate(x) for x in zip(*parts))
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(r, pa.int64()), pa.array(shared.astype(np.int64))], names=["q", "r", "shared"])
