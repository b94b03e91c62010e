"""BPE encoding and decoding by a pair occurrence index (operator 4).

The texts of a partition come in groups of some MB. Their words that are not known yet are laid out as one symbol
array with links to the neighbours. An index maps each mergeable pair to all its positions; the active rank that is
lowest is applied to all its positions at once, and only the lists of the pairs next to these positions are updated.
Words repeat, so the ids of recent ones stay in a cache of bounded size. Words are split and folded as the tokenizer
file says: NFC, lower case, white space dropped, special tokens found in the raw text. encode_ids() gives the ids,
decode_ids() the texts of ids, encode_digests() what a query reports of both.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_BYTES = 4 << 20  # text that is split and encoded at once
CACHE_BYTES = 24 << 20  # that a word cache holds before it forgets
ENTRY_BYTES = 150  # what an entry of a cache takes besides its contents


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes stand for themselves, the others follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b) if b in shown else chr(free)
        free += b not in shown
    return out


class PairIndex:
    """Merge table of a tokenizer file with word ends, and the encoder over it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.find_special = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")")
        self.tokens = {i: t for t, i in vocab.items()} | {i: t.decode() for t, i in self.special.items()}
        alphabet = byte_alphabet()
        self.to_byte = {c: b for b, c in enumerate(alphabet)}
        self.inner = np.array([vocab[c] for c in alphabet], np.int32)
        self.final = np.array([vocab[c + end] for c in alphabet], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = self.left << 32 | self.right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.by_pair = {(a, b): r for r, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist(), strict=True))}
        self._library, self.path = None, path

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it never merges."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def one_by_one(self, word: bytes) -> list[int]:
        """Plain encoding of one word: the lowest rank first, leftmost first."""
        s = [*self.inner[list(word[:-1])].tolist(), int(self.final[word[-1]])]
        while len(s) > 1:
            best = min((self.by_pair.get(p, 1 << 60), i) for i, p in enumerate(zip(s, s[1:], strict=False)))
            if best[0] == 1 << 60:
                break
            s[best[1] : best[1] + 2] = [int(self.made[best[0]])]
        return s

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word (none empty)."""
        if not words:
            return []
        size = np.array([len(w) for w in words])
        ends = np.cumsum(size)
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[raw]
        sym[ends - 1] = self.final[raw[ends - 1]]
        nxt = np.arange(1, len(raw) + 1, dtype=np.int32)
        nxt[ends - 1] = -1
        prv = np.arange(-1, len(raw) - 1, dtype=np.int32)
        prv[ends - size] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []
        odd: list[np.ndarray] = []

        def note(at: np.ndarray, now: int) -> None:
            at = at[nxt[at] >= 0]
            rank = self.rank_of(sym[at], sym[nxt[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if now >= 0 and (rank < now).any():
                odd.append(at[rank < now])  # a pair that should have come before: such words are done one by one
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.concatenate(([0], cuts))].tolist() if len(rank) else [], np.split(at, cuts), strict=False):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(part)

        note(np.arange(len(raw), dtype=np.int32), -1)
        while active:
            r = heapq.heappop(active)
            at = index.pop(r)
            at = np.unique(np.concatenate(at)) if len(at) > 1 else np.sort(at[0])
            at = at[(sym[at] == self.left[r]) & (nxt[at] >= 0)]
            at = at[sym[nxt[at]] == self.right[r]]
            if not len(at):
                continue
            if self.left[r] == self.right[r]:  # in a run of equal symbols every other pair, from the left
                fresh = np.concatenate(([True], nxt[at[:-1]] != at[1:]))
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
            second = nxt[at]
            after = nxt[second]
            sym[at], sym[second], nxt[at] = self.made[r], -1, after
            prv[after[after >= 0]] = at[after >= 0]
            before = prv[at]
            note(np.unique(np.concatenate((before[before >= 0], at))), r)
        live = sym >= 0
        count = np.add.reduceat(live, ends - size)
        out = np.split(sym[live], np.cumsum(count)[:-1])
        for w in np.unique(np.searchsorted(ends, np.concatenate(odd), side="right")).tolist() if odd else []:
            out[w] = np.array(self.one_by_one(words[w]), np.int32)
        return out

    _ASCII = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")

    def pieces(self, chunk: bytes) -> list[bytes | int]:
        """Words of a chunk without ASCII white space, in bytes, and ids of special tokens."""
        if b"<|" in chunk and (parts := self.find_special.split(chunk))[1:]:
            return [x for p in parts for x in ([self.special[p]] if p in self.special else self.pieces(p) if p else [])]
        if chunk.isascii():
            return self._ASCII.findall(chunk.lower())
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        text = self._library.normalizer.normalize_str(chunk.decode())
        return [bytes(self.to_byte[c] for c in w) for w, _ in self._library.pre_tokenizer.pre_tokenize_str(text)]


class WordCache:
    """Ids of pieces of texts. Each piece has a number, its place in the arrays; when they outgrow the limit, the most used half stays."""

    def __init__(self, limit: int | None = None):
        self.limit = limit or CACHE_BYTES
        self._renew([], np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64))

    def _renew(self, keys: list[bytes], size: np.ndarray, flat: np.ndarray, uses: np.ndarray) -> None:
        self.number: dict[bytes, int] = defaultdict(itertools.count(len(keys)).__next__, zip(keys, range(len(keys))))
        self.size, self.start, self.flat, self.uses = size, np.cumsum(size) - size, flat, uses
        self.held = sum(map(len, keys)) + ENTRY_BYTES * len(keys) + flat.nbytes

    def _take(self, numbers: np.ndarray) -> np.ndarray:
        n = self.size[numbers]
        return self.flat[np.repeat(self.start[numbers] - np.cumsum(n) + n, n) + np.arange(n.sum())]

    def _forget(self) -> None:
        """Keeps the most used pieces, up to half of the limit."""
        keys = list(self.number)
        order = np.argsort(-self.uses, kind="stable")
        cost = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys))[order] + ENTRY_BYTES + 4 * self.size[order])
        stay = np.sort(order[: np.searchsorted(cost, self.limit // 2)])
        self._renew([keys[k] for k in stay.tolist()], self.size[stay], self._take(stay), self.uses[stay] // 2)

    def _place(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, and how many each text has. Each different piece of the plain texts is looked up once."""
        plain = [folded(t) for t in texts]
        pieces, count = plain_pieces([p or b"" for p in plain])
        coded = pieces.dictionary_encode()
        keys = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.number.__getitem__, keys), np.int32, len(keys))[np.asarray(coded.indices)]
        if None not in plain:
            return numbers, count
        parts = np.split(numbers, np.cumsum(count)[:-1])
        for i in (i for i, p in enumerate(plain) if p is None):
            own = keys_of(texts[i])
            parts[i] = np.fromiter(map(self.number.__getitem__, own), np.int32, len(own))
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def ids(self, texts: list[str | None], learn: Callable[[list[bytes]], list[bytes]]) -> list[np.ndarray]:
        """Ids of each text; learn gives the packed ids of the pieces that are new."""
        if self.held > self.limit:
            self._forget()
        known = len(self.size)
        placed, count = self._place(texts)
        if len(self.number) > known:
            new = list(itertools.islice(self.number, known, None))
            packed = learn(new)
            flat = b"".join(packed)
            self.held += sum(map(len, new)) + ENTRY_BYTES * len(new) + len(flat)
            self.size = np.append(self.size, np.fromiter(map(len, packed), np.int64, len(packed)) // 4)
            self.flat = np.append(self.flat, np.frombuffer(flat, np.int32))
            self.start = np.cumsum(self.size) - self.size
            self.uses = np.append(self.uses, np.zeros(len(new), np.int64))
        self.uses += np.bincount(placed, minlength=len(self.uses))
        ends = np.concatenate(([0], np.cumsum(self.size[placed])))[np.cumsum(count)]
        return np.split(self._take(placed), ends[:-1]) if texts else []


_coders: dict = {}


def cached_encoder(name: str) -> CachedEncoder:
    """The encoder of this Python worker, which serves many tasks."""
    if name not in _coders:
        _coders[name] = CachedEncoder(tokenizer_path(name))
    return _coders[name]


# Texts of ASCII and the accented letters of Latin-1 alone, without special tokens, are split here as the tokenizer file
# says; NFC and case folding leave nothing else to do for them.
_OTHER = re.compile(rb"[\xc2\xc4-\xff]|\xc3[\x97\xb7]")
_PLAIN = re.compile(rb"[a-z\x80-\xff]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-z0-9\x80-\xff]+")
WHOLE = b" "  # marks a key that is a chunk of any other text, to be split by the tokenizer's own rules


def keys_of(text: str | None) -> list[bytes]:
    """Pieces of a text that can be encoded one by one: words of a plain text, else chunks between ASCII white space."""
    data = (text or "").encode()
    if b"<|" in data or not data.isascii() and _OTHER.search(data):
        return [WHOLE + c for c in data.split()]
    return _PLAIN.findall(data.lower() if data.isascii() else text.lower().encode())


def folded(text: str | None) -> bytes | None:
    """A plain text in lower case; None for any other text."""
    data = (text or "").encode()
    if b"<|" in data or not data.isascii() and _OTHER.search(data):
        return None
    return data.lower() if data.isascii() else text.lower().encode()


_SPACE, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[97:123] = _KIND[128:] = _LETTER
_KIND[48:58] = _DIGIT


def plain_pieces(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The pieces of folded texts, those of _PLAIN, one after the other, and how many each text has."""
    raw = np.frombuffer(b"\n".join([*texts, b"", b"", b""]), np.uint8)  # ends in white space, so that what follows a sign can be looked at
    kind = _KIND[raw]
    begins = np.empty(len(raw), bool)
    begins[0] = True
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    signs = np.flatnonzero((raw == 39) & begins)  # 's, 't, 're, 've, 'm, 'll, 'd where a run of signs begins
    one, two = raw[signs + 1], raw[signs + 2]
    short = np.isin(one, list(b"stmd"))
    long = np.isin(one, list(b"rv")) & (two == 101) | (one == 108) & (two == 108)
    begins |= kind == _DIGIT
    begins[signs[short | long] + 1] = False
    begins[signs[short] + 2] = begins[signs[long] + 3] = True
    inside = kind != _SPACE
    begins &= inside
    at = np.flatnonzero(begins)
    data = raw[inside]
    offsets = np.append(np.flatnonzero(begins[inside]), len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.empty(0, np.int64)
    return pieces, np.diff(np.searchsorted(at, ends), prepend=0)


class CachedEncoder:
    """Encodes and decodes whole texts."""

    def __init__(self, path: str):
        self.bpe, self.cache = PairIndex(path), WordCache()
        size = max(self.bpe.tokens) + 1
        self.tokens = [self.bpe.tokens.get(i, "") for i in range(size)]
        self.numbers = [str(i) for i in range(size)]

    def learn(self, chunks: list[bytes]) -> list[bytes]:
        """Packed ids of each chunk."""
        split = [self.bpe.pieces(c[1:]) if c.startswith(WHOLE) else [c] for c in chunks]
        words = list({w for s in split for w in s if not isinstance(w, int)})
        ids = {w: x.tobytes() for w, x in zip(words, self.bpe.encode(words), strict=True)}
        return [b"".join([w.to_bytes(4, "little") if isinstance(w, int) else ids[w] for w in s]) for s in split]

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        return self.cache.ids(texts, self.learn)

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, special tokens as well: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))

    def shown(self, ids: list[int]) -> str:
        """Decimal ids joined by a space."""
        return " ".join(map(self.numbers.__getitem__, ids))


def groups(batches: Iterator[pa.RecordBatch], limit: int = GROUP_BYTES) -> Iterator[tuple[list, list[str | None]]]:
    """(ids, texts) of a partition, each of about `limit` characters; a longer text is a group of its own."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            piece = batch.slice(k, 256)
            for i, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                held += len(t or "")
                if held >= limit:
                    yield ids, texts
                    ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids) if ids else [], pa.int32()))


def encode_ids(docs: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """Per row: doc_id, ids array<int>. No shuffle.

    docs: doc_id, text; other columns are ignored. Null or empty texts have no ids. Null doc_ids stay null; repeated
    rows give repeated results; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = cached_encoder(name)
        for doc_ids, texts in groups(batches):
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), id_lists(coder.ids(texts))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """Per row of encoded (doc_id, ids): doc_id and the decoded text. Null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = cached_encoder(name)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                doc_ids, lists = batch.slice(k, 256).columns
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array([coder.decode(np.asarray(x.values).tolist()) if x.is_valid else "" for x in lists], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_digests(docs: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """Per row: doc_id, n_tokens, and SHA-256 of the decimal ids and of the text that the ids decode to.

    As encode_ids() and decode_ids() give them, in one pass over the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = cached_encoder(name)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for doc_ids, texts in groups(batches):
            rows = []
            for x in coder.ids(texts):
                ids = x.tolist()
                rows.append((len(ids), sha(coder.shown(ids)), sha(coder.decode(ids))))
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), DIGEST.types[1:], strict=True)]], schema=DIGEST)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
