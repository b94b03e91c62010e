"""Quality rules by distribution divergence (operator 9).

Two histograms of a document - character classes, and the most common words of its language - are compared with the
language's own by Jensen-Shannon distance (base 2, 0 to 1). The references are sums over all documents of the
language, counted per partition and word (by its 64-bit hash) and then added up; the most common words of a language
are taken from its whole vocabulary, of which only they reach the driver. Short documents, whose histograms are noise,
pass on these two distances; the base rules hold for all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioforge.llm.common import Scratch, hashed_words, window_hashes, word_hashes, word_spans

COMMON = 60  # most common words of a language that a document is compared on; the rest is one bin
HELD_WORDS = 1_000_000  # words of a language that a task holds before it counts them
MIN_WORDS = 50  # below, no distance is taken
MAX_CHAR_DISTANCE = 0.31
MAX_WORD_DISTANCE, SHORT_ALLOWANCE = 0.35, 5.0  # the word distance may be MAX_WORD_DISTANCE + SHORT_ALLOWANCE / n_words: few words spread widely
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
#: Classes of bytes: lower, upper, digit, space, newline, common punctuation, symbols, other ASCII, UTF-8 lead bytes.
CLASS = np.full(256, 7, np.int64)
for _k, _chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:'\"()-?", "#*$%&|<>!"]):
    CLASS[[ord(c) for c in _chars]] = _k
CLASS[192:] = 8
CONT = slice(128, 192)
CLASS[CONT] = 9
CLASSES = 9


def char_histogram(raw: np.ndarray) -> np.ndarray:
    """Counts of the nine classes; continuation bytes count with their lead byte."""
    return np.bincount(CLASS[raw], minlength=10)[:CLASSES]


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence with base 2; 0 if either has no mass."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, d / 2)))


def base_counts(text: str | None) -> tuple[int, int, int, int, int, np.ndarray, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, word hashes, bytes."""
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    starts, ends = word_spans(raw)
    words = word_hashes(raw, starts, ends)
    chars = int(((raw & 0xC0) != 0x80).sum()) - int(((raw == 32) | ((raw >= 9) & (raw <= 13))).sum())
    seen, dup = set(), 0
    for line in data.split(b"\n"):
        if line.split(None, 1):
            dup += line in seen
            seen.add(line)
    repeat = 0
    if len(words) > 3:
        w = window_hashes(words, 3)
        _, back, times = np.unique(w, return_inverse=True, return_counts=True)
        at = np.flatnonzero(times[back] > 1)
        if len(at):
            covered = np.zeros(len(words), bool)
            for i in range(3):
                covered[at + i] = True
            repeat = int(covered.sum())
    return len(words), chars, int(SYMBOLS[raw].sum()), dup, repeat, words, raw


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language: counts of the character classes (kind 0) and of the words (kind 1), some documents at a time."""
    chars: dict = {}
    held: dict = {}

    def rows(lang, kind: int, bins: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(bins), pa.string()), pa.array(np.full(len(bins), kind, np.int8)), pa.array(bins, pa.int64()), pa.array(n, pa.int64())], names=["lang", "kind", "bin", "n"])

    def words(lang) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        return rows(lang, 1, h.view(np.int64), n)

    sizes: dict = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            text = text.as_py()
            chars[lang] = chars.get(lang, 0) + char_histogram(np.frombuffer((text or "").encode(), np.uint8))
            h = hashed_words(text, lower=True)
            held.setdefault(lang, []).append(h)
            sizes[lang] = sizes.get(lang, 0) + len(h)
            if sizes[lang] >= HELD_WORDS:
                sizes[lang] = 0
                yield words(lang)
    for lang in list(held):
        yield words(lang)
    for lang, n in chars.items():
        yield rows(lang, 0, np.arange(CLASSES), n)


def language_references(docs: DataFrame) -> dict:
    """Language -> (character classes, hashes of the common words in order, their counts and the rest). Some 70 rows per language reach the driver."""
    scratch = Scratch(docs.sparkSession, "quality")
    sums = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(_counts, "lang string, kind byte, bin long, n long")
    sums = scratch.keep(sums.groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n")), "sums")
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "bin")
    top = sums.where("kind = 1").withColumn("place", F.row_number().over(first)).where(F.col("place") <= COMMON).select("lang", "kind", "bin", "n")
    total = sums.where("kind = 1").groupBy("lang").agg(F.sum("n").alias("n")).select("lang", F.lit(2).cast("byte").alias("kind"), F.lit(0).cast("long").alias("bin"), "n")
    out: dict = {}
    for r in sums.where("kind = 0").union(top).union(total).collect():
        chars, common, words = out.setdefault(r.lang, (np.zeros(CLASSES), {}, [0]))
        if r.kind == 0:
            chars[r.bin] = r.n
        elif r.kind == 1:
            common[r.bin] = r.n
        else:
            words[0] = r.n
    scratch.drop(sums)
    return {lang: (chars, np.array(sorted(common), np.int64), np.array([*[common[h] for h in sorted(common)], words[0] - sum(common.values())], float)) for lang, (chars, common, words) in out.items()}


def word_histogram(text: str | None, common: np.ndarray) -> np.ndarray:
    """Counts of the common words (sorted hashes) in a text, and of all other words."""
    h = hashed_words(text, lower=True).view(np.int64)
    if not len(common):
        return np.array([len(h)], float)
    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
    return np.bincount(np.where(common[at] == h, at, len(common)), minlength=len(common) + 1).astype(float)


def _score(references: dict, min_words: int, max_char: float, max_word: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                piece, rows = batch.slice(k, 1000), []
                for lang, text in zip(piece.column(1).to_pylist(), piece.column(2), strict=True):
                    text = text.as_py()
                    n, chars, symbols, dup, repeat, _, raw = base_counts(text)
                    failed = n < 50 or 100 * repeat > 50 * n
                    by_char = by_word = None
                    if n >= min_words:
                        char_ref, common, word_ref = references[lang]
                        by_char = js_distance(char_histogram(raw).astype(float), char_ref)
                        by_word = js_distance(word_histogram(text, common), word_ref)
                    kept = not failed and (by_char is None or by_char <= max_char) and (by_word is None or by_word <= max_word + SHORT_ALLOWANCE / max(n, 1))
                    rows.append((n, chars, symbols, dup, repeat, failed, kept, by_char, by_word))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
                yield pa.RecordBatch.from_arrays([piece.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"])

    return run


def quality_rules(docs: DataFrame, min_words: int = MIN_WORDS, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """One row per document: the base counts, base_failed, kept and the two distances (null below min_words).

    docs: doc_id, lang, text; other columns are ignored. A null language is one of its own. Null or empty texts count
    zero words and fail the base rules. Repeated rows give repeated results; an empty table gives none.
    """
    references = language_references(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    ddl = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double"
    return docs.mapInArrow(_score(references, min_words, max_char, max_word), ddl)
