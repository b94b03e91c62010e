"""Toxicity by weak supervision (operator 10).

Voters are lexicon entries (whole words and word beginnings, found in a bounded sample of labelled rows) and patterns
over them (how many entries a text holds, and how many per 100 words); each fires or not on a text. A generative label
model estimates, by expectation maximisation, how often each voter fires in either class, and discounts voters that
fire together within a class; the given label is one more noisy voter. Its posterior labels train a logistic classifier
over the votes, which the sample's labels calibrate and which scores every whole text. Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioforge.llm.bpe import groups
from biblioforge.llm.common import Scratch, mix, word_hashes

FOLDS = 5  # rows whose crc32(doc_id) is a multiple are held out
SAMPLE_TOXIC, SAMPLE_CLEAN = 3000, 9000  # labelled rows that fit the model, at most
# Thresholds of the lexicon, as shares of the sample's toxic rows: an entry's support, what it adds to the entries chosen
# before it, the support of an entry that adds nothing; and its share of the clean rows over its share of the toxic ones.
SUPPORT, GAIN, SPARE, FOREIGN = 0.01, 0.002, 0.02, 0.1
SAME = 0.8  # share of rows in common from which an entry repeats another
HITS, DENSITIES = (2, 3), (0.3, 0.6, 1.0)  # pattern voters: occurrences of entries, and their number per 100 words
BEGINNINGS = (3, 4, 5, 6, 7, 8)  # bytes
LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def text_features(text: str | None) -> np.ndarray:
    """Hashes of the letter runs of a folded text and of their beginnings."""
    raw = np.frombuffer((text or "").lower().encode(), np.uint8)
    edge = np.diff(np.concatenate(([False], LETTER[raw], [False])).view(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = ends - starts
    hashes = [word_hashes(raw, starts, ends)]
    for k in BEGINNINGS:
        long = starts[size > k]
        hashes.append(mix(word_hashes(raw, long, long + k) ^ np.uint64(k)))
    return np.concatenate(hashes)


def word_count(text: str | None) -> int:
    """Letter runs of a text, at least 1."""
    raw = np.frombuffer((text or "").lower().encode(), np.uint8)
    return max(1, int((np.diff(np.concatenate(([False], LETTER[raw])).view(np.int8)) == 1).sum()))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [np.unique(text_features(t)).view(np.int64) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "f"])


def _occurrences(keep: np.ndarray):
    """Per partition: place in `keep` (sorted) and in how many rows it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(keep), np.int64)
        for b in batches:
            for t in b.column(1).to_pylist():
                f = np.unique(text_features(t).view(np.int64))
                at = np.minimum(np.searchsorted(keep, f), len(keep) - 1)
                total[at[keep[at] == f]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    return run


def entry_counts(text: str | None, entries: np.ndarray) -> np.ndarray:
    """How often a text holds each entry (sorted hashes)."""
    h = text_features(text).view(np.int64)
    at = np.minimum(np.searchsorted(entries, h), len(entries) - 1)
    return np.bincount(at[entries[at] == h], minlength=len(entries))


def _restricted(keep: np.ndarray):
    """toxic, words, and the places in `keep` (sorted) with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            counts = [entry_counts(t, keep) for t in texts]
            places = [np.flatnonzero(c) for c in counts]
            lists = pa.list_(pa.int64())
            cols = [b.column(0), b.column(1), pa.array([word_count(t) for t in texts], pa.int64()), pa.array(places, lists), pa.array([c[p] for c, p in zip(counts, places, strict=True)], lists)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "toxic", "words", "at", "n"])

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, text of labelled rows that aren't held out: the first of each class in hash order, up to the bounds."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    labels = labels.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    picked = labels.where("toxic = 1").orderBy(order, "doc_id").limit(SAMPLE_TOXIC).union(labels.where("toxic = 0").orderBy(order, "doc_id").limit(SAMPLE_CLEAN))
    rows = docs.join(F.broadcast(picked), "doc_id")  # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of 12 bytes
    return rows.groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text"))


def choose_entries(rows: dict[int, set[int]], foreign: dict[int, float], n_toxic: int) -> list[int]:
    """The lexicon: a greedy cover of the toxic rows, and the other well supported entries that repeat none before them.

    rows: entry -> toxic rows that hold it; foreign: entry -> clean rows that hold it, on the scale of the toxic ones.
    Ties go to the entry that clean rows hold less, then to the smaller one.
    """
    left, out, rest = set().union(*rows.values()) if rows else set(), [], dict(rows)
    while rest:
        gain = {x: len(r & left) - foreign[x] for x, r in rest.items()}
        best = min(rest, key=lambda x: (-gain[x], foreign[x], -len(rest[x]), x))
        if gain[best] < max(2, GAIN * n_toxic):
            break
        out.append(best)
        left -= rest.pop(best)
    for x in sorted(rest, key=lambda x: (-len(rest[x]), foreign[x], x)):
        if len(rest[x]) >= max(3, SPARE * n_toxic) and all(len(rest[x] & rows[y]) < SAME * min(len(rest[x]), len(rows[y])) for y in out):
            out.append(x)
    return out


def voters(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Votes of the entries and of the patterns over them, from the entries' counts in each row."""
    hits = counts.sum(1)
    density = 100 * hits / words
    return np.column_stack((counts > 0, *[hits >= k for k in HITS], *[density >= k for k in DENSITIES])).astype(float)


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior probability of the toxic class of each row. gold is one more noisy voter of accuracy 0.95."""
    post = np.where(gold == 1, 0.95, 0.05)
    for _ in range(rounds):
        prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
        rates = [(votes.T @ p + 0.5) / (p.sum() + 1) for p in (post, 1 - post)]
        rates = [np.clip(r, 1e-4, 1 - 1e-4) for r in rates]
        toxic = votes[post > 0.5].astype(float)
        discount = np.ones(votes.shape[1])
        if len(toxic) > 2:
            spread = toxic - toxic.mean(0)
            dev = np.sqrt((spread**2).mean(0)) + 1e-9
            together = np.clip(spread.T @ spread / len(toxic) / np.outer(dev, dev), 0, 1)
            discount = 1 / (1 + (together.sum(1) - np.diag(together)))
        fires, rests = np.log(rates[0] / rates[1]), np.log((1 - rates[0]) / (1 - rates[1]))
        logit = np.log(prior / (1 - prior)) + votes @ (discount * fires) + (1 - votes) @ (discount * rests) + np.where(gold == 1, 1, -1) * np.log(0.95 / 0.05)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return post


def design(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Intercept, votes, occurrences of entries and their density."""
    hits = counts.sum(1)
    return np.column_stack((np.ones(len(counts)), voters(counts, words), np.log1p(hits), np.log1p(100 * hits / words)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.05, rounds: int = 40) -> np.ndarray:
    """Newton steps for a logistic classifier on soft labels; the intercept isn't shrunk."""
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], l2)
    pull[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(pull), x.T @ (p - y) + pull * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """Lexicon (sorted hashes) and the weights of the classifier."""

    def __init__(self, entries: np.ndarray, weights: np.ndarray, base: float, scale: tuple[float, float] = (0.0, 1.0)):
        self.entries, self.weights, self.base, self.scale = entries, weights, base, scale

    def logit(self, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
        return np.clip(design(counts, words) @ self.weights, -15, 15)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.entries) or not texts:
            return np.full(len(texts), self.base)
        counts = np.array([entry_counts(t, self.entries) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.scale[0] + self.scale[1] * self.logit(counts, np.array([word_count(t) for t in texts])), -30, 30)))


def train(entries: np.ndarray, counts: np.ndarray, words: np.ndarray, gold: np.ndarray) -> Model:
    """Posterior labels from the label model, the classifier on them, and its calibration by the given labels."""
    post = label_model(voters(counts, words), gold)
    model = Model(entries, fit_logistic(design(counts, words), post), float(gold.mean()))
    a, b = fit_logistic(np.column_stack((np.ones(len(gold)), model.logit(counts, words))), gold.astype(float), 1e-3)
    model.scale = (float(a), float(b))
    return model


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from the labelled sample. Features of at most the sample's rows reach the driver."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.keep(labelled_sample(docs, labels), "sample")
    size = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    none = Model(np.empty(0, np.int64), np.zeros(1), n_toxic / max(1, n_toxic + n_clean))
    toxic = sample.where("toxic = 1").select("doc_id", "text").mapInArrow(_features, "doc_id long, f array<long>")
    top = toxic.select(F.explode("f").alias("f")).groupBy("f").agg(F.count("*").alias("n")).where(F.col("n") >= max(2, SUPPORT * n_toxic)).toArrow()
    keep, times = np.asarray(top.column("f")), np.asarray(top.column("n"))
    if not len(keep) or not n_clean:
        return none
    order = np.argsort(keep)
    keep, times = keep[order], times[order]
    sums = sample.where("toxic = 0").select("doc_id", "text").mapInArrow(_occurrences(keep), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    clean = np.zeros(len(keep), np.int64)
    clean[np.asarray(sums.column("at"))] = np.asarray(sums.column("n"))
    foreign = clean * n_toxic / n_clean
    fair = np.flatnonzero(foreign <= FOREIGN * times)
    if not len(fair):
        return none
    good, foreign = keep[fair], foreign[fair]
    rows = sample.mapInArrow(_restricted(good), "doc_id long, toxic int, words long, at array<long>, n array<long>").orderBy("doc_id").toArrow()
    gold, words = np.asarray(rows.column("toxic")), np.asarray(rows.column("words"))
    places, counts = ([np.asarray(x.values) for x in rows.column(c)] for c in ("at", "n"))
    held: dict[int, set[int]] = {}
    for i in np.flatnonzero(gold == 1).tolist():
        for k in places[i].tolist():
            held.setdefault(k, set()).add(i)
    chosen = np.sort(np.array(choose_entries(held, dict(enumerate(foreign.tolist())), n_toxic), np.int64))
    if not len(chosen):
        return none
    column = np.full(len(good), -1)
    column[chosen] = np.arange(len(chosen))
    matrix = np.zeros((len(gold), len(chosen)), np.int64)
    for i, (p, c) in enumerate(zip(places, counts, strict=True)):
        own = column[p] >= 0
        matrix[i, column[p[own]]] = c[own]
    scratch.drop(sample)
    return train(good[chosen], matrix, words, gold)


def toxicity_scores(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    docs: doc_id, text; labels: doc_id, toxic; other columns are ignored. train_docs: the rows that labels refer to,
    docs by default. Null or empty texts have no votes and the score of such texts. A null doc_id isn't held out.
    Without usable labels every score is the base rate (0 if there is none). Repeated rows give repeated results.
    """
    plain = lambda d: d.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = plain(docs)
    model = fit(plain(train_docs) if train_docs is not None else docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in groups(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(model.scores(texts))], names=["doc_id", "score"])

    scored = docs.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs, all columns, without the documents predicted toxic; rows are dropped where they are read."""
    model = fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                piece = b.slice(k, 1000)
                yield piece.filter(pa.array(model.scores(piece.column(at).to_pylist()) < 0.5))

    return docs.mapInArrow(run, docs.schema)
