"""Operator 12 against brute force over all windows, and its index against plain search."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from biblioforge.llm import substring_dedup as S

DDL = "doc_id long, text string, lang string, n_words string, spans int, row string, th int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size=35):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, kept text)."""
    texts = {r: WORD.findall(r[1] or "") for r in rows}
    seen = Counter()
    for (i, t), w in texts.items():
        if i is not None and t is not None:
            seen.update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for r in rows:
        w, gone = texts[r], set()
        if r[0] is not None:
            for k in range(len(w) - size + 1):
                if seen[tuple(w[k : k + size])] > 1:
                    gone.update(range(k, k + size))
        out.append((r[0], len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, "z", 2) for i, t in rows], DDL)


def got(df):
    assert df.columns == ["doc_id", "text", "lang", "spans", "row", "th", "n_words", "n_removed"]
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in df.collect()), key=repr)


def corpus(seed, n=120):
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 3000)}"
    passages = [[word() for _ in range(k)] for k in (34, 35, 36, 50, 80, 200)]
    phrase = [word() for _ in range(14)]
    rows = []
    for i in range(n):
        w = [word() for _ in range(r.choice((0, 3, 34, 35, 60, 150)))]
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(w))
            w[at:at] = r.choice(passages)
        if r.random() < 0.5:
            at = r.randint(0, len(w))
            w[at:at] = phrase
        if r.random() < 0.2 and rows:
            w = (rows[-1][1] or "").split() + w
        rows.append((i, r.choice(" \n\t").join(w)))
    return rows


@pytest.mark.parametrize("seed,limit,shard", [(1, 2000, 300_000), (2, 3, 300_000), (3, 2000, 400), (4, 8, 400)])
def test_equals_brute_force(spark, monkeypatch, seed, limit, shard):
    """Passages around the threshold, a common phrase, copies; crowded minimizers and many shards where limits are small."""
    monkeypatch.setattr(S, "SHARD_WORDS", shard)
    rows = corpus(seed)
    want = brute(rows)
    assert sum(x[2] for x in want) > 1000 and any(0 < x[2] < x[1] for x in want)
    assert got(S.dedup_substrings(frame(spark, rows).repartition(4), limit=limit)) == want


def test_edges(spark):
    r = random.Random(7)
    long = " ".join(f"x{r.randint(0, 10**6)}" for _ in range(60_000))
    passage = " ".join(f"p{k}" for k in range(35))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "same " * 34), (5, "over " * 500), (6, "ab cd ef " * 40), (7, passage + " tail"), (8, "head\n" + passage.replace(" ", "\n")),
        (9, long), (10, "x " + " ".join(long.split()[30_000:30_040])), (None, passage), (None, None), (11, "no break ퟿ \U0001f600 " + passage[:-1]), (12, passage + " tail"),
        (12, "another text under one id " + passage), (13, "lone lone"), (14, "y " * 34 + "z"), (15, "Z" * 5000 + " word"),
    ]
    assert got(S.dedup_substrings(frame(spark, rows))) == brute(rows)
    again = [*rows, (1, None), (9, long), (13, "lone lone"), (16, "only " + " ".join(f"q{k}" for k in range(40)))]
    again.append(again[-1])  # a repeated row is no copy of itself
    assert got(S.dedup_substrings(frame(spark, again))) == sorted(brute(rows + [again[-1]]) + [x for x in brute(rows) if x[0] in (1, 9, 13)] + brute([again[-1]]), key=repr)
    assert got(S.dedup_substrings(frame(spark, []))) == []
    lone = [r for r in rows if r[0] in (13, 15)]
    assert got(S.dedup_substrings(frame(spark, lone))) == brute(lone)


@pytest.mark.parametrize("seed,vocabulary", [(1, 2), (2, 5), (3, 300)])
def test_matching_statistics(seed, vocabulary):
    """The longest word sequence from each place that occurs twice in the pieces, by looking at all of them."""
    r = np.random.default_rng(seed)
    pieces = [r.integers(0, vocabulary, r.integers(1, 30)).astype(np.uint64) for _ in range(40)]
    pieces[7] = pieces[3][2:]
    count = Counter(tuple(p[a:b]) for p in pieces for a in range(len(p)) for b in range(a + 1, len(p) + 1))
    text = np.concatenate([np.append(p.astype(np.int64) + 1, 0) for p in pieces])
    index = S.FMIndex(text)
    table = np.zeros((len(pieces), 30), np.int64)
    for i, p in enumerate(pieces):
        table[i, : len(p)] = p.astype(np.int64) + 1
    found = index.matching_statistics(table)
    for i, p in enumerate(pieces):
        for a in range(len(p)):
            best = max((b - a for b in range(a + 1, len(p) + 1) if count[tuple(p[a:b])] > 1), default=0)
            assert found[i, a] == best
    for c in range(1, vocabulary + 1):
        at = r.integers(0, len(text) + 1, 20)
        bwt = text[np.array(sorted(range(len(text)), key=lambda k: [(x, k + j) if x == 0 else (x, 0) for j, x in enumerate(text[k : k + 40])])) - 1]
        assert (index.bwt.rank(np.full(20, c), at) == [(bwt[:a] == c).sum() for a in at]).all()
        if c > 5:
            break


def test_segments_hold_each_window_once():
    r = np.random.default_rng(4)
    texts = [" ".join(f"v{k}" for k in r.integers(0, 9, n)).encode() for n in (0, 10, 35, 36, 400, 3, 90)] + [b"a " * 300]
    m, h, text, first, n = S.segments(texts, 35, 12, True)
    own = Counter((t, s) for t, f, k in zip(text, first, n) for s in range(f, f + k))
    assert own == Counter((t, s) for t, x in enumerate(texts) for s in range(len(x.split()) - 34))
    assert n.max() <= 24
    words = [x.split() for x in texts]
    key = {}
    for a, t, f, k in zip(m, text, first, n):
        for s in range(f, f + k):
            assert key.setdefault(tuple(words[t][s : s + 35]), a) == a  # equal windows, equal minimizers
