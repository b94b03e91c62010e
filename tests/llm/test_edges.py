"""Empty tables, nulls, repeated rows, clashing columns and very long texts, and brute force where SQL has no say."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from biblioforge.llm import bpe, html_text, line_dedup, quality, token_orc, toxicity
from biblioforge.llm.common import Scratch
from tests.llm.test_llm import frame, words

PAGES = "page_id long, url string, html string, text string, blocks string, name string"


def test_empty_tables(spark):
    none = frame(spark, [])
    assert bpe.encode_digests(none).count() == bpe.decode_ids(bpe.encode_ids(none)).count() == 0
    assert html_text.main_text(spark.createDataFrame([], PAGES)).count() == 0
    assert quality.quality_rules(none).count() == 0
    assert toxicity.toxicity_scores(none, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).count() == 0
    path = Scratch(spark, "t").path("orc")
    token_orc.write_token_orc(none, path)
    assert token_orc.token_checksums(spark, path).count() == 0


def test_ids_decode(spark):
    rows = [(1, "one two"), (1, "one two"), (2, None), (None, "x<|endoftext|>y"), (3, words(random.Random(1), 60_000, 10**6))]
    ids = bpe.encode_ids(frame(spark, rows))
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.tokenizer_path())
    assert [list(x.ids) for x in ids.collect()] == [t.encode(s or "", add_special_tokens=False).ids for _, s in rows]
    assert [x.text for x in bpe.decode_ids(ids).collect()] == [t.decode(t.encode(s or "", add_special_tokens=False).ids, skip_special_tokens=False) for _, s in rows]


def test_word_cache_is_bounded():
    cache = bpe.WordCache(20_000)
    asked = []

    def learn(keys):
        asked.extend(keys)
        return [np.array([len(k), k[0]], np.int32).tobytes() for k in keys]

    for n in range(40):
        got = cache.ids(["common " * 5 + " ".join(f"{chr(97 + k % 26)}{n}" for k in range(60)), None, "common"], learn)
        assert got[0].tolist()[:10] == [6, 99] * 5 and got[1].tolist() == [] and got[2].tolist() == [6, 99]
        assert len(got[0]) == 2 * (5 + 60 + 60 * len(str(n)))
    assert asked.count(b"common") == 1 and cache.held < 2 * 20_000
    many = [f"{'abcdefgh'[i % 8] * (i // 8 + 1)}" for i in range(400)]
    for _ in range(3):
        assert [x.tolist() for x in cache.ids(many, learn)] == [[len(w), ord(w[0])] for w in many]


def test_orc_prunes_by_bloom_filter_and_index(spark):
    from pyarrow import orc

    r = random.Random(3)
    path = Scratch(spark, "t").path("orc")
    token_orc.write_token_orc(frame(spark, [(2 * i, words(r, 20)) for i in range(3000)]), path)
    files = [f.removeprefix("file:") for f in spark.read.orc(path).inputFiles()]
    assert sum(orc.ORCFile(f).nrows for f in files) == 3000
    assert {orc.ORCFile(f).row_index_stride for f in files} == {1000}
    kept = [spark.read.orc(f).selectExpr("min(doc_id)", "max(doc_id)").first() for f in files]
    ranges = sorted((lo, hi) for lo, hi in kept if lo is not None)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))  # ranges of doc_id don't overlap
    assert spark.read.orc(path).where("doc_id = 1001").count() == 0 and spark.read.orc(path).where("doc_id = 1000").count() == 1


@pytest.mark.parametrize("tag", ['<div style="overflow: hidden">', '<div title="the hidden truth">', '<div data-hidden="false">', '<p data-id="share-7">', "<div aria-label='search form'>"])
def test_attribute_values_are_no_names(tag):
    assert html_text.page_blocks(f"<article>{tag}body text</article>") == [(html_text.CONTENT, "body text")]
    assert html_text.page_blocks('<article class="post form-wide"><p>x</p></article>') != []
    assert html_text.page_blocks("<div hidden>x</div>") == [(html_text.CHROME, "x")]


def test_pages_with_clashing_columns_and_repeats(spark):
    rows = [(1, "http://h/1", "<p>a b c d e</p>", "t", "b", "n")] * 2 + [(2, "http://h/2", "<p>" + "long " * 30_000 + "</p>", None, None, None), (None, None, None, "", "", "")]
    got = sorted((x.page_id or 0, x.n_chars) for x in html_text.main_text(spark.createDataFrame(rows, PAGES)).collect())
    assert got == [(0, 0), (1, 9), (1, 9), (2, 149_999)]


def brute_distance(p, q):
    keys, n, m = set(p) | set(q), sum(p.values()), sum(q.values())
    if not n or not m:
        return 0.0
    d = 0.0
    for k in keys:
        a, b = p.get(k, 0) / n, q.get(k, 0) / m
        d += (a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0)
    return math.sqrt(max(0, d / 2))


def test_quality_distances_equal_brute_force(spark):
    r = random.Random(2)
    rows = [(i, " ".join(f"w{min(r.randrange(200), r.randrange(200))}" for _ in range(r.choice([0, 10, 60, 400])))) for i in range(40)] + [(40, "### $$$ " * 40), (41, None), (None, "x " * 80), (3, "again")]
    got = quality.quality_rules(frame(spark, rows)).collect()
    every = Counter(w for _, t in rows for w in (t or "").lower().split())
    hashes = {w: int(quality.hashed_words(w).view(np.int64)[0]) for w in every}
    common = {w for w, _ in sorted(every.items(), key=lambda x: (-x[1], hashes[x[0]]))[: quality.COMMON]}
    fold = lambda words: Counter(w if w in common else None for w in words)
    classes = lambda t: Counter({k: int(n) for k, n in enumerate(quality.char_histogram(np.frombuffer((t or "").encode(), np.uint8))) if n})
    reference, letters = fold(every.elements()), sum((classes(t) for _, t in rows), Counter())
    for (_, t), x in zip(rows, got, strict=True):
        n = len((t or "").split())
        assert (x.word_distance is None) == (x.char_distance is None) == (n < 50)
        if n >= 50:
            assert x.word_distance == pytest.approx(brute_distance(fold((t or "").lower().split()), reference))
            assert x.char_distance == pytest.approx(brute_distance(classes(t), letters))
            assert x.kept == (not x.base_failed and x.char_distance <= quality.MAX_CHAR_DISTANCE and x.word_distance <= quality.MAX_WORD_DISTANCE + quality.SHORT_ALLOWANCE / n)
    assert len(quality.quality_rules(frame(spark, [(1, None)]), min_words=0).collect()) == 1


def test_label_model_equals_plain_loops():
    r = random.Random(4)
    gold = [int(r.random() < 0.3) for _ in range(60)]
    votes = [[int(r.random() < (0.7 if g else 0.1)) for _ in range(4)] for g in gold]
    post = [0.95 if g else 0.05 for g in gold]
    log = math.log
    for _ in range(3):
        clip = lambda x, lo: min(max(x, lo), 1 - lo)
        prior = clip(sum(post) / 60, 1e-3)
        rate = [[clip((sum(v[j] * w for v, w in zip(votes, p)) + 0.5) / (sum(p) + 1), 1e-4) for j in range(4)] for p in (post, [1 - x for x in post])]
        toxic = [v for v, p in zip(votes, post) if p > 0.5]
        mean = [sum(v[j] for v in toxic) / len(toxic) for j in range(4)]
        dev = [math.sqrt(sum((v[j] - mean[j]) ** 2 for v in toxic) / len(toxic)) + 1e-9 for j in range(4)]
        corr = lambda a, b: min(max(sum((v[a] - mean[a]) * (v[b] - mean[b]) for v in toxic) / len(toxic) / dev[a] / dev[b], 0), 1)
        weight = [1 / (1 + sum(corr(a, b) for b in range(4) if b != a)) for a in range(4)]
        new = []
        for v, g in zip(votes, gold):
            logit = log(prior / (1 - prior)) + (1 if g else -1) * log(0.95 / 0.05)
            logit += sum(weight[j] * (log(rate[0][j] / rate[1][j]) if v[j] else log((1 - rate[0][j]) / (1 - rate[1][j]))) for j in range(4))
            new.append(1 / (1 + math.exp(-min(max(logit, -30), 30))))
        post = new
    assert toxicity.label_model(np.array(votes, float), np.array(gold), 3) == pytest.approx(post, abs=1e-6)


def test_entries_cover_and_repeat_none():
    rows = {1: set(range(50)), 2: set(range(49)), 3: set(range(40, 100)), 4: {0, 60, 61, 99}, 5: {3}}
    assert toxicity.choose_entries(rows, dict.fromkeys(rows, 0.0), 100)[:2] == [3, 1]
    assert 2 not in toxicity.choose_entries(rows, dict.fromkeys(rows, 0.0), 100)
    assert toxicity.choose_entries({}, {}, 0) == []


def test_line_dedup_replaces_its_columns(spark):
    long = "\n".join(words(random.Random(i), 12, 10**6) for i in range(4000))
    df = spark.createDataFrame([(1, long, 5, 6), (2, "own line\n" + long, 7, 8), (3, None, None, None)], "doc_id long, text string, n_lines long, n_removed long")
    got = {x.doc_id: (x.text, x.n_lines, x.n_removed) for x in line_dedup.dedup_lines(df).collect()}
    assert got == {1: (long, 4000, 0), 2: ("own line", 4001, 4000), 3: (None, 0, 0)}
    assert re.fullmatch("[^_]+", "".join(line_dedup.dedup_lines(df).columns).replace("_", "")) is not None
