"""Keyword cells against a loop over all keywords and texts."""

import random

import pytest

from biblioforge.operators import classify


def brute(texts, keywords):
    out = {}
    for i, t in texts:
        cells = {}
        for order, word, s, u in sorted(keywords, key=lambda k: (k[0], (k[1] or "").lower(), k[2] or "", k[3] or "")):
            if t is not None and word is not None and len(word) >= 3 and word.lower() in t.lower():
                c = cells.setdefault((s, u), [0, order, []])
                c[0] += 1
                c[2].append(word.lower())
        out[i] = [(s, u, n, first, words[:5]) for (s, u), (n, first, words) in sorted(cells.items(), key=lambda x: (-x[1][0], x[1][1]))]
    return out


@pytest.mark.parametrize("most_bytes", [64 << 20, 3000])
def test_cells(spark, most_bytes):
    """Keywords inside keywords, repeated ones, nulls and capitals; one block, and several."""
    r = random.Random(2)
    word = lambda n: "".join(r.choice("abAB") for _ in range(n))
    keywords = [(k, word(r.randint(2, 6)), f"s{k % 5}", f"u{k % 3}" if k % 7 else None) for k in range(120)]
    keywords += [(120, keywords[3][1], "s9", "u9"), (121, None, "s1", "u1"), (122, "日本語", "s2", "u2"), (123, "aaa", "s1", "u1"), (124, "aaaa", "s1", "u1")]
    texts = [(i, word(r.randint(0, 60))) for i in range(80)] + [(80, None), (81, ""), (82, "x日本語x aaaaa"), (83, "ab " * 20_000)]
    d = spark.createDataFrame(texts, "id long, text string")
    kw = spark.createDataFrame(keywords, "kw_ord int, keyword string, segment string, subsegment string")
    got = {x.id: [(c.segment, c.subsegment, c.hits, c.first, c.words) for c in x.cells] for x in classify.keyword_cells(d, kw, most_bytes=most_bytes).collect()}
    assert got == brute(texts, keywords)


def test_no_keywords_and_no_texts(spark):
    d = spark.createDataFrame([(1, "some text")], "id long, text string")
    kw = spark.createDataFrame([(0, "some", "s", "u"), (1, "so", "s", "u")], "kw_ord int, keyword string, segment string, subsegment string")
    assert [x.cells for x in classify.keyword_cells(d, kw.where("kw_ord > 0")).collect()] == [[]]
    assert classify.classify(d.where("id > 1"), kw).count() == 0
    assert "Exchange" not in classify.classify(d, kw)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most_rows", [12_000_000, 40])
def test_long_lists_stay_off_the_driver(spark, most_rows):
    """One pass, and several; repeated texts and words; other columns stay; no keyword row is collected."""
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abc") for _ in range(n))
    keywords = [(k, word(r.randint(3, 5)), f"s{k % 4}" if k % 9 else None, f"u{k % 3}") for k in range(200)] + [(7, "abc", "s1", "u1"), (7, "aba", "s1", "u1")]
    texts = [(i, word(r.randint(0, 40)), f"x{i}") for i in range(900)] + [(900, None, None), (901, "", "y"), (902, "zzz", "z")]
    d = spark.createDataFrame(texts, "id long, text string, other string")
    kw = spark.createDataFrame(keywords, "kw_ord int, keyword string, segment string, subsegment string")
    rows = classify.keyword_cells(d, kw, most_bytes=0, most_rows=most_rows)
    plan = rows._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    got = rows.collect()
    assert {x.id: [(c.segment, c.subsegment, c.hits, c.first, c.words) for c in x.cells] for x in got} == brute([t[:2] for t in texts], keywords)
    assert sorted((x.id, x.text, x.other) for x in got) == sorted(texts)


@pytest.mark.parametrize("most_rows", [12_000_000, 40])
def test_texts_are_shuffled_once(spark, most_rows):
    """However many blocks there are: packed, without columns that nobody asked for, and no list of cells is joined to its text."""
    r = random.Random(6)
    keywords = [(k, "".join(r.choice("abc") for _ in range(r.randint(3, 5))), f"s{k % 6}", f"u{k % 5}") for k in range(200)]
    texts = [(i, "".join(r.choice("abc") for _ in range(r.randint(0, 40)))) for i in range(700)]
    d = spark.createDataFrame(texts, "id long, text string")
    kw = spark.createDataFrame(keywords, "kw_ord int, keyword string, segment string, subsegment string")
    rows = classify.keyword_cells(d, kw, most_bytes=0, most_rows=most_rows, columns=["id"], best=2)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.columns == ["id", "cells"] and plan.count("Repartition") == 1 and "Join" not in plan
    got = {x.id: [(c.segment, c.subsegment, c.hits, c.first, c.words) for c in x.cells] for x in rows.collect()}
    assert got == {i: cells[:2] for i, cells in brute(texts, keywords).items()}
