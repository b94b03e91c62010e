import random
import re

import numpy as np
import pytest

from biblioforge.llm import html_text


def host_pages(r, n, start=0):
    """n pages of a host without article markup: a menu, own prose of few distinct words, a notice in two sizes."""
    out = []
    for i in range(start, start + n):
        own = [" ".join(r.choice(COMMON) for _ in range(r.randint(20, 60))) for _ in range(4)]
        out.append((i, f"http://big/{i}", own, f"<div>home about contact us today</div><div>{'</div><div>'.join(own)}</div><div>{NOTICE}</div>"))
    return out


COMMON = "the of and a to in is was for on as with".split()
NOTICE = "all rights reserved no part of this page may be copied or sent on without a written permission of the owner"


@pytest.mark.parametrize("n", [20, 160])
def test_prose_without_article_markup_stays_on_small_and_large_hosts(spark, n):
    pages = host_pages(random.Random(n), n)
    got = {x.page_id: x.text for x in html_text.main_text(spark.createDataFrame([(i, u, h) for i, u, _, h in pages], "page_id long, url string, html string")).collect()}
    assert [i for i, _, own, _ in pages if got[i] != "\n\n".join(own)] == []


def test_suffix_names_are_the_intervals_of_the_suffix_array():
    r = random.Random(2)
    tokens = [r.choice("ab") for _ in range(3000)]
    words = html_text.hashed_words(" ".join(tokens))
    names = html_text.suffix_names("h", words)
    assert len(names) == len(tokens) - html_text.RUN + 1
    order = sorted(range(len(names)), key=lambda p: tokens[p:])
    for p, q in zip(order, order[1:]):  # neighbours share a name if and only if their LCP is RUN or more
        assert (names[p] == names[q]) == (tokens[p : p + html_text.RUN] == tokens[q : q + html_text.RUN])
    assert not np.isin(html_text.suffix_names("other", words), names).any()


def test_runs_cross_blocks_and_short_lone_blocks_stay(spark):
    menu = "".join(f"<li>item {k}</li>" for k in "abcdefghij")
    pages = [(i, f"http://h/{i}", f"<ul>{menu}</ul><p>Sh is.</p><p>own text {i} {i + 50} {i + 90}</p>") for i in range(3)]
    got = {x.page_id: x.text for x in html_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i].endswith(f"own text {i} {i + 50} {i + 90}") and "item" not in got[i] for i in range(3))
    once = [(1, "http://h/1", "<p>alone on its page</p>"), (2, "http://h/2", "<p>Sh is.</p><p>something of its own</p>"), (3, "http://h/3", "<p>Sh is.</p><p>other words are here</p>")]
    got = {x.page_id: x.text for x in html_text.main_text(spark.createDataFrame(once, "page_id long, url string, html string")).collect()}
    assert got == {1: "alone on its page", 2: "Sh is.\n\nsomething of its own", 3: "Sh is.\n\nother words are here"}


def test_intervals_of_two_pages_by_suffix_order_and_lcp():
    r = random.Random(5)
    pieces = [tuple(r.choice("ab") for _ in range(r.randint(html_text.RUN, 28))) for _ in range(60)]
    pieces += [r.choice(pieces)[:20] + tuple(r.choice("ab") for _ in range(4)) for _ in range(40)]
    pieces = list(dict.fromkeys(p for p in pieces if len(p) >= html_text.RUN))
    low = np.array([r.randint(0, 9) for _ in pieces])
    high = np.array([k + (r.random() < 0.1) for k in low])
    got = html_text.repeated_suffixes([html_text.hashed_words(" ".join(p)) for p in pieces], low, high)
    runs = {}
    for p, lo, hi in zip(pieces, low, high):
        for k in range(len(p) - html_text.RUN + 1):
            runs.setdefault(p[k : k + html_text.RUN], set()).update((lo, hi))
    want = [[k for k in range(len(p) - html_text.RUN + 1) if len(runs[p[k : k + html_text.RUN]]) > 1] for p in pieces]
    assert [x.tolist() for x in got] == want and 0 < sum(map(len, want)) < sum(len(p) - html_text.RUN + 1 for p in pieces)


def test_split_minimizers_give_the_same_text_and_hosts_stay_apart(spark):
    r = random.Random(9)
    menu = [f"m{k}" for k in range(14)]
    pages = []
    for i in range(60):  # the same menu before different words, on two hosts, and runs of few different tokens
        own = [f"w{r.randint(0, 3)}" for _ in range(12)] + [f"u{i}x{k}" for k in range(r.randint(0, 20))]
        pages.append((i, f"http://{'ab'[i % 2]}/{i}", f"<p>{' '.join(menu + own)}</p><p>{' '.join(r.choice('cd') for _ in range(30))}</p>"))
    pages += [(100, "http://c/1", pages[0][2]), (101, "http://a/copy", pages[0][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = [{x.page_id: x.text for x in html_text.main_text(df, limit).collect()} for limit in (2000, 1, 5)]
    assert got[0] == got[1] == got[2]
    assert got[0][100].startswith("m0 m1") and len(got[0][100].split()) == len(re.sub("<[^>]*>", " ", pages[0][2]).split())  # alone on its host
    assert got[0][0] == got[0][101] != got[0][100]
