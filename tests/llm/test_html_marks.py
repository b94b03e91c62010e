import random

from biblioforge.llm.html_text import CHROME, CONTENT, NAMED, OTHER, RUN, SHORT, main_text, page_blocks


def test_articles_inside_marked_elements_stay():
    for mark in ("class='layout has-sidebar'", "id='search-page'", "class=sidebar", "id=search class='page'"):
        assert page_blocks(f"<div {mark}><p>around</p><article><p>main text</p></article><main><p>more</p></main></div>")[1:] == [(CONTENT, "main text"), (CONTENT, "more")]
    assert page_blocks("<main class='search-page'><p>x</p></main>") == [(CONTENT, "x")]
    assert page_blocks("<main class='search'><p>x</p></main>") == [(OTHER, "x")]


def test_elements_roles_and_hidden_parts_hold_for_articles_too():
    for outer in ("<nav>", "<aside>", "<div hidden>", "<div role=dialog>"):
        assert page_blocks(f"{outer}<article><p>x</p></article>") == [(CHROME, "x")]
    assert page_blocks("<div class=comments><article class=comment>x</article></div>") == [(CHROME, "x")]


def texts(source):
    return [t for k, t in page_blocks(source) if k == CONTENT]


def test_hand_pages():
    assert texts('<form id="aspnetForm"><p>log in</p><article><p>main text</p></article></form>') == ["main text"]
    assert texts('<article><p>main</p></article><ul><li class="comment"><article id="div-comment-1" class="comment-body">reader</article></li></ul>') == ["main"]
    assert texts('<article><p>main</p></article><section id="comments"><article>reader</article></section>') == ["main"]
    assert texts('<article><p>main</p><ul class="comment-list"><li>reader</li></ul><div class="ad-slot">buy</div><div class="cookie-box">ok</div><div class="share-tools">share</div></article>') == ["main"]
    assert texts('<article><p style="display: none">no</p><header><h1>Title</h1></header><p>main</p></article>') == ["Title", "main"]
    assert page_blocks('<div class="top-menu"><a>Home</a> <a>Shop</a></div>') == [(NAMED, "Home Shop")]
    assert texts('<article class="post comments-open has-share"><p>main</p></article>') == ["main"]


def test_repeated_runs_are_cut_and_copies_are_one_page(spark):
    shared = " ".join(f"shared{k}" for k in range(20))
    own = lambda i: [" ".join(f"own{i}x{k}" for k in range(10)), " ".join(f"tail{i}x{k}" for k in range(9))]
    pages = [(i, f"http://h/{i}", f"<p>{own(i)[0]} {shared} {own(i)[1]}</p><p>{shared}</p>") for i in (1, 2)]
    pages += [(i, f"http://copies/{i}", "<p>" + " ".join(f"same{k}" for k in range(40)) + "</p>") for i in (3, 4)]
    got = {x.page_id: x.text for x in main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1] == " ".join(own(1)) and got[2] == " ".join(own(2))
    assert got[3] == got[4] == " ".join(f"same{k}" for k in range(40))


def test_whole_result_against_brute_force(spark):
    """Hosts of pages without markup: tokens of runs of RUN that another text of the host has go, by looking at all pairs."""
    r = random.Random(12)
    notice, menu = [f"n{k}" for k in range(30)], [f"m{k}" for k in range(18)]
    pages = []
    for i in range(40):
        blocks = [[f"w{r.randint(0, 10**6)}" for _ in range(r.randint(1, 30))] for _ in range(r.randint(1, 4))]
        for part in (notice, menu, notice[5:25], menu[:6], menu[:2]):
            if r.random() < 0.5:
                b = r.choice(blocks)
                if r.random() < 0.5:
                    blocks.insert(r.randint(0, len(blocks)), list(part))
                else:
                    b[r.randint(0, len(b)) : 0] = part
        pages.append((i, r.choice("abc"), [b for b in blocks if b]))
    pages += [(40 + k, h, b) for k, (_, h, b) in enumerate(pages[:5])]
    want = {}
    streams = {(h, tuple(w for b in blocks for w in b)) for _, h, blocks in pages}
    whole = {(h, tuple(w for b in x for w in b), tuple(b)) for _, h, x in pages for b in x}
    for i, h, blocks in pages:
        mine = tuple(w for b in blocks for w in b)
        others = [s for g, s in streams if g == h and s != mine]
        runs = {s[k : k + RUN] for s in others for k in range(len(s) - RUN + 1)}
        gone = {p + d for p in range(len(mine) - RUN + 1) if mine[p : p + RUN] in runs for d in range(RUN)}
        at, out = 0, []
        for b in blocks:
            own = [at + k in gone for k in range(len(b))]
            at += len(b)
            if SHORT <= len(b) < RUN and any(g == h and s != mine and x == tuple(b) for g, s, x in whole) or all(own):
                continue
            keep, k = [], 0
            while k < len(b):
                e = k
                while e < len(b) and own[e] == own[k]:
                    e += 1
                keep += [] if own[k] and e - k >= RUN else b[k:e]
                k = e
            out.append(" ".join(keep))
        want[i] = "\n\n".join(out)
    rows = [(i, f"http://{h}/{i}", "".join(f"<p>{' '.join(b)}</p>" for b in blocks)) for i, h, blocks in pages]
    assert {x.page_id: x.text for x in main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()} == want


def test_words_among_others_leave_blocks_to_the_repetition_test(spark):
    assert page_blocks("<div class='form-factor notice'>x</div>") == [(OTHER, "x")]
    assert page_blocks("<div class='ad banner'>x</div><div id='nav-menu'>y</div>") == [(NAMED, "x"), (NAMED, "y")]
    page = "<div class='widget-area right'>follow us on all of these</div><div class='social-history'>own text {}</div><div class=ad>buy {}</div>"
    pages = [(i, f"http://h/{i}", page.format(i, i)) for i in range(3)]
    got = {x.page_id: x.text for x in main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: f"own text {i}" for i in range(3)}
