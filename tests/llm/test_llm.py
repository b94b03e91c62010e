import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from biblioforge.llm import bpe, decontaminate, html_text, licenses, line_dedup, ngram_jaccard, quality, token_counts, token_orc, toxicity
from biblioforge.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, ddl="doc_id long, text string, lang string, source string, n_chars long, comp string, n long"):
    """Rows of documents with extra columns that clash with names of the operators."""
    full = [(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows]
    return spark.createDataFrame(full, ddl)


def words(r, n, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1):
    """Texts with exact copies, a large group of near copies, a shared passage, nulls, empty and short texts."""
    r = random.Random(seed)
    base, passage = words(r, 60), words(r, 20)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "ONE  two"), (5, "one two three four five")]
    for i in range(6, 36):
        w = base.split()
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"x{r.randrange(999)}"
        rows.append((i, " ".join(w)))
    rows += [(i, passage + " " + words(r, 30, 5000)) for i in range(36, 50)]
    rows += [(i, rows[r.randrange(6, 50)][1]) for i in range(50, 60)] + [(60, words(r, 6000)), (None, base), (7, rows[7][1])]
    r.shuffle(rows)
    return rows


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    rows = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in rows:
        for j, b in rows:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in rows}


def test_ngram_join_equals_brute_force(spark):
    rows = corpus()
    got = ngram_jaccard.similarity_components(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    expected = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == expected
    assert [(r.n_shingles > 0, r.component_id) for r in got if r.doc_id is None] == [(True, None)]
    kept = ngram_jaccard.keep_one_per_component(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for _, c in expected.values()})
    assert set(kept[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", "comp", "n"}


def test_ngram_join_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "ROUNDS", 0)
    monkeypatch.setattr(ngram_jaccard, "BLOCK_NODES", 4)
    rows = corpus(2)
    got = ngram_jaccard.similarity_components(frame(spark, rows)).where("doc_id is not null").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_ngram_join_of_nothing(spark):
    assert ngram_jaccard.similarity_components(frame(spark, [])).count() == 0


def brute_lines(rows, min_words):
    """Lines left of each (id, text): windows of any number of lines with a word that occur before, with min_words words, go."""
    rows = sorted({(i, t) for i, t in rows if i is not None and t is not None})
    docs = {(i, t): [(n, l) for n, l in enumerate(t.split("\n")) if WORD.search(l)] for i, t in rows}
    gone, size = defaultdict(set), 1
    while size <= max([len(d) for d in docs.values()] + [0]):
        seen = {}
        for key, lines in docs.items():
            for p in range(len(lines) - size + 1):
                name = tuple(l for _, l in lines[p : p + size])
                if name not in seen:
                    seen[name] = (key, p)
                elif sum(len(WORD.findall(l)) for l in name) >= min_words:
                    gone[key].update(n for n, _ in lines[p : p + size])
        size += 1
    return {key: "\n".join(l for n, l in enumerate(key[1].split("\n")) if n not in gone[key]) for key in docs}


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(4)
    lines = [words(r, n) for n in (1, 2, 3, 5, 8, 12, 30)] + ["", "  "]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(1, 12)))) for i in range(40)] + [(100, None), (101, ""), (None, lines[6]), (5, None)]
    rows += [rows[3], rows[3]]
    out = line_dedup.dedup_lines(frame(spark, rows), 10).collect()
    expected = brute_lines(rows, 10)
    assert len(out) == len(rows)
    for x in out:
        if x.doc_id is not None and (x.doc_id, None) not in rows and x.doc_id != 5:
            source = next(t for i, t in rows if i == x.doc_id)
            assert x.text == expected[(x.doc_id, source)]
            assert x.n_lines == sum(bool(WORD.search(l)) for l in source.split("\n"))
    assert next(x for x in out if x.doc_id is None).text == lines[6]
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.tokenizer_path())
    t.no_padding()
    t.no_truncation()
    return t


TEXTS = [None, "", " \n", "It's WE'LL", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "é é ΑΣ Σ İ ß ﬁ ½ 12345 日本 😀", "x y　z\x1cq\x85r", "a" * 3000, "abab" * 50, "a b " * 400]


def noise(r):
    return "".join(chr(r.choice([r.randint(32, 126), r.randint(1, 0x2FFF), r.randint(0x10000, 0x1F9FF)])) for _ in range(r.randint(1, 120)))


def test_bpe_equals_the_library(spark, library):
    r = random.Random(6)
    rows = list(enumerate([*TEXTS, *[noise(r) for _ in range(150)]])) + [(None, "null id"), (3, "again")]
    got = bpe.encode_digests(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for (i, t), g in zip(rows, got, strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (g.doc_id, g.n_tokens, g.ids_sha256, g.decoded_sha256) == (i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_token_files_round_trip(spark, library):
    r = random.Random(7)
    rows = [(i * 3 % 101, t) for i, t in enumerate([*TEXTS, *[words(r, 50) for _ in range(60)]])] + [(None, "n"), (5, "same"), (5, "id")]
    r.shuffle(rows)
    path = Scratch(spark, "t").path("orc")
    token_orc.write_token_orc(frame(spark, rows), path)
    got = sorted(token_orc.token_checksums(spark, path).collect(), key=lambda x: x.start)
    start = 0
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    for (i, t), g in zip(order, got, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert spark.read.orc(path).where("doc_id = 9").count() == sum(i == 9 for i, _ in rows)


PAGE = '<html><head><title>t</title><script>var a = "</p>";</script></head><body>{nav}<article><h1>A &amp; B</h1><p>one<br>two&nbsp;x<p><b>three</article><div class="comments"><p>bad</p></div><footer>f</footer>'


def test_html_blocks(spark):
    nav = "<div>home about contact us today</div>"
    other = "<body><div>home about contact us today</div><div>own text of this page here</div></body>"
    pages = [(1, "http://h/1", PAGE.format(nav=nav)), (2, "http://h/2", other), (3, "http://other/1", other), (4, "http://h/3", None), (5, None, ""), (6, "http://h/4", "<p>cut &lt;off"), (None, "http://h/5", "<p>null id</p>")]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1] == "A & B\n\none two x\n\nthree"
    assert got[2] == "own text of this page here"
    assert got[3] == "home about contact us today\n\nown text of this page here"  # no other page of its host has it
    assert (got[4], got[5], got[6], got[None]) == ("", "", "cut <off", "null id")


def test_licenses(spark):
    rows = [(1, "a/b/c.txt", "code\nReleased under the MIT License.\n" + "x " * 100), (2, "a/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (3, "a/b/d.txt", "plain"), (4, "z/e.txt", "plain"), (5, None, None), (6, "a/f.txt", ""), (7, "a/g/LICENSE", "Licensed under CC BY-NC 4.0."), (8, "a/g/h/i.txt", "plain"), (9, "q.txt", "copyright of nobody at all and not a licence")]
    got = {r.file_id: (r.license, r.origin, r.from_dir) for r in licenses.scan_licenses(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    assert got[1] == ("MIT", "own", None) and got[2] == ("GPL-3.0", "own", None)
    assert got[3] == ("GPL-3.0", "inherited", "a") and got[6] == ("GPL-3.0", "inherited", "a")
    assert got[8] == ("CC-BY-NC-4.0", "inherited", "a/g")
    assert got[4] == got[5] == got[9] == (None, "none", None)


def test_rollup_deltas(spark):
    roll = token_counts.TokenRollup(spark, Scratch(spark, "r").path("x"), ["whitespace-1"])
    ddl = "doc_id long, source string, lang string, text string, op string"
    one = spark.createDataFrame([(1, "s", "en", "a b c", "insert"), (2, "s", "en", "a", None), (3, "t", "de", None, "insert"), (None, "t", "de", "x", "insert")], ddl)
    two = spark.createDataFrame([(1, "t", "de", "a b", "revise"), (2, None, None, None, "delete"), (9, "s", "en", None, "delete")], ddl)
    totals = lambda: {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in roll.totals().collect()}
    assert totals() == {}
    assert roll.commit("one", one) and not roll.commit("one", one)
    assert totals() == {("s", "en"): (2, 4), ("t", "de"): (1, 0)}
    assert roll.commit("two", two) and not roll.commit("two", two)
    assert totals() == {("t", "de"): (2, 2)}


def test_rollup_counts_as_the_library(spark, library):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame(spark, rows).select("doc_id", "source", "lang", F.lit("insert"), "text").toDF("doc_id", "source", "lang", "op", "text"), ["word_bpe_49k"]).collect()}
    assert got == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in rows}


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_decontamination_recall_and_precision(spark):
    r = random.Random(8)
    items = [(k, words(r, r.randint(8, 50), 300)) for k in range(40)] + [(100, None), (None, "a b c d e f g h"), (101, "too short")]
    docs, edited = [], {}
    for i in range(300):
        w = words(r, r.randint(60, 200), 300).split()
        if i % 2:
            k, item = items[r.randrange(40)]
            x = item.upper().split() if i % 4 == 1 else item.split()
            for _ in range(r.randint(0, int(len(x) * 0.2))):
                x[r.randrange(len(x))] = f"e{r.randrange(99)}"
            at = r.randrange(len(w))
            w[at:at] = x
            edited[i] = k
        docs.append((i, " ".join(w)))
    docs += [(1000, None), (1001, ""), (None, items[0][1]), (1002, items[1][1])]
    got = decontaminate.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(x.doc_id, x.item_id) for x in got}
    assert sum((i, k) in pairs for i, k in edited.items()) >= 0.9 * len(edited)
    assert (1002, 1) in pairs and (None, 0) in pairs
    texts, known = {i: (t or "").lower().split() for i, t in docs}, dict(items)
    for x in got:  # exact verification: no pair without a window that close
        item = known[x.item_id].lower().split()
        window = texts[x.doc_id][x.first_word : x.first_word + len(item)]
        assert word_distance(window, item) == x.distance <= int(0.2 * len(item))
    kept = decontaminate.drop_contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {x.doc_id for x in kept.collect()} == {i for i, _ in docs} - {i for i, _ in pairs}
    assert decontaminate.contaminated(frame(spark, []), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_quality_base_counts(spark):
    texts = [None, "", "a b a b a b a", "x\nx\n\n  \nx y\nx y", "é# $b %|", "the cat " * 60, "w " * 49, " ".join(f"w{i}" for i in range(80))]
    got = {r.doc_id: r for r in quality.quality_rules(frame(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(hit), failed)
        assert not (failed and r.kept)


def test_js_distance():
    assert quality.js_distance(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(1)
    assert quality.js_distance(np.array([1.0, 2]), np.array([2.0, 4])) == pytest.approx(0)
    assert quality.js_distance(np.zeros(2), np.array([2.0, 4])) == 0


def test_toxicity_learns_from_its_folds(spark):
    r = random.Random(9)
    bad = ["idiot", "scum", "vequast", "vequern", "vequolo"]
    docs, toxic = [], {}
    for i in range(600):
        toxic[i] = int(i % 5 == 0)
        w = words(r, 60).split()
        if toxic[i]:
            w[r.randrange(60)] = r.choice(bad)
            w[r.randrange(60)] = r.choice(bad).upper()
        docs.append((i, " ".join(w)))
    docs += [(1000, None), (1001, ""), (None, "you idiot scum")]
    labels = spark.createDataFrame([*toxic.items(), (None, 1), (3, None)], "doc_id long, toxic int")
    got = {x.doc_id: x for x in toxicity.toxicity_scores(frame(spark, docs), labels).collect()}
    held = [i for i in toxic if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in toxic)
    assert np.mean([got[i].predicted == toxic[i] for i in held]) >= 0.95
    assert got[1000].predicted == got[1001].predicted == 0 and got[None].predicted == 1
    none = toxicity.toxicity_scores(frame(spark, docs), spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.where("predicted = 1").count() == 0


def test_pipeline_keeps_columns_and_equals_its_parts(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, t) for i, t in corpus(3) if i is not None]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    item = next(t for i, t in rows if i == 60).split()[:30]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, " ".join(item))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    left = {i: t for (i, _), t in brute_lines(rows, line_dedup.MIN_WORDS).items()} | {i: t for i, t in rows if t is None}
    source = dict(rows)
    left = {i: t for i, t in left.items() if t is None or WORD.search(t) or not WORD.search(source[i])}
    kept = {c for _, c in brute_components(list(left.items())).values()}
    expected = sorted(i for i in kept if i != 60)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == expected
