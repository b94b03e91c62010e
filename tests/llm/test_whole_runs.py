import random
from collections import defaultdict

import pytest

from biblioforge.llm import line_dedup
from tests.llm.test_llm import WORD, frame, words


def brute_runs(rows, min_words):
    """Lines left of each (id, text): windows of any number of lines with a word that occur before, with min_words words, go."""
    docs = {(i, t): [(n, l) for n, l in enumerate(t.split("\n")) if WORD.search(l)] for i, t in sorted(set(rows))}
    gone = defaultdict(set)
    for size in range(1, max(len(d) for d in docs.values()) + 1):
        seen = set()
        for key, lines in docs.items():
            for p in range(len(lines) - size + 1):
                name = tuple(l for _, l in lines[p : p + size])
                if name in seen and sum(len(WORD.findall(l)) for l in name) >= min_words:
                    gone[key].update(n for n, _ in lines[p : p + size])
                seen.add(name)
    return {key: "\n".join(l for n, l in enumerate(key[1].split("\n")) if n not in gone[key]) for key in docs}


def test_runs_that_are_no_power_of_two(spark):
    r = random.Random(1)
    line = lambda n: words(r, n, 10**6)
    nine, seven, twelve, five, thirteen, long = line(9), line(7), line(12), line(5), line(13), line(53)
    rows = [(1, "\n".join([nine, seven, "", twelve])), (2, "\n".join([line(4), nine, seven, "", twelve, "own end"])), (3, "\n".join([five, thirteen, long])), (4, "\n".join([five, "x", five, thirteen, long]))]
    got = {x.doc_id: (x.text.split("\n"), x.n_removed) for x in line_dedup.dedup_lines(frame(spark, rows), 20).collect()}
    assert got[1][1] == got[3][1] == 0
    assert got[2] == ([rows[1][1].split("\n")[0], "", "own end"], 3)
    assert got[4] == ([five, "x"], 3)


@pytest.mark.parametrize("seed, min_words", [(1, 10), (2, 20), (3, 1), (4, 7)])
def test_runs_equal_brute_force(spark, seed, min_words):
    r = random.Random(seed)
    lines = [words(r, n) for n in (1, 1, 2, 3, 5, 8, 12, 30)] + ["", "  "]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(1, 40)))) for i in range(40)]
    rows += [(50 + i, "\n".join(rows[i][1].split("\n")[1:-1])) for i in range(10)] + [rows[3], (5, rows[6][1])]
    expected = brute_runs(rows, min_words)
    got = [x for x in line_dedup.dedup_lines(frame(spark, rows), min_words).collect() if x.doc_id != 5]
    assert len(got) == len(rows) - 2
    source = dict(rows)
    assert [(x.doc_id, x.text) for x in got if x.text != expected[(x.doc_id, source[x.doc_id])]] == []
