import random

import pytest

from biblioforge.llm import ngram_jaccard
from tests.llm.test_llm import frame, shingles, words


def brute(rows):
    """(smallest id, place of the first row by (id, place)) of the component of each row; every row is a document of its own."""
    sets = [shingles(t) if i is not None else frozenset() for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return [least.get(find(x)) for x in range(len(rows))], [find(x) for x in range(len(rows))], sets


def near(r, text, n):
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"y{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("rounds, block", [(2, 256), (0, 4)])
def test_ids_on_different_texts_link_nothing(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(ngram_jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(ngram_jaccard, "BLOCK_NODES", block)
    r = random.Random(rounds)
    a, b, c, long = words(r, 60, 9000), words(r, 60, 9000), words(r, 80, 9000), words(r, 20_000, 10**6)
    rows = [(7, a), (7, b), (8, a), (9, b), (5, c), (5, near(r, c, 1)), (5, near(r, c, 1)), (6, near(r, c, 1)), (1, long), (0, near(r, long, 300)), (2, None), (2, a), (None, a), (3, "x y"), (3, "x y"), (4, "X  y")]
    rows += [(r.randrange(10, 40), near(r, words(random.Random(k), 50, 9000), r.randint(0, 3))) for k in range(12) for _ in range(8)]
    least, comp, sets = brute(rows)
    got = sorted((x.doc_id if x.doc_id is not None else -1, x.n_shingles, x.component_id if x.component_id is not None else -1) for x in ngram_jaccard.similarity_components(frame(spark, rows)).collect())
    expected = sorted((i if i is not None else -1, len(shingles(t)), (m if s else i) if i is not None else -1) for (i, t), m, s in zip(rows, least, sets, strict=True))
    assert got == expected
    kept = ngram_jaccard.keep_one_per_component(frame(spark, rows)).collect()
    ids = [x for x, ((i, t), s) in enumerate(zip(rows, sets, strict=True)) if i is not None and s]
    assert sorted(x.doc_id for x in kept if x.doc_id is not None and x.text) == sorted(least[x] for x in {comp[x]: x for x in ids}.values())
    assert [x.text for x in kept if x.doc_id is None] == [a] and [x.doc_id for x in kept if x.text is None] == [2]
    assert {(x.doc_id, x.text) for x in kept} <= set(rows)
