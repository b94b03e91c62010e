import random

import pytest

from biblioforge.llm import decontaminate
from tests.llm.test_llm import frame, word_distance, words


def brute(docs, items, share, min_words):
    """(doc, item) pairs with a window of the item's size within the share of edits."""
    out = set()
    for k, item in items:
        if k is None or item is None or len(own := item.lower().split()) < min_words:
            continue
        for i, text in docs:
            w = (text or "").lower().split()
            size = min(len(own), len(w))
            if size and any(word_distance(w[s : s + size], own) <= int(share * len(own)) for s in range(len(w) - size + 1)):
                out.add((i, k))
    return out


@pytest.mark.parametrize("seed, vocabulary, min_words", [(1, 300, 5), (2, 12, 5), (3, 30, 1)])
def test_whole_set_equals_brute_force(spark, seed, vocabulary, min_words):
    r = random.Random(seed)
    items = [(k, words(r, r.randint(1, 24), vocabulary)) for k in range(14)] + [(50, ""), (51, None), (None, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for i in range(60):
        w = words(r, r.randint(0, 40), vocabulary).split()
        if i % 2:
            x = items[r.randrange(14)][1].split()
            for _ in range(r.randint(0, int(0.3 * len(x)) + 1)):
                at = r.randrange(len(x) + 1)
                x[at : at + r.randint(0, 1)] = [f"w{r.randrange(vocabulary)}"] * r.randint(0, 1)
                x = x or ["w0"]
            at = r.randrange(len(w) + 1)
            w[at:at] = x
        docs.append((i, " ".join(w)))
    docs += [(99, items[0][1]), (99, items[1][1]), (98, None)]
    found = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), 0.2, min_words).collect()}
    expected = brute(docs, items, 0.2, min_words)
    assert found <= expected
    assert len(found) >= 0.95 * len(expected) > 0


def test_buckets_tell_unrelated_windows_apart():
    r = random.Random(5)
    a, b = ([[r.randrange(1, 2**62) for _ in range(20)] for _ in range(200)] for _ in range(2))
    import numpy as np

    keys = [decontaminate.sampled_keys(w, decontaminate.walks(w, decontaminate.walk_steps(20)), 20) for w in (np.array(a, np.uint64), np.array(b, np.uint64))]
    assert not set(keys[0][keys[0] > 0].tolist()) & set(keys[1][keys[1] > 0].tolist())
    assert (keys[0] > 0).mean() > 0.9
