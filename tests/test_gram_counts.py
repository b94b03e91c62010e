"""Rows found by common pairs of grams against counters over all rows, and pairs that aren't shuffled."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from biblioforge.operators import gram_counts, matching


def shared(block, texts, overlap):
    parts = list(block.shared(texts, overlap))
    return sorted(zip(*[np.concatenate(x).tolist() for x in zip(*parts)])) if parts else []


@pytest.mark.parametrize("letters", ["abcdefghijklmnop", "abé日𝒳"])
def test_pairs_find_what_counters_find(monkeypatch, letters):
    """Needs from 1 to some 30 grams, repeated grams, texts too long for the columns."""
    r = random.Random(7)
    word = lambda n: "".join(r.choice(letters) for _ in range(n))
    rows = [word(r.choice([1, 2, 3, 8, 12, 18, 18, 18, 40, 100])) for _ in range(1500)] + ["ab" * 60, "a" * 50]
    queries = [t[: len(t) // 2] + word(len(t) // 2) for t in rows[:600]] + rows[-300:] + ["", "zz"]
    monkeypatch.setattr(gram_counts, "MOST_PAIRS", 0)
    want = {overlap: shared(gram_counts.Block(rows, 3), queries, overlap) for overlap in (0.2, 0.3, 0.8)}
    monkeypatch.setattr(gram_counts, "MOST_PAIRS", 1 << 40)
    for overlap, rows_of in want.items():
        assert rows_of and shared(gram_counts.Block(rows, 3), queries, overlap) == rows_of


def test_least_hits():
    for t in range(1, 9):
        for m in (1, 2, 4):
            ways = [sum(k * (k - 1) // 2 for k in deal) for deal in np.ndindex(*[t + 1] * m) if sum(deal) == t]
            assert gram_counts.least_hits(t, m) == min(ways)


def test_pairs_are_not_joined(spark):
    """A text goes with its ids, more than one pack's worth of copies too: after the cells nothing is shuffled."""
    rows = spark.range(500).select(F.col("id").alias("q"), F.when(F.col("id") < 200, "a title of many copies").otherwise(F.expr("concat('t', md5(CAST(id AS STRING)))")).alias("text"))
    out = matching.ngram_candidates(rows, rows.withColumnRenamed("q", "r"), 0.9)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("FlatMapCoGroupsInArrow") == 1
    assert sorted((x.q, x.r) for x in out.collect()) == sorted([(a, b) for a in range(200) for b in range(200)] + [(a, a) for a in range(200, 500)])
