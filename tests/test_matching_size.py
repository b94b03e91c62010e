"""Candidate searches whose shuffles grow with the texts, not with their pairs, against plain loops."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from biblioforge.operators import matching


def grams(t, n=3):
    return [t[i : i + n] for i in range(max(1, len(t) - n + 1))] if t else []


@pytest.mark.parametrize("cell", [4_000_000, 60])
def test_shared_grams(spark, monkeypatch, cell):
    """Repeated grams, short texts, copies, other planes and empty texts; one cell, and many."""
    monkeypatch.setattr(matching, "CELL_INDEX", cell)
    monkeypatch.setattr(matching, "CELL_QUERIES", cell)
    r = random.Random(4)
    texts = ["".join(r.choice("abé日𝒳") for _ in range(r.choice([0, 1, 2, 3, 5, 9, 14]))) for _ in range(120)] + ["a" * 400, "a" * 3, None]
    rows = spark.createDataFrame(list(enumerate(texts)), "q long, text string")
    for overlap in (0.3, 0.9):
        out = matching.ngram_candidates(rows, rows.withColumnRenamed("q", "r"), overlap)
        got = sorted(tuple(x) for x in out.collect())
        want = []
        for a, x in enumerate(texts):
            g = Counter(grams(x))
            for b, y in enumerate(texts):
                shared = sum(g[k] for k in set(grams(y)))
                if g and shared >= max(1, int(sum(g.values()) * overlap)):
                    want.append((a, b, shared))
        assert got == want


def test_no_row_for_a_shared_gram(spark):
    """The pairs of a common gram don't travel: only the texts do."""
    rows = spark.range(3000).select(F.col("id").alias("q"), F.concat(F.lit("abc"), F.expr("substr(md5(CAST(id AS STRING)), 1, 20)")).alias("text"))
    plan = matching.ngram_candidates(rows, rows.withColumnRenamed("q", "r"))._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "explode(CASE" not in plan


def books(spark, n=160):
    r = random.Random(5)
    words = ["risk", "risks", "bank", "banks", "bond", "tax", "a", "of"]
    rows = [(i, r.choice(["", " ", None]) if i % 40 == 0 else " ".join(r.choices(words, k=r.randint(1, 5))), r.choice([None, "Ann Lee", "Bo Ek"]), r.choice([None, None, f"97812345678{i % 10}1"])) for i in range(n)]
    return matching.match_forms(spark.createDataFrame(rows, "id long, title string, author string, isbn string"), compose=False)


@pytest.mark.parametrize("hot", [20_000, 20])
def test_no_match_without_a_common_word_is_lost(spark, monkeypatch, hot):
    """Word pairs give the matches of all n-gram candidates and of all pairs; frequent words in one task, and dealt over several."""
    monkeypatch.setattr(matching, "HOT", hot)
    f = books(spark)
    rows = lambda df: sorted((x.l_id, x.r_id, x.match_type, round(x.confidence, 9)) for x in df.collect())
    for best in (True, False):
        for threshold in (0.7, 0.85):
            got = rows(matching.find_matches(f, f, threshold, 0.2, best_only=best))
            with pytest.MonkeyPatch.context() as m:
                m.setattr(matching, "near_enough", lambda sim: False)
                assert got == rows(matching.find_matches(f, f, threshold, 0.2, best_only=best)) and got
    got = rows(matching.brute_force(f, f, 0.7))
    monkeypatch.setattr(matching, "near_enough", lambda sim: False)
    assert got == rows(matching.brute_force(f, f, 0.7)) and got


def test_kept_index_below_the_word_bound(spark, tmp_path):
    from biblioforge.operators.kept_index import KeptIndex

    f = books(spark, 80)
    new, known = f.where("id % 2 = 0"), f.where("id % 2 = 1")
    index = KeptIndex(spark, str(tmp_path / "index"), 4)
    index.add(known)
    rows = lambda df: sorted((x.l_id, x.r_id, round(x.confidence, 9)) for x in df.collect())
    for threshold in (0.5, 0.7):
        assert rows(index.find(new, threshold, 0.2)) == rows(matching.find_matches(new, known, threshold, 0.2))


def test_words_in_one_writing(spark):
    """The parts of a key can't meet those of another kind."""
    f = matching.match_forms(spark.createDataFrame([(1, "abc", None, None), (2, "ab c", None, None), (3, "x", None, "9781234567891")], "id long, title string, author string, isbn string"), compose=False)
    keys = {x.r_id: x.k for x in matching.sided(f, "r").select("r_id", matching._words_or_code("r").alias("k")).collect()}
    assert keys == {1: ["abc", " abc"], 2: ["ab", "c", " abc"], 3: ["x", " x", "  9781234567891"]}
