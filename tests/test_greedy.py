"""The greedy merge in rounds against the sequential run."""

import difflib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from biblioforge.operators import matching


def grams(t):
    return [t[i : i + 3] for i in range(max(1, len(t) - 2))] if t else []


def similar(a, b):
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    return 0.6 * difflib.SequenceMatcher(None, a, b).ratio() + 0.4 * len(x & y) / len(x | y)


def same(a, b):
    return bool(a and b) and (a == b or a in b or b in a or difflib.SequenceMatcher(None, a, b).ratio() >= 0.85)


def sequential(rows, threshold=0.8, overlap=0.3):
    """rows: (id, ord, norm, agg, who, code) -> {id: leader}."""
    leaders, out = [], {}
    keys = [lambda r: r[5], lambda r: r[5][:12] if len(r[5] or "") == 13 else None, lambda r: r[2], lambda r: r[3]]
    for r in sorted(rows, key=lambda r: r[1]):
        best = next((x for k in keys if k(r) for x in leaders if k(x) == k(r)), None)
        if best is None:
            g = Counter(grams(r[3]))
            scored = []
            for x in leaders:
                shared = sum(g[k] for k in set(grams(x[3])))
                if g and shared >= max(1, int(sum(g.values()) * overlap)):
                    c = min(1.0, max(similar(r[2], x[2]), similar(r[3], x[3])) + 0.1 * same(r[4], x[4]))
                    if c >= threshold:
                        scored.append((-c, x[1], x))
            best = min(scored)[2] if scored else None
        if best is None:
            leaders.append(r)
        out[r[0]] = r[0] if best is None else best[0]
    return out


def forms(spark, rows):
    return matching.match_forms(spark.createDataFrame(rows, "id long, title string, author string, isbn string"), compose=False)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_sequential_run(spark, seed):
    r = random.Random(seed)
    words = ["risk", "risks", "bank", "banks", "bond", "tax", "taxes", "fund", "rate", "rates"]
    rows = []
    for i in range(250):
        title = " ".join(r.sample(words, r.randint(1, 4))) + r.choice(["", "", ": a story", ", 2nd Edition"])
        isbn = r.choice([None, None, None, f"97812345678{r.randint(0, 9)}{r.randint(0, 9)}"])
        rows.append((i, r.choice([title] * 8 + ["", None]), r.choice([None, "Ann Lee", "Anne Lee", "Bo Ek"]), isbn))
    rows += [(250 + k, rows[k][1], rows[k][2], rows[k][3]) for k in range(40)]  # repeated records
    order = list(range(len(rows)))
    r.shuffle(order)
    f = forms(spark, rows).join(spark.createDataFrame(list(enumerate(order)), "id long, ord long"), "id")
    got = {x.id: x.leader for x in matching.greedy_merge(f).collect()}
    want = sequential([(x.id, x.ord, x.norm or "", x.agg or "", x.who or "", x.code or "") for x in f.collect()])
    assert got == want and 20 < len(set(want.values())) < 200


def test_one_component_of_100000(spark):
    """Near titles, authors and ISBNs that chain all records together: no task holds the component."""
    f = spark.range(100_000).select(
        "id", F.col("id").alias("ord"), F.concat(F.lit("annual report of the bank part "), F.expr("translate(lpad(CAST(id % 300 AS STRING), 3, '0'), '0123456789', 'abcdefghij')")).alias("norm"),
        F.concat(F.lit("writer "), F.col("id") % 1000).alias("who"), F.when(F.col("id") % 3 == 0, F.lpad((F.col("id") % 5000).cast("string"), 10, "9")).alias("code"),
    ).withColumn("agg", F.regexp_replace("norm", " ", ""))
    got = matching.greedy_merge(f)
    assert got.count() == 100_000
    leaders = {x.leader for x in got.select("leader").distinct().collect()}
    head = f.where("id < 2000").collect()
    want = sequential([(x.id, x.ord, x.norm, x.agg, x.who, x.code or "") for x in head])
    assert {x.id: x.leader for x in got.where("id < 2000").collect()} == want and leaders >= set(want.values())


def test_empty_and_single(spark):
    f = forms(spark, [(1, None, None, None), (2, "", "", "")]).withColumn("ord", F.col("id"))
    assert {x.id: x.leader for x in matching.greedy_merge(f).collect()} == {1: 1, 2: 2}
    assert matching.greedy_merge(f.where("id > 2")).count() == 0
