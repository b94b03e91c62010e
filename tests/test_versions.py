"""States in versions and the kept index."""

import random

import pytest

from biblioforge.operators import matching
from biblioforge.operators.kept_index import KeptIndex
from biblioforge.sources.versions import Snapshots, Versions


def values(df):
    return sorted(r.k for r in df.collect())


def test_snapshots_swap_restore_and_reset(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "s"), "k long", keep=3)
    assert values(s.load()) == []
    for n in range(1, 6):
        assert s.save(s.load().union(spark.range(n, n + 1).toDF("k"))) == n
    assert values(s.load()) == [1, 2, 3, 4, 5] and s.versions.numbers() == [3, 4, 5]
    assert len(list((tmp_path / "s/data").iterdir())) == 3
    s.restore(3)
    assert values(s.load()) == [1, 2, 3]
    s.reset()
    assert values(s.load()) == [] and values(Snapshots(spark, str(tmp_path / "s"), "k long").load()) == []


def test_a_crash_before_the_swap_leaves_the_old_state(spark, tmp_path, monkeypatch):
    s = Snapshots(spark, str(tmp_path / "s"), "k long")
    s.save(spark.range(3).toDF("k"))
    monkeypatch.setattr(Versions, "publish", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        s.save(spark.range(9).toDF("k"))
    monkeypatch.undo()
    assert values(s.load()) == [0, 1, 2] and len(list((tmp_path / "s/data").iterdir())) == 2
    s.save(spark.range(4).toDF("k"))  # clears what the crash left
    assert values(s.load()) == [0, 1, 2, 3] and len(list((tmp_path / "s/data").iterdir())) == 2


def test_index_additions_equal_a_rebuild(spark, tmp_path):
    r = random.Random(4)
    words = ["risk", "bank", "bond", "tax", "fund", "rate", "market", "credit"]
    rows = [(i, " ".join(r.sample(words, r.randint(1, 4))) + r.choice(["", ": tales", ", 2nd Edition"]), r.choice([None, "Ann Lee", "Bo Ek"]), r.choice([None, None, f"97812345678{r.randint(10, 99)}"])) for i in range(300)]
    forms = matching.match_forms(spark.createDataFrame(rows, "id long, title string, author string, isbn string"), compose=False)
    known, new = forms.where("id < 200"), forms.where("id >= 200")
    index = KeptIndex(spark, str(tmp_path / "i"), 8)
    for part in range(3):
        index.add(known.where(f"id % 3 = {part}"))
    best = lambda df: sorted((x.l_id, x.r_id, x.tier, x.match_type, round(x.confidence, 9)) for x in df.collect())
    want = best(matching.find_matches(new, known))
    assert len({w[2] for w in want}) == 5
    assert best(index.find(new)) == want
    index.compact()
    assert len(index.segments("keys")) == 1 and best(KeptIndex(spark, str(tmp_path / "i"), 8).find(new)) == want
    # Probes are shuffled to the buckets; the index isn't.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = spark.range(2000).selectExpr("concat('1:', id) AS key")
        plan = index.probe("keys", many)._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and plan[plan.index("== Physical") :].count("Exchange hashpartitioning") == 1
        few = index.probe("keys", many.where("id < 3") if "id" in many.columns else many.limit(2))
        assert "SelectedBucketsCount: 2 out of 8" in few._jdf.queryExecution().toString() or "SelectedBucketsCount: 1 out of 8" in few._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
