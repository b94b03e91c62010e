"""Strict scans by splits, and loads under constraints."""

import random

import pytest
from pyspark.sql import functions as F

from biblioforge.operators.guard import Constraints, guarded_load, read_loaded, read_quarantine
from biblioforge.sources import io


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_lines_of_files_of_several_splits(spark, tmp_path, small_splits):
    r = random.Random(1)
    want = {}
    for f in "abc":
        lines = [r.choice(["", " ", '{"k": %d, "t": "%s"}' % (i, "é" * r.randint(0, 90))]) for i in range(120)]
        (tmp_path / f"{f}.jsonl").write_text("\n".join(lines) + r.choice(["", "\n"]), encoding="utf-8")
        want |= {(f, i): t for i, t in enumerate(lines, 1) if t.strip()}
    rows = io.numbered_lines(spark, str(tmp_path))
    assert rows.select(F.col("_src")).rdd.getNumPartitions() > 9
    got = {(x["_src"][-7], x.line): x.value for x in rows.where("trim(value) <> ''").collect()}
    assert got == want
    read = io.read_json_lines_strict(spark, str(tmp_path), "k int, t string")
    assert {(x["_src"][-7], x.line) for x in read.where("k is not null").collect()} == set(want)


def test_first_malformed_line_is_named(spark, tmp_path, small_splits):
    lines = ['{"k": %d}' % i for i in range(300)]
    lines[150], lines[270] = '{"k": ', "oops"
    lines[20] = ""
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    with pytest.raises(ValueError, match=r"malformed line 151 of .*x\.jsonl"):
        io.read_json_lines_strict(spark, str(tmp_path), "k int")
    assert [x.line for x in io.malformed_lines(io.numbered_lines(spark, str(tmp_path))).orderBy("line").collect()] == [151, 271]
    (tmp_path / "none").mkdir()
    assert io.numbered_lines(spark, str(tmp_path / "none")).count() == 0


def test_guarded_load(spark, tmp_path):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (3, None), (None, "e")], "k int, name string")
    children = spark.createDataFrame([(1, 1, 5.0, 1), (2, 2, 50.0, 2), (3, 3, 1.0, 3), (4, None, None, 4), (1, 1, 7.0, 5), (2, 2, 1.0, 6), (2, 1, 2.0, 7)], "id int, k int, v double, at int")
    tables = {
        "p": (parents, Constraints(required=["name"], unique={"key": ["k"]}, order="name")),
        "c": (children, Constraints(checks={"v": F.col("v") <= 40}, foreign={"p": (["k"], "p", ["k"])}, unique={"key": ["id", "k"], "id": ["id"]}, order="at")),
    }
    counts = guarded_load(spark, tables, str(tmp_path / "t"))
    assert sorted(counts) == sorted([
        ("p", "loaded", 4), ("p", "rejected", 2), ("p", "required:name", 1), ("p", "unique:key", 1),
        ("c", "loaded", 3), ("c", "rejected", 4), ("c", "check:v", 1), ("c", "foreign:p", 1), ("c", "unique:key", 1), ("c", "unique:id", 1),
    ])
    good, bad = (f(spark, str(tmp_path / "t"), "c", children) for f in (read_loaded, read_quarantine))
    assert good.columns == children.columns
    # 3 has no parent that was loaded; 4 refers to nothing; the second key of id 2 is judged after the first, which stays.
    assert sorted(x["at"] for x in good.collect()) == [1, 4, 6]
    assert {x["at"]: x["_broken"] for x in bad.collect()} == {2: ["check:v"], 3: ["foreign:p"], 5: ["unique:key"], 7: ["unique:id"]}
    none = guarded_load(spark, {"p": (parents.where("k > 9"), tables["p"][1])}, str(tmp_path / "none"))
    assert sorted(none) == [("p", "loaded", 0), ("p", "rejected", 0), ("p", "required:name", 0), ("p", "unique:key", 0)]
