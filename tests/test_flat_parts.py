"""Flattened tables in partitions by the size of the works."""

from pyspark.sql import functions as F

from biblioforge.operators import model
from biblioforge.plans import books, relational
from biblioforge.store import parts_of_bytes

SMALL = "/root/testdata/sf0.001"


def test_flattened_tables_keep_the_partitions_of_the_works(spark, monkeypatch):
    monkeypatch.setattr(model, "parts_of_bytes", lambda df: 7)
    t = model.flatten(books.nested_works(spark, SMALL))
    assert {t[name].rdd.getNumPartitions() for name in ("works", "authors", "topics", "editions", "formats")} == {7}
    assert t["works"].where(F.col("work_id").isNull()).count() == 0


def test_joins_and_tables_of_unknown_size_ask_for_no_more_partitions(spark):
    lines = relational.table(spark, SMALL, "lineitem")
    crossed = lines.select("l_orderkey").crossJoin(lines.select("l_partkey"))
    assert parts_of_bytes(crossed) == parts_of_bytes(spark.range(5).rdd.toDF()) == spark.sparkContext.defaultParallelism
