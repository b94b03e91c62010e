"""Kinds of values that hold others, told without walking them."""

from pyspark.sql import functions as F

from biblioforge.operators.json_schema import _kind


def test_deep_kinds_are_the_kinds(spark):
    texts = ["null", "true", "1", "-1.5", "1e3", "100000000000000000000", '""', '"{}"', "[]", "{}", '[1, [null], {"a": 1}]', '{"a": {"b": [1]}, "c": null}']
    v = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.parse_json("t").alias("v"))
    rows = v.select("t", _kind(F.col("v")).alias("a"), _kind(F.col("v"), True).alias("b")).collect()
    assert [(r.t, r.b) for r in rows] == [(r.t, r.a) for r in rows]
