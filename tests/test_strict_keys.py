"""strict_scan with keys of seven digits and more."""

from pyspark.sql import functions as F

from biblioforge.plans import ingest


def test_long_keys(spark, tmp_path):
    keys = [7, 1007, 1_000_007, 1_234_007, 12_345_007, 12_345_008, 999_999_999]
    spark.createDataFrame([(k, "O", 1.5) for k in keys], "o_orderkey long, o_orderstatus string, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    got = ingest.strict_scan(spark, str(tmp_path)).orderBy("key").collect()
    assert [tuple(r) for r in got] == [(k, n, k % 1000 == 7) for n, k in enumerate(keys, 1)]
    assert ingest.strict_scan(spark, str(tmp_path)).where(F.col("malformed")).count() == 5
