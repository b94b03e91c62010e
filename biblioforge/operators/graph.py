"""Connected components of a links table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioforge.store import fresh


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, comp), the smallest node reached. Rounds of smallest-neighbour labels, written to the shared folder."""
    spark = edges.sparkSession
    root = fresh(spark, "components")

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    both = keep(edges.union(edges.select("b", "a")).toDF("a", "b").distinct(), "links")
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels-0")
    number = 0
    while True:
        number += 1
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near, labels.node == near.a).select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        done = keep(step.join(up, "comp", "left").select("node", "old", F.least("comp", F.coalesce("up", "comp")).alias("comp")), f"labels-{number}")
        changed = done.where("comp <> old").limit(1).count()
        labels = done.select("node", "comp")
        if not changed:
            return labels
