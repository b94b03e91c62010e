"""Connected components by smallest label with pointer jumping, as joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioforge.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) links -> (node, comp): the smallest node that links reach. Nodes without links don't appear.

    Repeated links and loops are harmless. Each round takes the smallest label among neighbours and then the
    label of that label, so a chain of d links needs about log d rounds. Only counts come to the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = scratch.keep(both, "links")
    labels = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("near"))
        stepped = labels.join(near, labels.node == near.a).select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        jumped = stepped.join(up, "comp", "left").select("node", "old", F.least("comp", F.coalesce("up", "comp")).alias("comp"))
        done = scratch.keep(jumped, "labels")
        changed = done.where("comp <> old").limit(1).count()
        scratch.drop(labels)
        labels = done.select("node", "comp")
        if not changed:
            return labels
