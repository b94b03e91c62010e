"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a local session gets /tmp/checkpoints; a cluster, an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "/tmp/checkpoints"
    return base.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """df written and read back: its expressions run once, and the plans over it stay small."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_of_rows(stored: DataFrame, rows: int = 400_000) -> int:
    """Partitions of about `rows` rows for what is made of a stored table, whatever spark.sql.shuffle.partitions is; its files' footers give the count."""
    return max(stored.sparkSession.sparkContext.defaultParallelism, -(-stored.count() // rows))


def parts_of_bytes(df: DataFrame, mb: int = 1) -> int:
    """Partitions of about `mb` MB of the tables that df is made of, for what may not be stored. Nothing is run; a table of unknown size counts nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()  # not the plan's own estimate, where joins are products
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-sum(s for s in sizes if s < 1 << 50) // (mb << 20)))


def numbered_within(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """df plus each row's number (from 0) within its group by `order`, which must identify the group's rows.

    A sort over all rows and prefix sums of counts per partition: a group may be of any size, no task holds it whole.
    """
    rows = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    rows = keep(rows.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()), "numbered")
    parts = rows.groupBy("_p", *group).agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    # A row for each partition and group in it.
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("_p").alias("_part"), *[F.col(g).alias(f"_{g}") for g in group], "_first", before.alias("_before"))
    same = F.col("_p") == F.col("_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return rows.join(parts, same).withColumn(name, F.col("_i") - F.col("_first") + F.col("_before")).select(*df.columns, name)
