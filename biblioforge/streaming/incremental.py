"""Incremental additions: batch upserts of JSON Lines drops through Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.operators.model import pick


def add_stream(spark: SparkSession, source: str, schema: str, master_path: str, checkpoint: str, key: str, order: str) -> None:
    """Takes every file in `source` that earlier runs didn't take, one batch at a time, and appends unseen keys to the master."""

    def take(batch: DataFrame, _: int) -> None:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(master_path)
        there = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
        fresh = pick(batch, [key], order)
        if there:
            fresh = fresh.join(spark.read.schema(batch.schema).parquet(master_path).select(key).distinct(), key, "left_anti").select(*batch.columns)
        fresh.write.mode("append").parquet(master_path)

    stream = spark.readStream.schema(schema).json(source)
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_to_master(spark: SparkSession, source: str, master, checkpoint: str, stamp: str) -> list[dict]:
    """Adds every file of nested works in `source` that earlier runs didn't take to a Master; the counts of each batch.

    A batch that is delivered again after a crash finds its works in the master and adds nothing but merges.
    """
    from biblioforge import schemas

    told = []

    def take(batch: DataFrame, _: int) -> None:
        told.append(master.add(batch.withColumn("_line", F.monotonically_increasing_id()).withColumn("updated_at", F.lit(stamp))))

    stream = spark.readStream.schema(schemas.BOOK_V2).json(source).select("*", F.col("_metadata.file_path").alias("_file"))
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return told


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per event-time window and type, for a stream or a table."""
    rows = events.withWatermark("ts", late) if events.isStreaming and "EventTimeWatermark" not in events._jdf.queryExecution().analyzed().toString() else events
    return rows.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """user_id, session_start, n of sessions: events of a user less than `gap` apart. For a stream or a table."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), "n")
