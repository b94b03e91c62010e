"""The keyword state machine on a stream: attempts in event time, retries by timers, late and repeated results left out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from biblioforge.operators.collect import RETRY_LIMIT, backoff
from biblioforge.store import fresh

RESULT_DDL = "event_id long, keyword_id long, ts timestamp, ok boolean, added double"
STATE_DDL = "keyword_id long, at long, status string, attempts int, added double"


class KeywordStates(StatefulProcessor):
    """Results wait until the watermark has passed them and are then applied in the order of their times, so the states don't depend on the batches.

    A result completes a keyword or fails it. A failure is pending again after a backoff, unless it is the last one
    allowed; completed and finally failed keywords take no more results. The processor's key is a bucket of keywords:
    their states are read and written as columns, in one call for the bucket and not in several for each keyword.
    """

    def __init__(self, limit: int = RETRY_LIMIT, seconds: float = 1.0):
        self.limit, self.seconds = limit, seconds

    def init(self, handle) -> None:
        self.handle, self.settled = handle, {}
        self.now = handle.getValueState("now", "keyword_id array<long>, status array<string>, attempts array<int>, due array<long>")
        self.waiting = handle.getListState("waiting", "keyword_id array<long>, ts array<long>, event_id array<long>, ok array<boolean>, added array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r.keyword_id, r.micros, r.event_id, r.ok, r.added) for r in rows]
        self.waiting.appendValue(tuple(map(list, zip(*new, strict=True))))
        self.handle.registerTimer(-(-min(r[1] for r in new) // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        if self.settled.get(key[0]) == watermark:  # an earlier timer of the bucket did the work
            return
        self.settled[key[0]] = watermark
        until = watermark * 1000
        ready, later = {}, []
        for columns in self.waiting.get():
            for keyword, *result in zip(*columns, strict=True):
                if result[0] <= until:
                    ready.setdefault(keyword, []).append(result)
                else:
                    later.append((keyword, *result))
        states = {k: x for k, *x in zip(*self.now.get(), strict=True)} if self.now.exists() else {}
        for keyword in [*ready, *(k for k, (_, _, due) in states.items() if due is not None and due <= until and k not in ready)]:
            status, attempts, due = states.get(keyword, ("pending", 0, None))
            for ts, _, ok, added in [*sorted(ready.get(keyword, ()), key=lambda r: r[:2]), (until + 1, None, None, None)]:
                if due is not None and due <= min(ts, until):
                    yield Row(keyword_id=keyword, at=due, status="pending", attempts=attempts, added=None)
                    status, due = "pending", None
                if ok is None or status == "completed" or attempts >= self.limit:
                    continue
                if ok:
                    status, due = "completed", None
                else:
                    attempts += 1
                    status = "failed"
                    due = ts + int(backoff(attempts - 1) * self.seconds * 1_000_000) if attempts < self.limit else None
                yield Row(keyword_id=keyword, at=ts, status=status, attempts=attempts, added=added if ok else None)
            states[keyword] = [status, attempts, due]
        if ready:
            self.waiting.put([tuple(map(list, zip(*later, strict=True)))]) if later else self.waiting.clear()
        if states:
            self.now.update((list(states), *map(list, zip(*states.values(), strict=True))))
        soon = [r[1] for r in later] + [due for _, _, due in states.values() if due is not None]
        if soon:
            self.handle.registerTimer(-(-min(soon) // 1000))

    def close(self) -> None:
        pass


def keyword_states(results: DataFrame, late: str = "2 hours", seconds: float = 1.0, limit: int = RETRY_LIMIT, buckets: int = 1024) -> DataFrame:
    """Transitions (keyword_id, at, status, attempts, added) of a stream of results (RESULT_DDL): 'completed', 'failed', and 'pending' when a retry is due.

    A result that repeats an event_id within `late`, or comes later than that, changes nothing. The session's state store
    must be RocksDB (ROCKSDB). `buckets`, the keys of the state, must stay the same for a checkpoint; some hundred keywords
    a bucket take the least time.
    """
    rows = results.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    rows = rows.select("event_id", "keyword_id", "ok", "added", F.unix_micros("ts").alias("micros"), "ts", F.pmod(F.xxhash64("keyword_id"), F.lit(buckets)).alias("bucket"))
    return rows.groupBy("bucket").transformWithState(KeywordStates(limit, seconds), STATE_DDL, "Append", "EventTime").withColumn("at", F.timestamp_micros("at"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def replay(chunks: list[DataFrame], through: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a streaming query gives that is started anew for each chunk of its input and goes on from its checkpoint.

    Its state is in RocksDB, in as many partitions as the cluster has cores.
    """
    spark = chunks[0].sparkSession
    source, sink, state = fresh(spark, "feed"), fresh(spark, "fed"), fresh(spark, "feed-state")
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        for chunk in chunks:
            chunk.write.mode("append").parquet(source)
            stream = through(spark.readStream.schema(chunk.schema).parquet(source))
            stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.parquet(sink)
