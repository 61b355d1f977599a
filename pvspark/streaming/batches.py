"""ST3: batches that close at a number of messages or when nothing has come for a while.

The consumer's buffer is keyed state: a lane (a Kafka partition, or any key that spreads the messages) holds its
waiting messages as list state, closes a batch as soon as it has ``size`` of them, and a processing-time timer closes what is
left once the lane has been idle for ``idle`` seconds. The state lives in the checkpoint (RocksDB), so a stop loses nothing:
waiting messages are there when the query starts again, and an idle lane is flushed by its timer. A lane's buffer is
never above ``size`` messages plus one, whatever arrives.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

# --- fixed values: when the consumer closes a batch -----------------------------------------
SIZE = 100
IDLE_SECONDS = 10
# ------------------------------------------------------------------------------------------

STORE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
BATCH = T.StructType([T.StructField("lane", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("closed_by", T.StringType()),
                      T.StructField("values", T.ArrayType(T.StringType()))])


class Batcher(StatefulProcessor):
    def __init__(self, size: int = SIZE, idle_seconds: float = IDLE_SECONDS):
        self.size, self.idle_ms = size, int(idle_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("value", T.StringType())]))
        self.closed = handle.getValueState("closed", T.StructType([T.StructField("n", T.LongType())]))

    def _close(self, lane: str, values: list, n: int, by: str) -> Row:
        return Row(lane=lane, batch=n, closed_by=by, values=values)

    def _count(self) -> int:
        return self.closed.get()[0] if self.closed.exists() else 0

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        values, n = [r[0] for r in self.waiting.get()], self._count()
        for row in rows:
            values.append(row["value"])
            if len(values) == self.size:
                yield self._close(key[0], values, n, "size")
                values, n = [], n + 1
        self.closed.update((n,))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at[0] if isinstance(at, (tuple, list)) else at)
        if values:
            self.waiting.put([(v,) for v in values])
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        else:
            self.waiting.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        values, n = [r[0] for r in self.waiting.get()], self._count()
        if values:
            self.waiting.clear()
            self.closed.update((n + 1,))
            yield self._close(key[0], values, n, "idle")

    def close(self) -> None:
        pass


def close_batches(messages: DataFrame, lane: Column, size: int = SIZE, idle_seconds: float = IDLE_SECONDS) -> DataFrame:
    """A stream of messages (column ``value``) -> lane, batch (number in the lane), closed_by, values. Needs the RocksDB
    state store (``STORE``)."""
    return (messages.select(lane.cast("string").alias("lane"), "value").groupBy("lane")
            .transformWithState(Batcher(size, idle_seconds), BATCH, "Append", "ProcessingTime"))


def run(messages: DataFrame, lane: Column, out: str, checkpoint: str, size: int = SIZE, idle_seconds: float = IDLE_SECONDS,
        every: str = "1 second") -> StreamingQuery:
    """Write closed batches to ``out`` (Parquet, exactly once); the caller stops the query."""
    spark = messages.sparkSession
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        return (close_batches(messages, lane, size, idle_seconds).writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime=every).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_until_quiet(messages: DataFrame, lane: Column, out: str, checkpoint: str, size: int = SIZE, idle_seconds: float = IDLE_SECONDS,
                    every: str = "1 second", quiet: float | None = None, timeout: float = 600) -> None:
    """Take what the source has and stop when nothing has come for ``quiet`` seconds (a little more than ``idle_seconds`` unless given,
    so that the timers have flushed every lane). Timers keep the query running batches without rows, so waiting for
    "all available" would not end."""
    import time

    query = run(messages, lane, out, checkpoint, size, idle_seconds, every)
    quiet = idle_seconds + 3 if quiet is None else quiet
    end, seen, last = time.time() + timeout, -1, None
    try:
        while time.time() < end and query.isActive:
            time.sleep(0.1)
            for p in query.recentProgress:
                if p.batchId > seen:
                    seen = p.batchId
                    last = time.time() if p.numInputRows or last is None else last
            if last is not None and time.time() - last > quiet:
                break
        if query.exception() is not None:
            raise query.exception()
        end = time.time() + 10
        while query.isActive and query.status["isTriggerActive"] and time.time() < end:
            time.sleep(0.02)                # stop between two batches
    finally:
        query.stop()
