"""W5, W17 and W19 on streams, on Spark's own state store.

Each operator is one stateful step; what it remembers per key (the last change, the flags of the last records, the last write and its expiry)
lives in the state store, which Spark checkpoints with the offsets. A batch that is repeated after a failure meets the state it met first.
Tables are kept by ``slices``, whose writes give the same table when they are repeated.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from millrace.operators import deadletter, slices, steps, writes
from millrace.sources import capture
from millrace.streaming import runs

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store, which also keeps state out of the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def into_table(rows: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], gone: str | None, checkpoint: str,
               interval_ms: int | None = None) -> None:
    """Run a stream of new versions of rows into the stored table at ``path``, which is made if it isn't there."""
    spark = rows.sparkSession
    hidden = [f for f in rows.schema.fields if f.name in order]
    if not runs.exists(spark, path):
        empty = spark.createDataFrame([], T.StructType([f for f in rows.schema.fields if f.name not in order and f.name != gone]))
        slices.create(empty, path, keys, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hidden))

    def write(batch: DataFrame, number: int) -> None:
        slices.upsert(spark, path, batch, keys, order, None if gone is None else F.col(f"_r.{gone}"))

    writer = rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    runs.finish(capture.pace(writer, interval_ms).start())


# --- W5 ----------------------------------------------------------------------------------------------------

def last_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change of each key that a micro-batch touches: a streaming ``max_by``, partial before the shuffle."""
    return writes.last_per_key(steps.unwrap_cdc(changes, drop_tombstones=True), keys, order)


def fold_changes(changes: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], interval_ms: int | None = None) -> None:
    """Run a stream of change envelopes into the table at ``path``. A micro-batch rewrites the slices of its keys only."""
    into_table(last_changes(changes, keys, order), path, keys, order, "__deleted", f"{path}-checkpoint", interval_ms)


# --- W17 ---------------------------------------------------------------------------------------------------

class _Failures(StatefulProcessor):
    """A ring of the flags of a key's last ``size`` records."""

    def __init__(self, keys: list[str], order: list[str], size: int, threshold: int) -> None:
        self._order, self._size, self._threshold = order, size, threshold
        self._row = Row(*keys, *order, "failures")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._flags = handle.getValueState("flags", "flags binary")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        ring = deque(self._flags.get()[0] if self._flags.exists() else b"", maxlen=self._size)
        failures = sum(ring)
        for at, bad in sorted(((tuple((r[c] is not None, r[c]) for c in self._order), r["_bad"]) for r in rows), key=lambda x: x[0]):
            failures += bad - (ring[0] if len(ring) == self._size else 0)
            ring.append(bad)
            if failures >= self._threshold:
                yield self._row(*key, *[v for _, v in at], failures)
        self._flags.update((bytes(ring),))

    def close(self) -> None:
        pass


def nack_breaches(df: DataFrame, keys: Sequence[str], order: Sequence[str], bad: Column, size: int, threshold: int) -> DataFrame:
    """Positions where the last ``size`` records of a key hold at least ``threshold`` failures.

    Records follow ``order`` within a micro-batch and arrival order between batches. A key's state is ``size`` flags. Its records of one
    micro-batch, an order and a flag each, are sorted in one task, so bound the batch with ``source_pace``.
    """
    if not deadletter.check_window(size, threshold):
        raise ValueError("the threshold is off: give size and threshold")
    use_state_store(df.sparkSession)
    narrow = df.select(*keys, *order, F.coalesce(bad, F.lit(False)).cast("int").alias("_bad"))
    out = T.StructType([*[narrow.schema[c] for c in (*keys, *order)], T.StructField("failures", T.LongType())])
    return narrow.groupBy(*keys).transformWithState(_Failures(list(keys), list(order), size, threshold), out, "append", "None")


# --- W19 ---------------------------------------------------------------------------------------------------

class _LastWrites(StatefulProcessor):
    """The last write of a key until its time to live ends."""

    def __init__(self, ttl_ms: int | None) -> None:
        self._ttl = ttl_ms
        self._row = Row("key", "value", "written", "expired")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "ms bigint, tie string")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        held = tuple(self._last.get()) if self._last.exists() else None
        best, row = held, None
        for r in rows:
            at = (r["_ms"], r["_tie"])
            if best is None or at > best:
                best, row = at, r
        if row is None:
            return
        if self._ttl is not None:
            if held is not None:
                self._handle.deleteTimer(held[0] + self._ttl)
            self._handle.registerTimer(best[0] + self._ttl)
        self._last.update(best)
        yield self._row(key[0], row["value"], row["written"], False)

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        if self._last.exists() and self._last.get()[0] + self._ttl <= expiredTimerInfo.getExpiryTimeInMs():
            self._last.clear()
            yield self._row(key[0], None, None, True)

    def close(self) -> None:
        pass


def to_key_value(df: DataFrame, key_field: str, value: str, ts: str, prefix: str = "", ttl_seconds: int | None = None,
                 tie: Sequence[str] = (), delay: str = "0 seconds") -> DataFrame:
    """Key, value, written, expired: a row whenever a key gets a newer write, and one when its time to live has passed.

    Time is event time: a write expires once the watermark (the latest ``ts`` less ``delay``) is ``ttl_seconds`` past it. Expired keys
    leave the state store.
    """
    use_state_store(df.sparkSession)
    tied = F.to_json(F.array(*[F.lpad(F.col(c).cast("string"), 20, "0") for c in tie])) if tie else F.lit("")
    rows = df.select(
        F.concat(F.lit(prefix), F.col(key_field).cast("string")).alias("key"), F.col(value).alias("value"),
        F.col(ts).cast("timestamp").alias("written"), tied.alias("_tie")).withColumn("_ms", F.unix_millis("written"))
    out = T.StructType([rows.schema["key"], T.StructField("value", rows.schema["value"].dataType),
                        T.StructField("written", T.TimestampType()), T.StructField("expired", T.BooleanType())])
    step = _LastWrites(None if ttl_seconds is None else ttl_seconds * 1000)
    if ttl_seconds is None:
        return rows.groupBy("key").transformWithState(step, out, "append", "None")
    return rows.withWatermark("written", delay).groupBy("key").transformWithState(step, out, "append", "EventTime")
