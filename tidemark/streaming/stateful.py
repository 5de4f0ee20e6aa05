"""Stateful streams with processors of their own: bounded memory of ids, batches by size or time.

Both keep their state in Spark's state store (RocksDB), so a restart from the checkpoint goes on
where it stopped. Their timers run on processing time: such a query has work as long as it waits, so
run it with a processing-time trigger and stop it from outside.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

#: Ids that one memory holds, and how long: those of a worker of the pipeline. Fixed values.
MOST_IDS, TTL_SECONDS = 100_000, 86_400


def with_rocksdb(spark: SparkSession) -> None:
    """The state store that processors need; the session keeps another choice of its own provider class."""
    name, usual = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    if spark.conf.get(name, usual) == usual:
        spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Memory(StatefulProcessor):
    """Rows whose id is not held. A full memory loses its oldest tenth; an id goes by itself after its time to live."""

    def __init__(self, names: Sequence[str], places: Sequence[int], most: int, ttl_seconds: int):
        self.names, self.places, self.most, self.ttl_ms = list(names), list(places), most, ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", StructType([StructField("id", StringType())]), StructType([StructField("at", LongType())]), self.ttl_ms)
        self.held = handle.getValueState("held", StructType([StructField("n", IntegerType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held = self.held.get()[0] if self.held.exists() else 0
        for row in rows:
            own = ("\x1f".join("\x00" if row[p] is None else str(row[p]) for p in self.places),)
            if self.seen.containsKey(own):
                continue
            if held >= self.most:  # counted anew, since ids have gone by their time to live
                ids = sorted((value[0], name[0]) for name, value in self.seen.iterator())
                gone = ids[: self.most // 10] if len(ids) >= self.most else []
                for _at, name in gone:
                    self.seen.removeKey((name,))
                held = len(ids) - len(gone)
            self.seen.updateValue(own, (now,))
            held += 1
            yield Row(*self.names)(*row)
        self.held.update((held,))

    def close(self) -> None:
        pass


def recent_only(stream: DataFrame, key: Sequence[str], shards: int, ttl_seconds: int = TTL_SECONDS, most: int = MOST_IDS) -> DataFrame:
    """The rows whose key was not seen within the time to live, by processing time.

    Keys are dealt by a hash to `shards` memories of at most `most` keys each. A full memory forgets
    its oldest tenth, so a key may come twice then, as in the workers that it stands for. Null keys
    are keys. The columns are the stream's.
    """
    with_rocksdb(stream.sparkSession)
    names = stream.columns
    dealt = stream.withColumn("__shard", F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int"))
    schema = StructType([*stream.schema.fields, StructField("__shard", IntegerType())])
    out = dealt.groupBy("__shard").transformWithState(_Memory([*names, "__shard"], [names.index(k) for k in key], most, ttl_seconds), schema, "append", "processingtime")
    return out.drop("__shard")


class _Batches(StatefulProcessor):
    """Rows held until there are `size`, or until `seconds` after the first of them."""

    def __init__(self, schema: StructType, size: int, seconds: float):
        self.schema, self.size, self.wait_ms = schema, size, int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)
        self.state = handle.getValueState("state", StructType([StructField("n", IntegerType()), StructField("batch", LongType()), StructField("due", LongType())]))

    def _sent(self, rows: list, batch: int, reason: str) -> Iterator[Row]:
        for row in rows:
            yield Row(*self.schema.names, "batch", "reason")(*row, batch, reason)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, batch, due = self.state.get() if self.state.exists() else (0, 1, 0)
        new, full = [], False
        for row in rows:
            new.append(tuple(row))
            n += 1
            if n == self.size:
                yield from self._sent([*(self.rows.get() if not full and self.rows.exists() else []), *new], batch, "size")
                new, n, batch, full = [], 0, batch + 1, True
        if full:
            if self.rows.exists():
                self.rows.clear()
            if due:
                self.handle.deleteTimer(due)
                due = 0
        if new:
            self.rows.appendList(new)
            if not due:
                due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
                self.handle.registerTimer(due)
        self.state.update((n, batch, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _n, batch, _due = self.state.get()
        if self.rows.exists():
            yield from self._sent(list(self.rows.get()), batch, "time")
            self.rows.clear()
        self.state.update((0, batch + 1, 0))

    def close(self) -> None:
        pass


def size_or_time(stream: DataFrame, key: Sequence[str], size: int = 100, seconds: float = 5) -> DataFrame:
    """stream with batch (from 1, in each key) and reason (size or time).

    A batch goes when it has `size` rows, or `seconds` after its first row, by processing time; at most
    size - 1 rows of a key wait. The sum of all rows that go is the stream, also over restarts.
    """
    with_rocksdb(stream.sparkSession)
    schema = StructType([*stream.schema.fields, StructField("batch", LongType()), StructField("reason", StringType())])
    return stream.groupBy(*key).transformWithState(_Batches(stream.schema, size, seconds), schema, "append", "processingtime")
