"""Streaming forms of ingestion: deduplication, batched sinks, fan-out, delayed redelivery, breakers.

Every query takes a checkpoint folder; offsets are committed there after the sink of a batch, so a
batch is written at least once, and once where the sink is idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, IntegralType, StructField, StructType


def deduplicated(stream: DataFrame, key: list[str], ts: str, ttl: str = "24 hours") -> DataFrame:
    """The first row of each key within ttl of event time; the state of older keys goes."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark(key)


def batched(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Each micro-batch to a sink; every=None handles what is there and stops."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def fan_out_sink(sinks: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], None]]]) -> Callable[[DataFrame, int], None]:
    """One sink that computes a batch once and sends a part of it to each named sink."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for part, write in sinks.values():
                write(part(kept))
        finally:
            kept.unpersist()

    return sink


def redelivered(stream: DataFrame, key: str, retry_at: str) -> DataFrame:
    """Messages held until their time: each message is emitted when the watermark passes its retry_at.

    stream needs a watermark on its event time. The state is the list of a key's waiting messages;
    those without a time do not wait.
    """
    fields = [f for f in stream.schema.fields]
    names = [f.name for f in fields]
    schema = stream.schema
    at = names.index(retry_at)
    waiting = StructType([StructField("waiting", ArrayType(schema))])

    def plain(value: Any, whole: bool) -> Any:
        """A value of a pandas column as the state takes it."""
        value = value.tolist() if isinstance(value, (np.ndarray, np.generic)) else value
        if value is pd.NaT or (whole and value != value):
            return None
        return int(value) if whole and value is not None else value

    def due(message: tuple[Any, ...]) -> int:
        return 0 if message[at] is None else -(-pd.Timestamp(message[at]).value // 1_000_000)

    def hold(group: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [tuple(m) for m in state.get[0]] if state.exists else []
        if not state.hasTimedOut:
            for batch in batches:
                columns = [[plain(v, isinstance(f.dataType, IntegralType)) for v in batch[f.name]] for f in fields]
                held += zip(*columns, strict=True)
        now = max(state.getCurrentWatermarkMs(), 0)
        rest = [m for m in held if due(m) > now]
        if rest:
            state.update(([*rest],))
            state.setTimeoutTimestamp(max(min(map(due, rest)), now + 1))
        elif state.exists:
            state.remove()
        if ready := sorted((m for m in held if due(m) <= now), key=due):
            yield pd.DataFrame(ready, columns=names)

    return stream.groupBy(key).applyInPandasWithState(hold, schema, waiting, "append", GroupStateTimeout.EventTimeTimeout)


def breaker_states(calls: DataFrame, key: str, ts: str, ok: str, failures: int = 5, successes: int = 2, open_seconds: int = 60, order: Sequence[str] = ()) -> DataFrame:
    """The state of a circuit breaker after each call of a log: closed, open or half_open, and whether the call passed.

    Calls of a service are replayed by time, then `order`, batch by batch; what is carried is the
    state, its two counts and the time of opening.
    """

    def replay(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, failed, passed, opened = None, "closed", 0, 0, None
        for part in parts:
            out = []
            for service, at, good in zip(*[part.column(c).to_pylist() for c in (key, ts, ok)], strict=True):
                if service != last:
                    last, state, failed, passed, opened = service, "closed", 0, 0, None
                if state == "open" and at is not None and opened is not None and (at - opened).total_seconds() >= open_seconds:
                    state, passed = "half_open", 0
                allowed = state != "open"
                if allowed and good:
                    failed, passed = 0, passed + 1
                    if state == "half_open" and passed >= successes:
                        state = "closed"
                elif allowed:
                    failed += 1
                    if state == "half_open" or failed >= failures:
                        state, opened, failed = "open", at, 0
                out.append((allowed, state))
            yield pa.RecordBatch.from_pydict({key: part.column(key), ts: part.column(ts), "allowed": pa.array([x[0] for x in out], pa.bool_()), "state": pa.array([x[1] for x in out], pa.string())})

    kinds = dict(calls.dtypes)
    n = int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = calls.select(key, ts, ok, *order).repartition(n, key).sortWithinPartitions(key, F.asc_nulls_last(ts), *order)
    return ordered.mapInArrow(replay, f"{key} {kinds[key]}, {ts} {kinds[ts]}, allowed boolean, state string")


def counted_cycles(stream: DataFrame, ts: str, by: str, every: str = "30 seconds", late: str = "1 minute") -> DataFrame:
    """Rows by kind in tumbling windows."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, every), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("cycle"), by, "n")
