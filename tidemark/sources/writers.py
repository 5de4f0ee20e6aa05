"""Sinks behind one seam: messages to topics, JSON payload files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MESSAGE = "topic string, key string, value string, headers array<struct<key:string,value:binary>>"


def as_messages(df: DataFrame, topic: Column | str, key: Column | None = None, value: Sequence[str] | None = None, headers: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows as messages: topic, key, value (JSON of the named columns, nulls left out), headers.

    topic may be a column, so that one pass sends rows to several topics; rows whose topic is null
    are not sent. Headers that are null are left out.
    """
    topic = F.lit(topic) if isinstance(topic, str) else topic
    pairs = [F.when(c.isNotNull(), F.struct(F.lit(name).alias("key"), c.cast("string").cast("binary").alias("value"))) for name, c in (headers or {}).items()]
    listed = F.array_compact(F.array(*pairs)) if pairs else F.lit(None)
    body = F.to_json(F.struct(*(value or df.columns)))
    out = df.select(topic.alias("topic"), (key if key is not None else F.lit(None)).cast("string").alias("key"), body.alias("value"), listed.cast("array<struct<key:string,value:binary>>").alias("headers"))
    return out.where(F.col("topic").isNotNull())


def send(messages: DataFrame, target: dict) -> None:
    """A batch of messages to a configured target: kafka (if its connector is present), files or table.

    files writes JSON below a folder for each topic; table appends to a Folder, once for each token
    if one is given.
    """
    kind = target["kind"]
    if kind == "kafka":
        messages.write.format("kafka").option("kafka.bootstrap.servers", target["servers"]).option("includeHeaders", "true").save()
    elif kind == "files":
        messages.withColumn("headers", F.col("headers").cast("string")).write.mode("append").partitionBy("topic").json(target["path"])
    elif kind == "table":
        target["table"].append(messages, token=target.get("token"))
    else:
        raise ValueError(f"unknown target: {kind}")


def send_stream(messages: DataFrame, target: dict, checkpoint: str) -> StreamingQuery:
    """A stream of messages to a target, all that is there. A batch that is repeated is not added twice to a table."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if target["kind"] == "kafka":
        return writer.format("kafka").option("kafka.bootstrap.servers", target["servers"]).option("includeHeaders", "true").start()
    if target["kind"] == "table":
        return writer.foreachBatch(lambda batch, n: send(batch, target | {"token": f"{checkpoint}#{n}"})).start()
    return writer.foreachBatch(lambda batch, n: send(batch, target)).start()


def payload_files(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Payloads as JSON files, for runs that send nothing."""
    df.select(*(columns or df.columns)).write.mode("append").json(path)
