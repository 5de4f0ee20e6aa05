"""Readers of batch and streaming sources behind one seam."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def json_messages(df: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Message rows with m, the parsed value, and parse_error where it is no JSON object of the schema."""
    text = F.col(value).cast("string")
    parsed = F.from_json(text, schema)
    return df.withColumn("m", parsed).withColumn("parse_error", F.when(F.get_json_object(text, "$").isNull(), "invalid JSON"))


def message_stream(spark: SparkSession, source: dict, schema: T.StructType | str | None = None) -> DataFrame:
    """A stream of messages from a configured source: kafka (if its connector is present), files or rate.

    files read JSON rows of the given schema; with `per_trigger`, so many files at a time.
    """
    kind = source["kind"]
    if kind == "kafka":
        reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", source["servers"]).option("subscribe", source["topic"])
        if "per_trigger" in source:
            reader = reader.option("maxOffsetsPerTrigger", source["per_trigger"])
        return reader.load()
    if kind == "files":
        reader = spark.readStream.schema(schema)
        if "per_trigger" in source:
            reader = reader.option("maxFilesPerTrigger", source["per_trigger"])
        return reader.format(source.get("format", "json")).load(source["path"])
    if kind == "rate":
        return spark.readStream.format("rate").option("rowsPerSecond", source.get("rows_per_second", 10)).load()
    raise ValueError(f"unknown source: {kind}")


def exposition(spark: SparkSession, path: str) -> DataFrame:
    """Metric samples of exposition text files."""
    from ..operators import metrics

    return metrics.parsed_lines(spark.read.text(path))


def backfill(df: DataFrame, ts: str, start, stop) -> DataFrame:
    """A range of history in one scan; a distributed read needs no pages."""
    return df.where((F.col(ts) >= start) & (F.col(ts) < stop))

