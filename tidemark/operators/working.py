"""Steps written as Parquet in the shared folder: lineage ends there, and every executor sees them."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    return re.sub("^file:/(?=[^/])", "file:///", named.rstrip("/"))


def new_path(spark: SparkSession, tag: str) -> str:
    """A path that nothing uses yet; what is written there goes when the session's JVM ends."""
    path = f"{folder(spark)}/tidemark-{tag}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def staged(df: DataFrame, tag: str = "step") -> DataFrame:
    """df, written and reread. drop() removes it once no plan reads it."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.tidemark_path = path
    return out


def drop(df: DataFrame) -> None:
    at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.tidemark_path)
    at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
