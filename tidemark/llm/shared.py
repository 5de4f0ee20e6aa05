"""What the operators of this subpackage share: the working folder, its tables, and joins that leave texts in place."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of other bytes than these (space, tab to carriage return).
WORD_SEPARATORS = "[\\x20\\x09-\\x0D]+"

#: The folder of a session on one machine that names none.
_LOCAL: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    A session on one machine (master local) that names none gets a temporary folder, which goes at
    exit. On a cluster a missing name is an error, since no local folder is seen by all.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tidemark-"))
        atexit.register(shutil.rmtree, _LOCAL[0], True)
    return f"file://{_LOCAL[0]}"


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{work_dir(spark)}/tidemark-{tag}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows in an Arrow batch than by default, since texts may be very long; a smaller setting stays.

    The setting is the session's: results are computed when the caller asks for them, and Spark
    reads it then.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, rows)


@dataclass
class _Scope:
    outer: _Scope | None
    tables: list[DataFrame] = field(default_factory=list)


_SCOPE: ContextVar[_Scope | None] = ContextVar("scope", default=None)


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Tables written inside are removed at the end, also after an error; lasting ones with the scope around, if any."""
    scope = _Scope(_SCOPE.get())
    token = _SCOPE.set(scope)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for table in scope.tables:
            drop_written(table)


#: Spark removes a step's shuffle files when the step has ended; without it they stay until the driver's garbage goes.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, tag: str, lasting: bool = False) -> DataFrame:
    """df, written as a Parquet table in the shared folder and reread: its lineage ends there.

    lasting: the table outlives the innermost scratch().
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path, before = new_path(spark, tag), spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, True)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.tidemark_path = path
    scope = _SCOPE.get()
    if scope and lasting:
        scope = scope.outer
    if scope:
        scope.tables.append(out)
    return out


def drop_written(df: DataFrame) -> None:
    """Removes the table of written(df), when no later plan reads it."""
    at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.tidemark_path)
    at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Bits of a bitmap of keys: 8 MB in all, whatever the number of keys.
BITMAP_BITS = 1 << 26


def row_key(docs: DataFrame) -> Column:
    """A 64-bit hash of doc_id and text: rows that share it are copies with the same id."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"])


def bitmap(keys: DataFrame, key: str, lasting: bool = False) -> DataFrame:
    """bucket and bits: a bit for each value of a 64-bit key column, in 2,048 rows of 4 KB at most."""
    at = F.pmod(F.col(key), F.lit(BITMAP_BITS))
    places = keys.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    return written(places.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "bitmap", lasting)


def flagged(rows: DataFrame, key: Column, bits: DataFrame, flag: str) -> DataFrame:
    """rows with a boolean: false where key is surely none of the bitmap's keys. No row moves; the bitmap is broadcast."""
    at = F.pmod(key, F.lit(BITMAP_BITS))
    both = rows.withColumn("__bucket", F.bitmap_bucket_number(at)).withColumn("__bit", F.bitmap_bit_position(at))
    both = both.join(F.broadcast(bits.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits"))), "__bucket", "left")
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(F.col("__bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    held = F.coalesce(F.getbit(byte, F.pmod(F.col("__bit"), F.lit(8)).cast("int")) == 1, F.lit(False))
    return both.select(*[F.col(f"`{c}`") for c in rows.columns], held.alias(flag))


def passing(rows: DataFrame, key: str, keys: DataFrame, lasting: bool = False) -> DataFrame:
    """The rows whose key may be among keys (the same column there): all that are, and few others."""
    return flagged(rows, F.col(key), bitmap(keys, key, lasting), "__may").where("__may").drop("__may")


def without(rows: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """rows whose key is not in gone's column __key. Only those that the bitmap of gone lets pass are joined, and so move."""
    gone = written(gone.select("__key").distinct(), "gone")
    marked = flagged(rows.withColumn("__key", key), F.col("__key"), bitmap(gone, "__key"), "__may")
    kept = marked.where("NOT __may").unionByName(marked.where("__may").join(gone, "__key", "left_anti").select(*marked.columns))
    return kept.select(*[F.col(f"`{c}`") for c in rows.columns])


def only(rows: DataFrame, key: Column, yes: DataFrame, no: DataFrame) -> DataFrame:
    """rows whose key is in yes. yes and no (column __key) share none and together hold each row's key.

    Rows of which the bitmaps of both say that they may hold the key are joined; all others stay where they are.
    """
    yes = written(yes.select("__key").distinct(), "yes")
    marked = flagged(rows.withColumn("__key", key), F.col("__key"), bitmap(yes, "__key"), "__yes").where("__yes")
    marked = flagged(marked, F.col("__key"), bitmap(no, "__key"), "__no")
    kept = marked.where("NOT __no").unionByName(marked.where("__no").join(yes, "__key", "left_semi").select(*marked.columns))
    return kept.select(*[F.col(f"`{c}`") for c in rows.columns])


def bucket_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; remainder 2 is held out. Null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
