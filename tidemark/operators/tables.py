"""Reads and writes of tables: scans, keyset and watermark reads, aligned append, keyed merge."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import working

# --- reads -----------------------------------------------------------------------------------


def scan(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*columns) if columns else df


def scan_filtered(df: DataFrame, condition: Column, columns=None, order_by: str | None = None, descending: bool = False, limit: int | None = None) -> DataFrame:
    """Filter, then projection, then order, then limit; the order column must be among the columns."""
    out = scan(df.where(condition), columns)
    if order_by:
        out = out.orderBy(F.desc(order_by) if descending else F.asc(order_by))
    return out.limit(limit) if limit is not None else out


_OPERATORS = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def scan_tuples(df: DataFrame, filters: Sequence[tuple], columns=None) -> DataFrame:
    """Filters as (column, operator, value). A number compares with the column cast to its kind, nulls and misfits as 0."""
    for name, op, value in filters:
        c = F.col(name)
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            kind = "double" if isinstance(value, float) else "bigint"
            c = F.coalesce(c.cast("string").try_cast("double").try_cast(kind), F.lit(0).cast(kind))
        df = df.where(_OPERATORS[op](c, F.lit(value)))
    return scan(df, columns)


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    """One row with the greatest value, null for an empty table."""
    return df.agg(F.max(column).alias("watermark"))


def after_watermark(df: DataFrame, column: str, watermark: Column) -> DataFrame:
    return df.where(F.col(column) > watermark)


def with_date_bounds(df: DataFrame, ts: str, low: Column, high: Column, partition: str | None = None) -> DataFrame:
    """Rows of a time range; with a date partition column, its bounds are added so that partitions are pruned."""
    out = df.where((F.col(ts) >= low) & (F.col(ts) < high))
    if partition:
        out = out.where(F.col(partition).between(F.to_date(low), F.to_date(high)))
    return out


def by_status(df: DataFrame, status: str, values: Sequence[str], ts: str, watermark: Column, order_by: Sequence[str], limit: int | None = None, filled: str | None = None) -> DataFrame:
    """Incremental read of some statuses: after a watermark, with a filled column if asked, the first rows in order."""
    out = df.where((F.col(ts) > watermark) & F.col(status).isin(*values))
    if filled:
        out = out.where(F.col(filled).isNotNull() & (F.col(filled) != ""))
    out = out.orderBy(*order_by)
    return out.limit(limit) if limit is not None else out


def keyset_page(df: DataFrame, ts: str, key: str, last_ts: Column, last_key: Column, size: int) -> DataFrame:
    """The next page after (last_ts, last_key) in the order of (ts, key)."""
    after = (F.col(ts) > last_ts) | ((F.col(ts) == last_ts) & (F.col(key) > last_key))
    return df.where(after).orderBy(ts, key).limit(size)


# --- schemas ---------------------------------------------------------------------------------


def align(df: DataFrame, schema: T.StructType, extra: bool = True) -> DataFrame:
    """df with the schema's columns in its order, cast where needed (misfits null), missing ones null, further ones after."""
    have = set(df.columns)
    out = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    names = {f.name for f in schema}
    return df.select(*out, *([F.col(f"`{c}`") for c in df.columns if c not in names] if extra else []))


def evolved(target: DataFrame, source: DataFrame) -> DataFrame:
    """target and source below each other: the target's types, columns of either, null where missing."""
    return target.unionByName(align(source, target.schema), allowMissingColumns=True)


# --- merge -----------------------------------------------------------------------------------


def coalesced_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key: of each column the last value that is not null, in the given order. Null keys are one key."""
    rank = F.struct(*[F.col(o) for o in order])
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in rest]).select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, in the given order."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], preserve: Sequence[str] = ("created_at",), condition: str | None = None, when_matched: str = "update", when_not_matched: str = "insert") -> DataFrame:
    """The target after a merge of a source with one row a key.

    Matched rows take the source's columns but for the preserved ones; a condition over `source.`
    and `target.` may keep them as they were. when_matched: update, delete or do_nothing;
    when_not_matched: insert or do_nothing. Null keys never match. Columns of either side appear,
    null where a side lacks them. One join, shuffled on the keys; a small source is broadcast by
    the optimiser only below its size limit.
    """
    t, s = target.withColumn("__t", F.lit(True)).alias("target"), source.withColumn("__s", F.lit(True)).alias("source")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"target.{k}") == F.col(f"source.{k}"))
    both = t.join(s, on, "full_outer")
    in_t, in_s = F.col("target.__t").isNotNull(), F.col("source.__s").isNotNull()
    update = in_t & in_s & (F.coalesce(F.expr(condition), F.lit(False)) if condition else F.lit(when_matched == "update"))
    if when_matched == "delete":
        both = both.where(~(in_t & in_s))
    if when_not_matched == "do_nothing":
        both = both.where(in_t)
    out = []
    for c in [*target.columns, *[c for c in source.columns if c not in target.columns]]:
        old = F.col(f"target.{c}") if c in target.columns else F.lit(None)
        new = F.col(f"source.{c}") if c in source.columns else old
        if c in preserve and c in target.columns:
            new = old if c not in source.columns else F.when(in_t, old).otherwise(new)
        out.append(F.when(~in_t, F.col(f"source.{c}") if c in source.columns else F.lit(None)).when(update, new).otherwise(old).alias(c))
    return both.select(*out)


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows a merge would update and insert."""
    marked = source.join(target.select(*keys).distinct().withColumn("__t", F.lit(True)), list(keys), "left")
    return marked.agg(F.count_if(F.col("__t")).alias("rows_updated"), F.count_if(F.col("__t").isNull()).alias("rows_inserted"))


def unseen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not in seen."""
    return df.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def appended_once(df: DataFrame, event_key: str, key: str, order: Sequence[str]) -> DataFrame:
    """What an idempotent append adds: the last row of each event, then of each key."""
    return keep_last(keep_last(df, [event_key], order), [key], order)


# --- files -----------------------------------------------------------------------------------


#: Columns by which tables are laid out, by a part of their name. Fixed values.
LAYOUT_COLUMNS = {
    "inventory": ["created_date", "status", "trace_id"],
    "retry_queue": ["retry_count", "error_type", "created_date"],
    "attachments": ["download_status", "attachment_url", "created_date"],
}


def layout_columns(path: str, filters: Sequence[str] = ()) -> list[str]:
    """The columns to cluster a table by: those that queries filter on, else what its name suggests."""
    return list(filters) or next((c for part, c in LAYOUT_COLUMNS.items() if part in path.lower()), ["created_date"])


#: Partition columns of a Folder: what was appended together, and the bucket of a row's keys.
BATCH, BUCKET = "__batch", "__bucket"


@dataclass(frozen=True)
class Written:
    """What one write did. rows is counted by the write itself; columns are those written, of which no rows need be left."""

    operation: str
    rows: int
    new_columns: tuple[str, ...] = ()
    token: str | None = None
    columns: tuple[str, ...] = ()


@dataclass
class Folder:
    """A table as a folder of Parquet files, written by Spark's own writer alone.

    Without keys it is appended to: each append is a partition of its own, named by its token, so that
    one that comes again replaces itself. With keys rows lie in buckets of their keys: a merge reads and
    writes only the buckets that its batch's keys meet, and an append adds files to them. Snapshots,
    concurrent writers, time travel, compaction and vacuum are a table format's work and not done here.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    buckets: int = 32
    history: list[Written] = field(default_factory=list)

    def exists(self) -> bool:
        """Whether the table has rows; a write of none leaves nothing to read."""
        parts = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/__*")
        found = parts.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(parts)
        return found is not None and len(found) > 0

    def _files(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(self.path)

    def read(self) -> DataFrame:
        """All rows; columns that only some writes had are null in the others."""
        return self._files().drop(BATCH, BUCKET)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, by: Sequence[str], operation: str, token: str | None, before: Sequence[str], mode: str = "overwrite") -> Written:
        seen = Observation()
        out = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        out.partitionBy(*by).parquet(self.path)
        own = [c for c in df.columns if c not in (BATCH, BUCKET)]
        known = {*before, *[c for w in self.history for c in w.columns]}
        new = [c for c in own if c not in known] if known else []
        self.history.append(Written(operation, seen.get.get("rows", 0), tuple(new), token, tuple(own)))
        return self.history[-1]

    def append(self, df: DataFrame, token: str | None = None) -> Written:
        """Adds rows, aligned to the table's columns: further columns are added, misfits become null. Once for each token.

        A table with keys keeps a row's key alone, not what it was appended with, so its appends have no tokens.
        """
        if self.keys and token is not None:
            raise ValueError("an append to a table with keys has no token")
        had = self.read().schema if self.exists() else None
        rows = align(df, had) if had else df
        if self.keys:
            return self._write(rows.withColumn(BUCKET, self._bucket()).repartition(BUCKET), [BUCKET], "append", None, had.names if had else (), mode="append")
        batch = token if token is not None else f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        return self._write(rows.withColumn(BATCH, F.lit(f"b {batch}")), [BATCH, *self.partition_by], "append", token, had.names if had else ())

    def merge(self, source: DataFrame, order: Sequence[str], **options) -> Written:
        """merged() with a batch whose rows of one key are first coalesced in order. Buckets without its keys stay as they are."""
        had = self.read().schema if self.exists() else None
        batch = coalesced_by_key(align(source, T.StructType([f for f in had if f.name in source.columns])) if had else source, self.keys, order)
        batch = working.staged(batch.withColumn(BUCKET, self._bucket()), "batch")
        rows = batch
        if had:
            met = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
            old = self._files().where(F.col(BUCKET).isin(met)).drop(BUCKET)
            rows = working.staged(merged(old, batch.drop(BUCKET), self.keys, **options).withColumn(BUCKET, self._bucket()), "merged")
            left = {r[0] for r in rows.select(BUCKET).distinct().collect()}
            for gone in sorted(set(met) - left):  # a merge that deletes may leave a bucket without rows
                at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BUCKET}={gone}")
                at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        return self._write(rows.repartition(BUCKET), [BUCKET], "merge", None, had.names if had else ())


def write_history(folder: Folder) -> DataFrame:
    """One row for each write of a Folder in this session: version, operation, rows_affected, schema_changes."""
    rows = [(n, w.operation, w.rows, [f"+{c}" for c in w.new_columns]) for n, w in enumerate(folder.history, 1)]
    return folder.spark.createDataFrame(rows, "version int, operation string, rows_affected long, schema_changes array<string>")


def table_statistics(named: dict[str, Folder]) -> DataFrame:
    """One row for each table: writes of this session, rows and columns."""
    parts = [t.read().agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), F.lit(len(t.history)).alias("versions"), "rows", F.lit(len(t.read().columns)).alias("columns")) for name, t in named.items()]
    return reduce(DataFrame.unionByName, parts)
