"""Ordered scans that no key can make one task of: rows are dealt by ranges of (keys, order).

A range is scanned by itself, one summary row a key and range is scanned over the ranges before it,
and what it carries is added to the range's rows. Only a key that goes on from one range to the next
needs a carry, so there are at most two carries a range, whatever the keys: that is what is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import working

PART = "__part"


@dataclass(frozen=True)
class Value:
    """total: running sum with the row's own, nulls as 0. last: the newest value that is not null, with the row's own. before: the value of the row before."""

    kind: str
    of: Column


def total(of: Column) -> Value:
    return Value("total", of)


def number() -> Value:
    """The row's number in its key, from 1."""
    return Value("total", F.lit(1).cast("bigint"))


def last(of: Column) -> Value:
    return Value("last", of)


def before(of: Column) -> Value:
    return Value("before", of)


def same(a: DataFrame, b: DataFrame, names: Mapping[str, str] | Sequence[str]) -> Column:
    """The condition that columns are equal, null being equal to null."""
    pairs = names.items() if isinstance(names, Mapping) else [(n, n) for n in names]
    out = F.lit(True)
    for left, right in pairs:
        out = out & a[left].eqNullSafe(b[right])
    return out


@dataclass(frozen=True)
class Ranges:
    """Rows with the number of their range; scans leave them where they are."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    parts: int
    reverse: bool = False
    #: Whether each range is in a task of its own already.
    at_home: bool = False

    def _sorts(self) -> list[Column]:
        return [F.col(o).desc_nulls_last() if self.reverse else F.col(o).asc_nulls_first() for o in self.order]

    def placed(self) -> DataFrame:
        """The rows, each range in a task of its own."""
        return self.rows if self.at_home else self.rows.repartitionById(self.parts, F.col(PART))

    def sorted(self) -> DataFrame:
        return self.placed().sortWithinPartitions(*self.keys, *self._sorts())

    def scan(self, **values: Value) -> Ranges:
        """The same rows with a column for each value, taken over all rows of the key up to each row, in order."""
        w = Window.partitionBy(PART, *self.keys).orderBy(*self._sorts())
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        at, newest = F.struct(*self.order), (F.min_by if self.reverse else F.max_by)
        local, summary, carry, joined = {}, [], {}, {}
        earlier = Window.partitionBy(*self.keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        for name, v in values.items():
            own, s, c = f"__own_{name}", f"__sum_{name}", f"__carry_{name}"
            if v.kind == "total":
                local[own] = F.sum(F.coalesce(v.of, F.lit(0))).over(upto)
                summary.append(F.sum(F.coalesce(v.of, F.lit(0))).alias(s))
                carry[c] = F.sum(s).over(earlier)
                joined[name] = F.col(own) + F.coalesce(F.col(c), F.lit(0))
            elif v.kind == "last":
                local[own] = F.last(v.of, ignorenulls=True).over(upto)
                summary.append(newest(v.of, F.when(v.of.isNotNull(), at)).alias(s))
                carry[c] = F.last(s, ignorenulls=True).over(earlier)
                joined[name] = F.coalesce(F.col(own), F.col(c))
            else:
                boxed = F.struct(v.of.alias("v"))  # a null value is not a missing row
                local[own] = F.lag(boxed).over(w)
                summary.append(newest(boxed, at).alias(s))
                carry[c] = F.last(s, ignorenulls=True).over(earlier)
                joined[name] = F.coalesce(F.col(own), F.col(c))["v"]
        parts = self.rows.groupBy(PART, *self.keys).agg(*summary)
        spread = parts.withColumns({"__in": F.count("*").over(Window.partitionBy(*self.keys)), **carry}).where("__in > 1")
        carries = spread.select(F.col(PART).alias("__p"), *[F.col(k).alias(f"__key{i}") for i, k in enumerate(self.keys)], *carry)
        rows = self.placed().withColumns(local)
        on = same(rows, carries, {PART: "__p", **{k: f"__key{i}" for i, k in enumerate(self.keys)}})
        both = rows.join(F.broadcast(carries), on, "left")
        return replace(self, at_home=True, rows=both.select(*[F.col(f"`{c}`") for c in self.rows.columns], *[c.alias(n) for n, c in joined.items()]))

    def with_columns(self, columns: Mapping[str, Column]) -> Ranges:
        return replace(self, rows=self.rows.withColumns(dict(columns)))

    def drop(self, *columns: str) -> Ranges:
        return replace(self, rows=self.rows.drop(*columns))

    def staged(self) -> Ranges:
        """The same, written: what follows does not scan again."""
        return replace(self, at_home=False, rows=working.staged(self.rows, "ranges"))

    def result(self) -> DataFrame:
        return self.rows.drop(PART)


def ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], reverse: bool = False, parts: int | None = None) -> Ranges:
    """df dealt by ranges of (keys, order), as many as shuffle partitions, and written.

    Nulls are the smallest values; null keys are one key. Rows equal in keys and order come in no set
    order and share a range: end the order with an id where one time may hold many rows.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = Ranges(df, tuple(keys), tuple(order), n, reverse)
    placed = df.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys], *out._sorts()).withColumn(PART, F.spark_partition_id())
    return replace(out, rows=working.staged(placed, "ranges"))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "number") -> DataFrame:
    """df with the number of each row in its key, from 1."""
    return ranges(df, keys, order).scan(**{name: number()}).result()


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: Column, right_at: Column, take: Sequence[str], order: Sequence[str] = (), forward: bool = False, into: str = "found") -> DataFrame:
    """left with a struct of right's columns `take`, from the newest row of the same keys whose time is not after the row's.

    forward: the oldest row whose time is not before it. Of rows of one time, that with the greatest
    (forward: smallest) `order` columns counts. Rows without a time, or that find none, get null; null
    keys meet null keys. One ordered scan over both tables; no key or time makes a task of its own.
    """
    kind = (1, 0) if forward else (0, 1)  # of one time, right's rows come first
    names = left.columns
    boxed = F.struct(*[F.col(c) for c in take])
    probes = left.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], at.alias("__at"), F.lit(kind[1]).alias("__kind"), F.xxhash64(*[F.col(f"`{c}`").cast("string") if t.startswith(("map", "variant")) else F.col(f"`{c}`") for c, t in left.dtypes]).alias("__tie"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("__left"), *[F.lit(None).cast(right.schema[o].dataType).alias(f"__o{i}") for i, o in enumerate(order)])
    values = right.where(right_at.isNotNull()).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], right_at.alias("__at"), F.lit(kind[0]).alias("__kind"), F.lit(0).cast("bigint").alias("__tie"), boxed.alias("__right"), *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)])
    both = probes.unionByName(values, allowMissingColumns=True)
    line = ranges(both, [f"__k{i}" for i in range(len(keys))], ["__at", "__kind", *[f"__o{i}" for i in range(len(order))], "__tie"], reverse=forward)
    out = line.scan(__found=last(F.col("__right"))).rows.where(F.col("__left").isNotNull())
    return out.select(*[F.col("__left")[c].alias(c) for c in names], F.when(F.col("__at").isNotNull(), F.col("__found")).alias(into))
