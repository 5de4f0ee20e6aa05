"""Analytics over metric samples: rates, quantiles of histograms, sustained alerts, lag rollups.

Samples are rows of a time, a value and label columns; a series is one combination of labels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered


def parsed_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """metric, labels (map) and value of exposition text; comments and misfits are left out."""
    line, pattern = F.trim(column), "^([a-zA-Z_:][a-zA-Z0-9_:]*)(?:\\{(.*)\\})?\\s+(\\S+).*$"
    pair = '([a-zA-Z_][a-zA-Z0-9_]*)="([^"]*)"'
    inside = F.regexp_extract(line, pattern, 2)
    labels = F.map_from_arrays(F.regexp_extract_all(inside, F.lit(pair), F.lit(1)), F.regexp_extract_all(inside, F.lit(pair), F.lit(2)))
    number = F.regexp_replace(F.regexp_replace(F.regexp_extract(line, pattern, 3), "^\\+?Inf$", "Infinity"), "^-Inf$", "-Infinity")
    out = lines.where((line != "") & ~line.startswith("#") & line.rlike(pattern))
    return out.select(F.regexp_extract(line, pattern, 1).alias("metric"), labels.alias("labels"), number.try_cast("double").alias("value")).where(F.col("value").isNotNull())


def latest(samples: DataFrame, series: Sequence[str], ts: str, value: str) -> DataFrame:
    """The newest value of each series."""
    return samples.groupBy(*series).agg(F.max_by(value, ts).alias("value"), F.max(ts).alias("at"))


def _stepped(samples: DataFrame | ordered.Ranges, series: Sequence[str], order: Sequence[str], value: str) -> ordered.Ranges:
    line = samples if isinstance(samples, ordered.Ranges) else ordered.ranges(samples, series, order)
    line = line.scan(__before=ordered.before(F.col(value)))
    was = F.col("__before")
    gain = F.when(was.isNull(), F.lit(0)).when(F.col(value) < was, F.col(value)).otherwise(F.col(value) - was)
    return line.with_columns({"increase": gain}).drop("__before")


def steps(samples: DataFrame | ordered.Ranges, series: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """samples with increase: what a counter gained since the sample before; after a reset, its new value.

    Series are scanned by ranges of time, so that one may hold any share of the samples.
    """
    return _stepped(samples, series, order, value).result()


def cumulated(counts: DataFrame, series: Sequence[str], order: Sequence[str], value: str, into: str) -> ordered.Ranges:
    """counts with the running sum of a column in each series, in ranges that steps() and rate() take as they are."""
    return ordered.ranges(counts, series, order).scan(**{into: ordered.total(F.col(value))})


def increase(samples: DataFrame | ordered.Ranges, series: Sequence[str], order: Sequence[str], value: str, window: Column) -> DataFrame:
    """The gain of each series in each time window."""
    return steps(samples, series, order, value).groupBy(*series, window.alias("window_start")).agg(F.sum("increase").alias("increase"))


def rate(samples: DataFrame | ordered.Ranges, series: Sequence[str], ts: str, value: str, seconds: int) -> DataFrame:
    """samples with rate: the gain a second over the range of `seconds` up to each sample.

    The gain of a range is the difference of two running sums: that at its end, and that at its first
    sample, which an ordered lookup finds. No range of time is held in memory.
    """
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    columns = [c for c in (samples.rows if isinstance(samples, ordered.Ranges) else samples).columns if c != ordered.PART]
    line = _stepped(samples, series, [ts], value).scan(__sum=ordered.total(F.col("increase"))).with_columns({"__s": second}).staged().result()
    per = line.groupBy(*series, "__s").agg(F.max_by("__sum", ts).alias("__end"), F.min_by("__sum", ts).alias("__first"))
    begun = ordered.as_of(per, per, series, F.col("__s") - seconds, F.col("__s"), ["__s", "__first"], forward=True, into="__from")
    span = F.col("__s") - F.col("__from")["__s"]
    rates = begun.select(*[F.col(c).alias(f"__of_{c}") for c in series], F.col("__s").alias("__at"), F.when(span > 0, (F.col("__end") - F.col("__from")["__first"]) / span).alias("rate"))
    both = line.join(rates, ordered.same(line, rates, {**{c: f"__of_{c}" for c in series}, "__s": "__at"}), "left")
    return both.select(*columns, "increase", "rate")


def histogram_quantile(buckets: DataFrame, series: Sequence[str], bound: str, count: str, q: float) -> DataFrame:
    """The quantile of cumulative buckets by linear interpolation; the last bound has no upper end.

    As in the usual definition: in the lowest bucket from 0 on, in the endless one the bound below.
    """
    w = Window.partitionBy(*series).orderBy(bound)
    rows = buckets.withColumns({"below": F.coalesce(F.lag(count).over(w), F.lit(0.0)), "start": F.coalesce(F.lag(bound).over(w), F.lit(0.0)), "total": F.max(count).over(Window.partitionBy(*series))})
    rank = F.lit(q) * F.col("total")
    hit = rows.where((F.col(count) >= rank) & ((F.col("below") < rank) | (F.col("start") == 0)))
    first = hit.groupBy(*series).agg(F.min_by(F.struct("start", F.col(bound).alias("stop"), "below", F.col(count).alias("upto"), "total"), bound).alias("b"))
    b = F.col("b")
    inner = b["start"] + (b["stop"] - b["start"]) * F.try_divide(F.lit(q) * b["total"] - b["below"], b["upto"] - b["below"])
    return first.select(*series, F.when(b["stop"] == float("inf"), b["start"]).otherwise(inner).alias("quantile"))


def sustained(samples: DataFrame, series: Sequence[str], ts: str, condition: Column, seconds: int) -> DataFrame:
    """Runs of samples that all meet a condition, lasting at least `seconds`: first and last time, samples.

    Samples of one time stand together: one that does not meet the condition ends the run before them.
    """
    on = F.coalesce(condition, F.lit(False))
    per = samples.groupBy(*series, ts).agg(F.count_if(on).alias("__on"), F.count_if(~on).alias("__off"))
    runs = ordered.ranges(per, series, [ts]).scan(__run=ordered.total(F.col("__off"))).result().where("__on > 0")
    out = runs.groupBy(*series, "__run").agg(F.min(ts).alias("since"), F.max(ts).alias("until"), F.sum("__on").alias("samples")).drop("__run")
    return out.where(F.timestamp_diff("SECOND", F.col("since"), F.col("until")) >= seconds)


def ratio(df: DataFrame, by: Sequence[str], part: Column, whole: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(part).alias("part"), F.sum(whole).alias("whole")).withColumn("ratio", F.try_divide("part", "whole"))


def lag_rollup(offsets: DataFrame, group: str, topic: str, partition: str, high: str, offset: str) -> DataFrame:
    """Consumer lag by group and topic: summed, the largest of a partition, and partitions counted."""
    lagging = offsets.groupBy(group, topic, partition).agg((F.max(high) - (F.max(offset) + 1)).alias("lag"))
    return lagging.groupBy(group, topic).agg(F.sum("lag").alias("total_lag"), F.max("lag").alias("max_lag"), F.count("*").alias("partitions"))


def health(samples: DataFrame, up: Column) -> DataFrame:
    return samples.agg(F.count_if(up).alias("healthy"), F.count_if(~up).alias("unhealthy"))
