"""Where messages go: status routes, retries with levels, dead letters and their replay."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import errors
from . import ordered, working


def result_route(status: Column) -> Column:
    """inventory, failed or skip for a result status."""
    return F.when(status == "completed", "inventory").when(status == "failed_permanent", "failed").otherwise("skip")


def retry_route(df: DataFrame, category: Column, retries: Column, delays: Sequence[int], pending: str, dlq: str, now: Column) -> DataFrame:
    """df with route, reason, next_retry_count and retry_at of failed tasks.

    Permanent failures and those with as many retries as there are delays go to the dead letters;
    all others to the retry topic of their level, due after its delay.
    """
    dead = F.when(category == errors.PERMANENT, "permanent").when(retries >= len(delays), "exhausted")
    waits = F.array(*[F.lit(d) for d in delays])
    wait = F.when(dead.isNull(), F.try_element_at(waits, retries.cast("int") + 1))
    due = F.timestamp_add("SECOND", wait, now)
    return df.withColumns({"route": F.when(dead.isNotNull(), dlq).otherwise(errors.level_topic(pending, list(delays), retries)), "reason": F.coalesce(dead, F.lit("retry")), "next_retry_count": F.when(dead.isNull(), retries + 1).otherwise(retries), "retry_at": due})


def download_route(df: DataFrame, links: DataFrame, key: str, error: Column, category: Column, retries: Column, delays: Sequence[int], pending: str, dlq: str, now: Column, url: str = "download_url") -> DataFrame:
    """retry_route() of failed downloads, with url_refresh_attempted; links that ran out are replaced first.

    links: key and url, the links that could be fetched anew. A task that needs one and finds none
    goes to the dead letters.
    """
    fresh = links.groupBy(key).agg(F.max(url).alias("__fresh"))
    both = df.join(fresh, key, "left")
    open_ = (category != errors.PERMANENT) & (retries < len(delays))
    needs = F.coalesce(open_ & errors.needs_new_link(error, category), F.lit(False))
    both = both.withColumn("__needs", needs)
    lost = F.col("__needs") & F.col("__fresh").isNull()
    routed = retry_route(both, category, retries, delays, pending, dlq, now)
    out = {"route": F.when(lost, dlq).otherwise(F.col("route")), "reason": F.when(lost, "no new link").otherwise(F.col("reason"))}
    out |= {"next_retry_count": F.when(lost, retries).otherwise(F.col("next_retry_count")), "retry_at": F.when(~lost, F.col("retry_at"))}
    out |= {url: F.when(F.col("__needs"), F.coalesce("__fresh", url)).otherwise(F.col(url)), "url_refresh_attempted": F.col("__needs")}
    return routed.withColumns(out).drop("__fresh", "__needs")


def batch_route(df: DataFrame, retries: Column, most: int) -> DataFrame:
    """Failed batches by their retries alone."""
    return df.withColumn("route", F.when(retries >= most, "dlq").otherwise("retry"))


def due(df: DataFrame, retry_at: str, now: Column) -> DataFrame:
    return df.where(F.col(retry_at) <= now)


def replayed(letters: DataFrame, task: str = "original_task", metadata: str = "metadata") -> DataFrame:
    """The tasks of dead letters with retries reset and where they came from added to their metadata."""
    origin = F.create_map(F.lit("replayed_from_dlq"), F.lit("true"), F.lit("dlq_offset"), F.col("offset").cast("string"), F.lit("dlq_partition"), F.col("partition").cast("string"))
    base = F.coalesce(F.col(f"{task}.{metadata}"), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(base, lambda k, v: ~k.isin("replayed_from_dlq", "dlq_offset", "dlq_partition"))
    return letters.select(F.col(task).withField("retry_count", F.lit(0)).withField(metadata, F.map_concat(kept, origin)).alias("task")).select("task.*")


def depth(df: DataFrame, partition: str, offset: str) -> DataFrame:
    """Messages between the first and last offset of each partition, summed."""
    per = df.groupBy(partition).agg((F.max(offset) + 1 - F.min(offset)).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("dlq_depth"))


def batches(df: DataFrame, size: int, order: Sequence[str], within: Sequence[str]) -> DataFrame:
    """df with batch: consecutive rows of each group, `size` to a batch, from 1. A group may hold any share of the rows."""
    return ordered.numbered(df, within, order, "__number").withColumn("batch", F.ceil(F.col("__number") / size).cast("long")).drop("__number")


def sampled_letters(failed: DataFrame, events: str, most: int = 3) -> DataFrame:
    """Failed batches as dead letters: the first events stand for all."""
    return failed.withColumn("event_count", F.size(events)).withColumn("sample_events", F.slice(events, 1, most)).drop(events)


def deduplicated_within(df: DataFrame, key: Sequence[str], ts: str, order: Sequence[str], seconds: int) -> DataFrame:
    """A row stays if no row of its key that stayed lies less than `seconds` before it; rows without a time stay.

    A key's rows are cut where a gap is that long: each run stands alone. Runs that lie in one range
    of (key, time) are folded there, batch by batch. One that goes on over ranges (one a border at
    most) is solved by pointers from each row to the first row `seconds` later, which double in every
    round, so a key may hold any share of the rows.
    """
    span, at = seconds * 1_000_000, F.col("__t")
    timed = df.withColumn("__t", F.unix_micros(F.col(ts).cast("timestamp")))
    line = ordered.ranges(timed, key, ["__t", *order]).scan(__before=ordered.before(at))
    starts = at.isNotNull() & (F.col("__before").isNull() | (at - F.col("__before") >= span))
    line = line.with_columns({"__start": starts}).scan(__run=ordered.total(F.col("__start").cast("bigint")), __n=ordered.number()).staged()
    part = F.col(ordered.PART)
    over = line.rows.where(at.isNotNull()).groupBy(*key, "__run").agg(F.min(part).alias("__a"), F.max(part).alias("__b")).where("__a < __b")
    # One row a border of ranges at most: numbered in one task, and broadcast.
    over = working.staged(over.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(key)], F.col("__run").alias("__r"), F.row_number().over(Window.orderBy("__a", "__run")).alias("__long")), "long-runs")
    marked = line.rows.join(F.broadcast(over), ordered.same(line.rows, over, {**{k: f"__key{i}" for i, k in enumerate(key)}, "__run": "__r"}), "left")
    short = _folded(ordered.Ranges(marked.where("__long IS NULL"), line.keys, line.order, line.parts), df, [*key, "__run"], span)
    long = marked.where("__long IS NOT NULL")
    kept = _orbits(long.select("__long", "__n", "__t", "__start"), span)
    return short.unionByName(long.join(kept, ["__long", "__n"], "left_semi").select(*df.columns))


def _folded(line: ordered.Ranges, like: DataFrame, names: Sequence[str], span: int) -> DataFrame:
    """The rows that stay of runs that lie in one range; what is carried from batch to batch is one time."""
    columns = like.columns

    def fold(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, kept = None, None
        for part in parts:
            stays = []
            for *own, t in zip(*[part.column(k).to_pylist() for k in (*names, "__t")], strict=True):
                if own != run:
                    run, kept = own, None
                stays.append(t is None or kept is None or t - kept >= span)
                if stays[-1] and t is not None:
                    kept = t
            yield part.filter(pa.array(stays, pa.bool_())).select(columns)

    return line.sorted().mapInArrow(fold, like.schema)


def _orbits(rows: DataFrame, span: int) -> DataFrame:
    """__long and __n of the rows that stay: those that a run's first row reaches by steps to the first row `span` later."""
    jumps = ordered.as_of(rows, rows, ["__long"], F.col("__t") + span, F.col("__t"), ["__n"], ["__n"], forward=True, into="__to")
    jumps = working.staged(jumps.where("__to IS NOT NULL").select("__long", "__n", F.col("__to")["__n"].alias("__to")), "jumps")
    kept = rows.where("__start").select("__long", "__n")
    while not jumps.isEmpty():
        reached = kept.join(jumps, ["__long", "__n"]).select("__long", F.col("__to").alias("__n"))
        kept = working.staged(kept.unionByName(reached), "kept")
        on = jumps.select("__long", F.col("__n").alias("__to"), F.col("__to").alias("__beyond"))
        jumps = working.staged(jumps.join(on, ["__long", "__to"]).select("__long", "__n", F.col("__beyond").alias("__to")), "jumps")
    return kept
