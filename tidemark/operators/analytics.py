"""Duplicate and quality reports, task-lifecycle analytics and distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, different keys (null counts as one), duplicates and their percentage."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    sums = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_keys"))
    extra = F.col("total_rows") - F.col("unique_keys")
    return sums.select("total_rows", "unique_keys", extra.alias("duplicate_rows"), F.when(F.col("total_rows") > 0, F.round(extra * 100.0 / F.col("total_rows"), 2)).otherwise(0.0).alias("duplicate_pct"))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def rows_of_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys occur more than once."""
    return df.join(duplicate_groups(df, keys).drop("n"), list(keys), "left_semi")


def duplicate_spans(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """For each repeated key: first and last time, rows and seconds between."""
    spans = df.groupBy(*keys).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count("*").alias("n")).where("n > 1")
    return spans.withColumn("span_seconds", F.timestamp_diff("SECOND", F.col("first_seen"), F.col("last_seen")))


def duplicate_band(pct: Column) -> Column:
    return F.when(pct > 10, "high").when(pct > 1, "moderate").otherwise("low")


def hourly(df: DataFrame, ts: str, key: str) -> DataFrame:
    """Rows and different keys by hour. Both counts come from one shuffle on hour and key."""
    per_key = df.groupBy(F.date_trunc("HOUR", ts).cast("timestamp_ntz").alias("hour"), F.col(key).alias("__key")).agg(F.count("*").alias("n"))
    return per_key.groupBy("hour").agg(F.sum("n").alias("n_rows"), F.count("__key").alias("n_keys"))


def distribution(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    out = df.groupBy(column).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), column).limit(top) if top else out


def status_distribution(df: DataFrame, status: str, task: str) -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("event_count"), F.count_distinct(task).alias("unique_tasks"))


def daily_activity(df: DataFrame, ts: str, kind: str, begun: str, done: str, task: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("activity_date")).agg(F.count_if(F.col(kind) == begun).alias("tasks_assigned"), F.count_if(F.col(kind) == done).alias("tasks_completed"), F.count_distinct(task).alias("unique_tasks"))


def completion_rate(df: DataFrame, owner: str, task: str, done: Column) -> DataFrame:
    """Different tasks of each owner, those done, and their percentage."""
    per_task = df.where(F.col(owner).isNotNull()).groupBy(owner, task).agg(F.bool_or(done).alias("done"))
    counts = per_task.groupBy(owner).agg(F.count(task).alias("tasks_assigned"), F.count_if("done").alias("tasks_completed"))
    return counts.withColumn("completion_rate_pct", F.round(F.col("tasks_completed") * 100.0 / F.nullif("tasks_assigned", F.lit(0)), 2))


def group_metrics(df: DataFrame, group: str, task: str, done: Column, active: Column, hours: Column) -> DataFrame:
    return df.groupBy(group).agg(
        F.count_distinct(task).alias("total_tasks"),
        F.count_distinct(F.when(done, F.col(task))).alias("completed_tasks"),
        F.count_distinct(F.when(active, F.col(task))).alias("active_tasks"),
        F.avg(hours).alias("avg_hours_to_complete"),
    )


def processing_lag(df: DataFrame, day: Column, seconds: Column) -> DataFrame:
    return df.groupBy(day.alias("event_date")).agg(F.avg(seconds).alias("avg_lag_seconds"), F.max(seconds).alias("max_lag_seconds"), F.count("*").alias("event_count"))


def issue_counts(issues: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """issue_type and count for each named condition over its table, one aggregation a table."""
    out = None
    for name, df, condition in issues:
        one = df.agg(F.count_if(condition).alias("count")).select(F.lit(name).alias("issue_type"), "count")
        out = one if out is None else out.union(one)
    return out


def time_since_last(df: DataFrame, key: Sequence[str], order: Sequence[str], ts: str, unit: str = "MINUTE") -> DataFrame:
    """df with since_last: complete units since the row before, in each key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("since_last", F.timestamp_diff(unit, F.lag(ts).over(w), F.col(ts)))


def transitions(df: DataFrame, key: Sequence[str], order: Sequence[str], status: str, first: str = "CREATED") -> DataFrame:
    """How often each status followed another; `first` stands before the first of a key."""
    w = Window.partitionBy(*key).orderBy(*order)
    steps = df.select(F.coalesce(F.lag(status).over(w), F.lit(first)).alias("from_status"), F.col(status).alias("to_status"))
    return steps.groupBy("from_status", "to_status").agg(F.count("*").alias("transition_count"))


def unfinished(latest: DataFrame, status: str, finished: Sequence[str], ts: str, today: Column) -> DataFrame:
    """Latest rows that are not finished, with whole days since."""
    return latest.where(~F.col(status).isin(*finished)).withColumn("days_since_last_update", F.datediff(today, F.to_date(ts)))


def handler_results(df: DataFrame, handler: str, success: Column, permanent: Column, calls: str) -> DataFrame:
    """Totals of processing outcomes by handler."""
    return df.groupBy(handler).agg(F.count("*").alias("total"), F.count_if(success).alias("succeeded"), F.count_if(~success).alias("failed"), F.count_if(~success & permanent).alias("failed_permanent"), F.sum(calls).alias("api_calls"))


def retry_ratio(df: DataFrame, by: Sequence[str], retried: Column) -> DataFrame:
    """The share of calls that were retried."""
    return df.groupBy(*by).agg(F.count("*").alias("calls"), F.count_if(retried).alias("retried")).withColumn("retry_ratio", F.col("retried") / F.col("calls"))


def first_samples(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """The n smallest values of each group as one array. The window ranks before the values are gathered, so arrays stay short."""
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(value))).where(F.col("__r") <= n)
    return ranked.groupBy(group).agg(F.array_sort(F.collect_list(value)).alias("samples"))


def age_seconds(df: DataFrame, millis: str, now: Column) -> DataFrame:
    """df with age_seconds of a time in epoch milliseconds."""
    return df.withColumn("age_seconds", now - F.col(millis) / 1000)
