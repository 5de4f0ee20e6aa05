"""What each table gets: projections of events and results, and the way in which rows are written."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from . import flatten, forms
from .tables import Folder

#: Keys of the entity tables. Fixed values.
MERGE_KEYS = {
    "projects": ["project_id"],
    "contacts": ["project_id", "contact_email", "contact_type"],
    "media": ["media_id"],
    "tasks": ["assignment_id"],
    "task_templates": ["task_id"],
    "external_links": ["link_id"],
    "video_collab": ["video_collaboration_id"],
}
#: Tables that are only appended to, and the condition under which a matched row changes. Fixed values.
APPENDED = ("contacts", "media")
CONDITIONS = {"task_templates": "source.modified_date <> target.modified_date OR target.modified_date IS NULL"}

#: Columns of the result tables, as written. Fixed values.
INVENTORY = ("media_id", "trace_id", "attachment_url", "blob_path", "file_type", "status_subtype", "assignment_id", "bytes_downloaded")
FAILED = ("media_id", "trace_id", "attachment_url")
TRACKING = ("trace_id", "media_id", "attachment_url", "blob_path", "status_subtype", "file_type", "assignment_id", "status", "http_status", "bytes_downloaded", "retry_count", "error_message", "created_at", "expires_at", "expired_at_ingest")
ENRICHMENT = ("media_id", "task_assignment_id", "video_collaboration_id", "master_file_name")


def raw_event_rows(events: DataFrame, now: Column) -> DataFrame:
    """Flattened events with the time and date of writing."""
    return flatten.flatten_events(events).withColumns({"created_at": now, "created_date": F.to_date(now)})


def inventory_rows(results: DataFrame, now: Column) -> DataFrame:
    """Results of completed downloads as rows of the inventory."""
    return results.where(F.col("status") == "completed").select(*INVENTORY, F.col("created_at").alias("downloaded_at"), now.alias("created_at"), F.to_date(now).alias("event_date"))


def failed_rows(results: DataFrame, now: Column) -> DataFrame:
    """Results that failed for good as rows of the failed table; an empty message becomes a stated one."""
    message = F.coalesce(F.nullif("error_message", F.lit("")), F.lit("Unknown error"))
    return results.where(F.col("status") == "failed_permanent").select(
        *FAILED, message.alias("error_message"), "status", F.col("created_at").alias("failed_at"), F.col("retry_count").cast("long").alias("retry_count"), F.col("http_status").cast("long").alias("http_status"), now.alias("created_at")
    )


def tracking_rows(results: DataFrame) -> DataFrame:
    """Every result with the columns of the tracking table; those that a result lacks are null."""
    return flatten.mapped(results, {c: c for c in TRACKING})


def domain_event_rows(events: DataFrame, now: Column) -> DataFrame:
    """Events with an id and a type as rows: text times are parsed, missing ones are now; raw data is left out."""
    at = F.coalesce(text.iso_timestamp(F.col("ingested_at").cast("string")).try_cast("timestamp"), now)
    kept = [c for c in ("event_id", "event_type", "project_id", *ENRICHMENT) if c in events.columns]
    rows = flatten.present(events, "event_id", "event_type").withColumn("__at", at)
    return rows.select(*kept, F.col("__at").alias("ingested_at"), F.to_date("__at").alias("event_date"), now.alias("created_at"))


def enrichment_tasks(events: DataFrame, now: Column) -> DataFrame:
    """The task that each event gives."""
    return events.select("event_id", "event_type", "project_id", F.lit(0).alias("retry_count"), now.alias("created_at"), *[F.col(c) if c in events.columns else F.lit(None).cast("string").alias(c) for c in ENRICHMENT])


def with_audit(rows: DataFrame, now: Column) -> DataFrame:
    """rows with created_at and updated_at, now where they are missing or null."""
    return rows.withColumns({c: F.coalesce(F.col(c), now) if c in rows.columns else now for c in ("created_at", "updated_at")})


def entity_table(spark: SparkSession, path: str, name: str) -> Folder:
    """The table of an entity: appended to, or merged by its keys."""
    return Folder(spark, path, () if name in APPENDED else MERGE_KEYS[name])


def write_rows(table: Folder, name: str, rows: DataFrame, now: Column, order: Sequence[str] = ("updated_at",)) -> int:
    """Rows into an entity table, in the way of that table: append, merge or merge under a condition. Returns how many were written."""
    rows = with_audit(rows, now)
    if name in APPENDED:
        return table.append(rows).rows
    return table.merge(rows, order, condition=CONDITIONS.get(name)).rows


def write_all(tables: Mapping[str, Folder], rows: Mapping[str, DataFrame], now: Column) -> dict[str, int]:
    """The rows of a batch into their tables, and how many rows each write wrote; names without keys or a table are left alone."""
    done = {name: write_rows(tables[name], name, df, now) for name, df in rows.items() if name in MERGE_KEYS and name in tables}
    return {name: n for name, n in done.items() if n}


def mapped_writer(table: Folder, mapping: dict[str, str], defaults: dict | None = None) -> Callable[[DataFrame, int], None]:
    """A sink for batches: output columns from input paths, appended once a batch with new columns kept."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.append(flatten.mapped(batch, mapping, defaults), token=f"batch {batch_id}")

    return sink


def form_writer(submissions: Folder, attachments: Folder, response: str, key: str, fields: Sequence[str], controls: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """A sink for batches of forms with two tables: one row a form, and one row an attachment, each once a batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        token = f"batch {batch_id}"
        answers = forms.answers(batch, response, key, known=forms.QUESTION_FIELDS)
        submissions.append(forms.submissions(answers, [key], fields), token=token)
        attachments.append(forms.attachments(batch, response, key, controls), token=token)

    return sink


def counted(df: DataFrame, write: Callable[[DataFrame], None], **counts: Column) -> dict[str, int]:
    """Writes df and returns the named aggregates over it, computed by the write's own pass."""
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in counts.items()]))
    return dict(seen.get)


def committed(letters: DataFrame, done: Column | None = None) -> DataFrame:
    """topic, partition and next offset after the messages that are done; done=None: all (a purge)."""
    own = letters if done is None else letters.where(done)
    return own.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def pending(letters: DataFrame, offsets: DataFrame) -> DataFrame:
    """The messages from the committed offsets on; a partition without any is pending as a whole."""
    both = letters.join(offsets, ["topic", "partition"], "left")
    return both.where(F.col("next_offset").isNull() | (F.col("offset") >= F.col("next_offset"))).select(*letters.columns)


def resolved(letters: DataFrame, status: DataFrame, keys: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """Messages with their latest resolution (columns keys, resolution, at), open where there is none."""
    latest = status.groupBy(*keys).agg(F.max_by("resolution", "at").alias("resolution"))
    return letters.join(latest, list(keys), "left").withColumn("resolution", F.coalesce("resolution", F.lit("open")))


def evicted(df: DataFrame, ts: str, key: str, most: int) -> DataFrame:
    """df as a cache of at most `most` rows leaves it: a full one loses its oldest tenth. The count is one job."""
    if df.count() < most:
        return df
    return df.join(df.orderBy(ts, key).limit(most // 10).select(key), key, "left_anti").select(*df.columns)


def beside(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """df with further columns of the same rows beside its own: a projection, never a join."""
    return df.select("*", *[c.alias(name) for name, c in columns.items()])
