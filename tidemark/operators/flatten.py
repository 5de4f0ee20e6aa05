"""Event rows with a JSON column made flat and typed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text

#: Output column -> path in the JSON of `data`. Fixed values.
FIELDS = {
    "description": ("description",),
    "assignment_id": ("assignmentId",),
    "original_assignment_id": ("originalAssignmentId",),
    "xn_address": ("xnAddress",),
    "carrier_id": ("carrierId",),
    "estimate_version": ("estimateVersion",),
    "note": ("note",),
    "author": ("author",),
    "sender_reviewer_name": ("senderReviewerName",),
    "sender_reviewer_email": ("senderReviewerEmail",),
    "carrier_reviewer_name": ("carrierReviewerName",),
    "carrier_reviewer_email": ("carrierReviewerEmail",),
    "event_datetime_mdt": ("dateTime",),
    "attachments": ("attachments",),
    "claim_number": ("adm", "coverageLoss", "claimNumber"),
    "contact_type": ("contact", "type"),
    "contact_name": ("contact", "name"),
    "contact_phone_type": ("contact", "contactMethods", "phone", "type"),
    "contact_phone_number": ("contact", "contactMethods", "phone", "number"),
    "contact_phone_extension": ("contact", "contactMethods", "phone", "extension"),
    "contact_email_address": ("contact", "contactMethods", "email", "address"),
}


def event_id_of(df: DataFrame) -> Column:
    for name in ("event_id", "eventId"):
        if name in df.columns:
            return F.col(name).cast("string")
    return F.lit(None).cast("string")


def json_schema(paths: Iterable[tuple[str, ...]]) -> T.StructType:
    """A schema with a string (for objects and lists: their JSON) at the end of each path."""
    tree: dict = {}
    for path in paths:
        at = tree
        for key in path[:-1]:
            at = at.setdefault(key, {})
        at[path[-1]] = None

    def struct(at: dict) -> T.StructType:
        return T.StructType([T.StructField(k, T.StringType() if v is None else struct(v)) for k, v in at.items()])

    return struct(tree)


def flatten_events(df: DataFrame) -> DataFrame:
    """type, status_subtype, version, ingested_at, event_date, trace_id, event_id, the 21 fields of data, raw_json.

    Invalid JSON, JSON that is no object, missing keys and nulls give null fields; one scan, no
    shuffle, and data is parsed once.
    """
    at = F.col("utcDateTime").try_cast("timestamp")
    values = {name: F.col(".".join(("__data", *path))) for name, path in FIELDS.items()}
    values["attachments"] = text.comma_joined(F.when(F.substring(values["attachments"], 1, 1) == "[", F.from_json(values["attachments"], "array<string>")))
    fields = [c.alias(name) for name, c in values.items()]
    return df.withColumn("__data", F.from_json("data", json_schema(FIELDS.values()))).select(
        "type", text.last_segment(F.col("type")).alias("status_subtype"), F.col("version").cast("string").alias("version"),
        at.alias("ingested_at"), F.to_date(at).alias("event_date"), F.col("traceId").alias("trace_id"), event_id_of(df).alias("event_id"),
        *fields, F.to_json(F.struct(*df.columns)).alias("raw_json"),
    )


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is null."""
    return df.dropna(subset=list(columns))


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    """df with year, month and day of a timestamp, as partition columns."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def mapped(df: DataFrame, mapping: dict[str, str], defaults: dict | None = None) -> DataFrame:
    """Output columns from dotted input paths; a default replaces nulls, and a missing column is null or its default."""
    defaults = defaults or {}
    out = []
    for name, path in mapping.items():
        c = F.col(path) if path.split(".")[0] in df.columns else F.lit(None)
        out.append((F.coalesce(c, F.lit(defaults[name])) if name in defaults else c).alias(name))
    return df.select(*out, *[F.lit(v).alias(k) for k, v in defaults.items() if k not in mapping])


def validated(df: DataFrame, required=(), allowed: dict | None = None, least: dict | None = None, most: dict | None = None, equals: dict | None = None, skip_if: Column | None = None) -> DataFrame:
    """df with validation_status (ok, skipped, failed) and validation_error, the first rule that fails."""
    out = F.lit(None).cast("string")
    checks = []
    checks += [(F.col(c).isNull(), f"Missing required field: {c}") for c in required]
    checks += [(~F.col(c).isin(*v), f"Value not allowed: {c}") for c, v in (allowed or {}).items()]
    checks += [(F.col(c) < v, f"Below minimum: {c}") for c, v in (least or {}).items()]
    checks += [(F.col(c) > v, f"Above maximum: {c}") for c, v in (most or {}).items()]
    checks += [(F.col(c) != v, f"Not equal: {c}") for c, v in (equals or {}).items()]
    for bad, message in reversed(checks):
        out = F.when(bad, message).otherwise(out)
    if skip_if is not None:
        out = F.when(F.coalesce(skip_if, F.lit(False)), F.lit(None)).otherwise(out)
    status = F.when(out.isNotNull(), "failed").otherwise("ok")
    if skip_if is not None:
        status = F.when(F.coalesce(skip_if, F.lit(False)), "skipped").otherwise(status)
    return df.withColumn("validation_status", status).withColumn("validation_error", out)
