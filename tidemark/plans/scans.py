"""Scans, incremental reads, projections and typed flattening over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import flatten, tables
from .registry import Queries, table

QUERIES = Queries()
_TS = "TIMESTAMP '2024-01-15 00:00:00'"


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


@QUERIES.add("SELECT o_orderkey, o_totalprice FROM orders")
def scan_project(spark, d):
    return tables.scan(table(spark, d, "orders"), ["o_orderkey", "o_totalprice"])


@QUERIES.add("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 500")
def scan_filter_pushdown(spark, d):
    rows = tables.scan_filtered(table(spark, d, "orders"), F.col("o_totalprice") > 200000, ["o_orderkey", "o_totalprice"])
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(500)


@QUERIES.add("SELECT c_custkey, c_mktsegment FROM customer WHERE coalesce(try_cast(try_cast(CAST(c_acctbal AS VARCHAR) AS DOUBLE) AS DOUBLE), 0) >= 5000.0 AND c_mktsegment <> 'BUILDING'")
def tuple_filter_cast(spark, d):
    return tables.scan_tuples(table(spark, d, "customer"), [("c_acctbal", ">=", 5000.0), ("c_mktsegment", "!=", "BUILDING")], ["c_custkey", "c_mktsegment"])


@QUERIES.add("SELECT max(ts) AS watermark FROM events")
def max_watermark(spark, d):
    return tables.max_watermark(table(spark, d, "events"), "ts")


@QUERIES.add(f"SELECT event_id, ts, event_type FROM events WHERE ts > {_TS}")
def read_after_watermark(spark, d):
    return tables.after_watermark(table(spark, d, "events"), "ts", _ts("2024-01-15")).select("event_id", "ts", "event_type")


@QUERIES.add(f"SELECT event_id, user_id, ts, event_type FROM events WHERE ts > {_TS} AND event_type IN ('purchase', 'signup') AND props IS NOT NULL AND props <> '' ORDER BY ts, event_id LIMIT 1000")
def read_status_subset(spark, d):
    return tables.by_status(table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "props"), "event_type", ["purchase", "signup"], "ts", _ts("2024-01-15"), ["ts", "event_id"], 1000, "props").drop("props")


@QUERIES.add(f"SELECT event_id, ts FROM events WHERE ts > {_TS} OR (ts = {_TS} AND event_id > 100) ORDER BY ts, event_id LIMIT 100")
def keyset_page(spark, d):
    return tables.keyset_page(table(spark, d, "events").select("event_id", "ts"), "ts", "event_id", _ts("2024-01-15"), F.lit(100), 100)


@QUERIES.add("SELECT event_id, ts FROM events, (SELECT median_ts, min(event_id) FILTER (ts = median_ts) AS k FROM events, (SELECT min(ts) AS median_ts FROM events WHERE ts >= TIMESTAMP '2024-01-10') GROUP BY 1) WHERE ts > median_ts OR (ts = median_ts AND event_id > k)")
def checkpoint_refilter(spark, d):
    events = table(spark, d, "events").select("event_id", "ts")
    mark = events.where(F.col("ts") >= _ts("2024-01-10")).agg(F.min(F.struct("ts", "event_id")).alias("mark"))
    return events.crossJoin(F.broadcast(mark)).where(F.struct("ts", "event_id") > F.col("mark")).drop("mark")  # one row


@QUERIES.add("SELECT event_id, event_type, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date FROM events")
def flatten_props(spark, d):
    return table(spark, d, "events").select("event_id", "event_type", text.try_int(text.json_field(F.col("props"), "k")).alias("k"), F.to_date("ts").cast("string").alias("event_date"))


@QUERIES.add("""SELECT event_id, json_extract_string(j, '$.a.b') AS nested, json_extract_string(j, '$.missing.x') AS missing
FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '{"a": {"b": "' || event_type || '"}}' ELSE '{"a": null}' END AS j FROM events)""")
def json_path_null_safety(spark, d):
    built = F.when(F.col("event_id") % 3 == 0, None).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"a": {"b": "'), "event_type", F.lit('"}}'))).otherwise('{"a": null}')
    rows = table(spark, d, "events").select("event_id", built.alias("j"))
    return rows.select("event_id", text.json_field(F.col("j"), "a", "b").alias("nested"), text.json_field(F.col("j"), "missing", "x").alias("missing"))


@QUERIES.add("""SELECT 'shop.orders.' || event_type AS type, event_type AS status_subtype, CAST(event_id % 3 AS VARCHAR) AS version,
    strftime(ts, '%Y-%m-%d') AS event_day, CAST(user_id AS VARCHAR) AS assignment_id, 'c' || event_id AS claim_number, event_type || '@x.org' AS contact_email_address,
    CASE event_id % 3 WHEN 0 THEN 'a.pdf,b.pdf' WHEN 1 THEN NULL ELSE '' END AS attachments, CAST(NULL AS VARCHAR) AS note
    FROM events""")
def flatten_events(spark, d):
    e = table(spark, d, "events")
    files = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("a.pdf"), F.lit("b.pdf"))).when(F.col("event_id") % 3 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("")))
    data = F.to_json(F.struct(F.col("user_id").cast("string").alias("assignmentId"), files.alias("attachments"), F.struct(F.struct(F.concat(F.lit("c"), "event_id").alias("claimNumber")).alias("coverageLoss")).alias("adm"), F.struct(F.struct(F.struct(F.concat("event_type", F.lit("@x.org")).alias("address")).alias("email")).alias("contactMethods")).alias("contact")))
    raw = e.select(F.concat(F.lit("shop.orders."), "event_type").alias("type"), (F.col("event_id") % 3).alias("version"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utcDateTime"), F.col("user_id").cast("string").alias("traceId"), data.alias("data"))
    flat = flatten.flatten_events(raw)
    return flat.select("type", "status_subtype", "version", F.date_format("event_date", "yyyy-MM-dd").alias("event_day"), "assignment_id", "claim_number", "contact_email_address", "attachments", "note")


@QUERIES.add("SELECT event_id, string_split(t, '.')[-1] AS status_subtype, string_split(event_type, '.')[-1] AS undotted FROM (SELECT *, 'shop.' || event_type || '.v' || (event_id % 4) AS t FROM events)")
def status_subtype(spark, d):
    e = table(spark, d, "events").withColumn("t", F.concat(F.lit("shop."), "event_type", F.lit(".v"), (F.col("event_id") % 4).cast("string")))
    return e.select("event_id", text.last_segment(F.col("t")).alias("status_subtype"), text.last_segment(F.col("event_type")).alias("undotted"))


@QUERIES.add("SELECT o_orderkey, try_cast(CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE CAST(o_orderkey AS VARCHAR) END AS INTEGER) AS number, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def typed_projection(spark, d):
    o = table(spark, d, "orders")
    mixed = F.when(F.col("o_orderkey") % 5 == 0, "x").otherwise(F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", text.try_int32(mixed).alias("number"), F.date_format("o_orderdate", "yyyy-MM-dd").try_cast("date").cast("string").alias("day"))


@QUERIES.add("SELECT event_id, event_type FROM events WHERE nullif(event_type, 'error') IS NOT NULL")
def null_key_drop(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return flatten.present(e, "event_id", "event_type")


@QUERIES.add("SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders")
def partition_columns(spark, d):
    return flatten.with_date_parts(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@QUERIES.add(f"SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < {_TS} GROUP BY event_type")
def date_bounds(spark, d):
    return tables.with_date_bounds(table(spark, d, "events"), "ts", _ts("2024-01-05"), _ts("2024-01-15")).groupBy("event_type").agg(F.count("*").alias("n"))


@QUERIES.add("""SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 'skipped' WHEN nullif(c_mktsegment, 'MACHINERY') IS NULL OR c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'FURNITURE') OR c_acctbal < 0 OR c_acctbal > 9000 THEN 'failed' ELSE 'ok' END AS validation_status,
CASE WHEN c_nationkey = 0 THEN NULL WHEN nullif(c_mktsegment, 'MACHINERY') IS NULL THEN 'Missing required field: segment' WHEN c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'FURNITURE') THEN 'Value not allowed: segment' WHEN c_acctbal < 0 THEN 'Below minimum: c_acctbal' WHEN c_acctbal > 9000 THEN 'Above maximum: c_acctbal' END AS validation_error FROM customer""")
def validation_rules(spark, d):
    c = table(spark, d, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    out = flatten.validated(c, required=["segment"], allowed={"segment": ["BUILDING", "AUTOMOBILE", "FURNITURE"]}, least={"c_acctbal": 0}, most={"c_acctbal": 9000}, skip_if=F.col("c_nationkey") == 0)
    return out.select("c_custkey", "validation_status", "validation_error")


@QUERIES.add("SELECT c_custkey AS id, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment, c_name AS name, 'EU' AS zone FROM customer")
def transform_defaults(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.struct(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.col("c_name").alias("name")).alias("info"))
    return flatten.mapped(c, {"id": "c_custkey", "segment": "info.segment", "name": "info.name"}, {"segment": "none", "zone": "EU"})
