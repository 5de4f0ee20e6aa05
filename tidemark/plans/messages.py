"""Routing, retries, dead letters, batching and plugins over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import plugins, routing
from ..sources import readers
from ..streaming import pipelines
from .registry import Queries, table

QUERIES = Queries()
_CATEGORY = "CASE event_id % 4 WHEN 0 THEN 'permanent' WHEN 1 THEN 'transient' WHEN 2 THEN 'auth' ELSE 'unknown' END"


def _tasks(spark, d):
    k = F.col("event_id")
    category = F.when(k % 4 == 0, "permanent").when(k % 4 == 1, "transient").when(k % 4 == 2, "auth").otherwise("unknown")
    return table(spark, d, "events").select("event_id", "ts", category.alias("category"), (k % 6).alias("retries"))


@QUERIES.add(f"""SELECT event_id, CASE WHEN c = 'permanent' OR r >= 4 THEN 'tasks.dlq' ELSE 'tasks.retry.' || [5, 10, 20, 40][r + 1] || 'm' END AS route, CASE WHEN c = 'permanent' THEN 'permanent' WHEN r >= 4 THEN 'exhausted' ELSE 'retry' END AS reason,
CASE WHEN c = 'permanent' OR r >= 4 THEN r ELSE r + 1 END AS next_retry_count, CASE WHEN c = 'permanent' OR r >= 4 THEN NULL ELSE ts + INTERVAL 1 SECOND * [300, 600, 1200, 2400][r + 1] END AS retry_at FROM (SELECT event_id, ts, {_CATEGORY} c, event_id % 6 r FROM events)""")
def retry_route(spark, d):
    out = routing.retry_route(_tasks(spark, d), F.col("category"), F.col("retries"), [300, 600, 1200, 2400], "tasks", "tasks.dlq", F.col("ts"))
    return out.select("event_id", "route", "reason", "next_retry_count", "retry_at")


@QUERIES.add("SELECT event_id, ts FROM events WHERE ts + INTERVAL 600 SECOND <= TIMESTAMP '2024-01-12 00:00:00'")
def retry_due(spark, d):
    held = table(spark, d, "events").select("event_id", "ts").withColumn("retry_at", F.timestamp_add("SECOND", F.lit(600), F.col("ts")))
    return routing.due(held, "retry_at", F.lit("2024-01-12").cast("timestamp_ntz")).drop("retry_at")


@QUERIES.add("SELECT event_id, CASE event_type WHEN 'purchase' THEN 'inventory' WHEN 'error' THEN 'failed' ELSE 'skip' END AS route, CASE WHEN event_id % 5 >= 3 THEN 'dlq' ELSE 'retry' END AS batch_route FROM events")
def status_router(spark, d):
    status = F.when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed_permanent").otherwise("failed")
    rows = table(spark, d, "events").select("event_id", routing.result_route(status).alias("status_route"))
    out = routing.batch_route(rows, F.col("event_id") % 5, 3)
    return out.select("event_id", F.col("status_route").alias("route"), F.col("route").alias("batch_route"))


@QUERIES.add("SELECT event_id, 0 AS retry_count, 'p' || (event_id % 3) AS origin, 'true' AS replayed, CAST(event_id * 2 AS VARCHAR) AS dlq_offset FROM events WHERE event_type = 'error'")
def dlq_replay(spark, d):
    task = F.struct("event_id", F.lit(5).alias("retry_count"), F.create_map(F.lit("origin"), F.concat(F.lit("p"), (F.col("event_id") % 3).cast("string"))).alias("metadata"))
    letters = table(spark, d, "events").where("event_type = 'error'").select(task.alias("original_task"), (F.col("event_id") * 2).alias("offset"), (F.col("event_id") % 4).alias("partition"))
    m = F.col("metadata")
    return routing.replayed(letters).select("event_id", "retry_count", m["origin"].alias("origin"), m["replayed_from_dlq"].alias("replayed"), m["dlq_offset"].alias("dlq_offset"))


@QUERIES.add("SELECT CAST(sum(n) AS BIGINT) AS dlq_depth FROM (SELECT max(event_id) + 1 - min(event_id) n FROM events GROUP BY user_id % 8)")
def dlq_depth(spark, d):
    return routing.depth(table(spark, d, "events").select((F.col("user_id") % 8).alias("p"), "event_id"), "p", "event_id")


@QUERIES.add("SELECT event_id, event_type, CAST(ceil(row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) / 100.0) AS BIGINT) AS batch FROM events")
def batch_assignment(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "ts", F.to_date("ts").alias("day"))
    return routing.batches(e, 100, ["ts", "event_id"], ["event_type", "day"]).select("event_id", "event_type", "batch")


@QUERIES.add("""WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) r FROM events),
k AS (SELECT user_id, event_id, ts, r, ts AS kept, TRUE AS keep FROM o WHERE r = 1 UNION ALL SELECT o.user_id, o.event_id, o.ts, o.r, CASE WHEN o.ts - k.kept >= INTERVAL 24 HOUR THEN o.ts ELSE k.kept END, o.ts - k.kept >= INTERVAL 24 HOUR FROM k JOIN o ON o.user_id = k.user_id AND o.r = k.r + 1)
SELECT user_id, event_id, ts FROM k WHERE keep""")
def dedupe_24h(spark, d):
    return routing.deduplicated_within(table(spark, d, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts", ["event_id"], 86400)


@QUERIES.add("SELECT user_id, batch, event_count, least(event_count, 3) AS n_samples FROM (SELECT user_id, CAST(ceil(r / 20.0) AS BIGINT) AS batch, count(*) AS event_count FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) r FROM events) GROUP BY 1, 2)")
def dlq_samples(spark, d):
    batched = routing.batches(table(spark, d, "events").select("user_id", "event_id"), 20, ["event_id"], ["user_id"])
    per = batched.groupBy("user_id", "batch").agg(F.collect_list("event_id").alias("events"))  # 20 at most
    return routing.sampled_letters(per, "events").select("user_id", "batch", "event_count", F.size("sample_events").alias("n_samples"))


@QUERIES.add("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'invalid JSON' END AS parse_error, CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind FROM events")
def dlq_inspect(spark, d):
    v = F.when(F.col("event_id") % 3 == 0, "{broken").otherwise(F.to_json(F.struct(F.col("event_type").alias("kind"))))
    out = readers.json_messages(table(spark, d, "events").select("event_id", v.alias("value")), "kind string")
    return out.select("event_id", "parse_error", "m.kind")


@QUERIES.add("SELECT event_id, CASE WHEN value < 20 THEN 'stopped' WHEN event_type = 'error' THEN 'stopped' ELSE 'ok' END AS chain_status, CASE WHEN value < 20 THEN 'value' WHEN event_type = 'error' THEN 'kind' END AS chain_step FROM events")
def handler_chain(spark, d):
    e = table(spark, d, "events").select("event_id", "value", "event_type")
    return plugins.chained(e, [("value", F.col("value") >= 20, lambda x: x), ("kind", F.col("event_type") != "error", lambda x: x)]).select("event_id", "chain_status", "chain_step")


@QUERIES.add("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'missing:segment' ELSE '' END AS issues FROM customer")
def quality_issues(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_name")
    return plugins.issues(c, ["segment"], 2).select("c_custkey", F.array_join("issues", ",").alias("issues"))


@QUERIES.add("SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('purchase', 'signup') GROUP BY 1")
def unhandled_types(spark, d):
    handler = lambda df: {"rows": df}
    return plugins.unhandled(table(spark, d, "events"), "event_type", {"purchase": handler, "signup": handler})


@QUERIES.add("SELECT event_id, 'big' AS plugin FROM events WHERE value > 90 UNION ALL SELECT event_id, 'buy' FROM events WHERE event_type = 'purchase'")
def plugin_actions(spark, d):
    registry = plugins.Registry()
    registry.add(plugins.Plugin("buy", lambda df: df.select("event_id"), 50, event_types=("purchase",)))
    registry.add(plugins.Plugin("big", lambda df: df.where("value > 90").select("event_id"), 10, domains=("shop",)))
    return registry.run(table(spark, d, "events").withColumns({"domain": F.lit("shop"), "stage": F.lit("done")}))


@QUERIES.add("SELECT event_id, kept.m AS media FROM (SELECT event_id, unnest([{m: 'a' || event_id}, {m: ''}, {m: 'b'}]) kept FROM events) WHERE kept.m <> ''")
def download_tasks(spark, d):
    files = F.to_json(F.struct(F.array(F.concat(F.lit("a"), F.col("event_id").cast("string")), F.lit(""), F.lit("b")).alias("attachments")))
    e = table(spark, d, "events").select("event_id", text.kept_items(text.json_list(files, "attachments")).alias("files"))
    return e.select("event_id", F.explode("files").alias("media"))


@QUERIES.add("""WITH RECURSIVE o AS (SELECT event_type, ts, value > 30 AS ok, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) r FROM events),
k AS (SELECT DISTINCT event_type, CAST(0 AS BIGINT) AS r, CAST(NULL AS TIMESTAMP) AS ts, TRUE AS allowed, 'closed' AS state, 0 AS failed, 0 AS passed, CAST(NULL AS TIMESTAMP) AS opened FROM events
UNION ALL SELECT event_type, r, ts, s <> 'open', CASE WHEN s = 'open' THEN s WHEN ok THEN CASE WHEN s = 'half_open' AND p + 1 >= 2 THEN 'closed' ELSE s END WHEN s = 'half_open' OR f + 1 >= 5 THEN 'open' ELSE s END,
CASE WHEN s = 'open' THEN f WHEN ok OR s = 'half_open' OR f + 1 >= 5 THEN 0 ELSE f + 1 END, CASE WHEN s <> 'open' AND ok THEN p + 1 ELSE p END, CASE WHEN s <> 'open' AND NOT ok AND (s = 'half_open' OR f + 1 >= 5) THEN ts ELSE opened END
FROM (SELECT o.*, k.failed f, k.opened, CASE WHEN k.state = 'open' AND o.ts - k.opened >= INTERVAL 60 SECOND THEN 'half_open' ELSE k.state END s, CASE WHEN k.state = 'open' AND o.ts - k.opened >= INTERVAL 60 SECOND THEN 0 ELSE k.passed END p FROM k JOIN o ON o.event_type = k.event_type AND o.r = k.r + 1))
SELECT event_type, ts, allowed, state FROM k WHERE r > 0""")
def circuit_breaker(spark, d):
    calls = table(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), (F.col("value") > 30).alias("ok"))
    return pipelines.breaker_states(calls, "event_type", "ts", "ok", order=["event_id"]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
