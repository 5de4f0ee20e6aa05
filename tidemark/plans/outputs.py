"""Sinks, error kinds, generators, dead-letter offsets and action results over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import errors, text
from ..operators import entities, plugins, routing, sinks, tables, working
from ..sources import actions, generators, paged, writers
from .registry import Queries, new_table, table

QUERIES = Queries()


_NOW = "2026-02-01 00:00:00"


def _now():
    return F.lit(_NOW).cast("timestamp_ntz")


def _results(spark, d):
    k = F.col("event_id")
    status = F.when(k % 3 == 0, "completed").when(k % 3 == 1, "failed_permanent").otherwise("failed")
    return table(spark, d, "events").select(
        F.concat(F.lit("m"), k.cast("string")).alias("media_id"), F.concat(F.lit("t"), k.cast("string")).alias("trace_id"), F.lit("u").alias("attachment_url"), F.lit("b").alias("blob_path"), F.lit("pdf").alias("file_type"),
        F.col("event_type").alias("status_subtype"), F.col("user_id").cast("string").alias("assignment_id"), k.alias("bytes_downloaded"), F.col("ts").alias("created_at"), status.alias("status"),
        F.when(k % 2 == 0, "").alias("error_message"), (k % 5).cast("int").alias("retry_count"), F.lit(404).alias("http_status"),
    )


@QUERIES.add("SELECT 'm' || event_id AS media_id, event_type AS status_subtype, CAST(user_id AS VARCHAR) AS assignment_id, event_id AS bytes_downloaded, ts AS downloaded_at, '2026-02-01' AS event_date FROM events WHERE event_id % 3 = 0")
def inventory_sink(spark, d):
    t = new_table(spark)
    t.append(sinks.inventory_rows(_results(spark, d), _now()))
    return t.read().select("media_id", "status_subtype", "assignment_id", "bytes_downloaded", "downloaded_at", F.col("event_date").cast("string").alias("event_date"))


@QUERIES.add("SELECT 'm' || event_id AS media_id, 'Unknown error' AS error_message, 'failed_permanent' AS status, event_id % 5 + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS retry_count FROM events WHERE event_id % 3 = 1")
def failed_sink(spark, d):
    t, rows = new_table(spark, keys=["media_id"]), sinks.failed_rows(_results(spark, d), _now())
    t.merge(rows, ["failed_at"])
    t.merge(rows.where("media_id LIKE '%0' OR media_id LIKE '%2' OR media_id LIKE '%4' OR media_id LIKE '%6' OR media_id LIKE '%8'").withColumn("retry_count", F.col("retry_count") + 1), ["failed_at"])
    return t.read().select("media_id", "error_message", "status", "retry_count")


@QUERIES.add("SELECT 't' || event_id AS trace_id, CASE event_id % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'failed_permanent' ELSE 'failed' END AS status, 404 AS http_status, NULL AS expires_at FROM events")
def tracking_rows(spark, d):
    return sinks.tracking_rows(_results(spark, d)).select("trace_id", "status", "http_status", F.col("expires_at").cast("string").alias("expires_at"))


@QUERIES.add("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(coalesce(CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) END, DATE '2026-02-01') AS VARCHAR) AS event_date FROM events WHERE event_type <> 'error'")
def domain_event_sink(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").cast("string"), F.nullif("event_type", F.lit("error")).alias("event_type"), F.col("user_id").cast("string").alias("project_id"), F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("ingested_at"), F.lit("{}").alias("raw_data"))
    t = new_table(spark, partition_by=["event_date"])
    t.append(sinks.domain_event_rows(e, F.lit(_NOW).cast("timestamp")))
    return t.read().select("event_id", "event_type", F.col("event_date").cast("string").alias("event_date"))


@QUERIES.add("SELECT event_id, 'PROJECT' AS event_type, 0 AS retry_count, NULL AS media_id, event_type AS master_file_name FROM events")
def enrichment_tasks(spark, d):
    e = table(spark, d, "events").select("event_id", F.lit("PROJECT").alias("event_type"), F.col("user_id").alias("project_id"), F.col("event_type").alias("master_file_name"))
    return sinks.enrichment_tasks(e, _now()).select("event_id", "event_type", "retry_count", "media_id", "master_file_name")


@QUERIES.add("""SELECT 'projects' AS target, count(*) AS n, CAST(sum(s_acctbal * 0 + 2) AS BIGINT) AS total FROM supplier
UNION ALL SELECT 'contacts', 2 * count(*), CAST(2 * count(*) AS BIGINT) FROM supplier
UNION ALL SELECT 'task_templates', count(*), CAST(sum(CASE WHEN s_suppkey % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) FROM supplier""")
def entity_sinks(spark, d):
    """Two batches into three tables: merged, appended, and merged where the modified date differs."""
    targets = {name: sinks.entity_table(spark, working.new_path(spark, name), name) for name in ("projects", "contacts", "task_templates")}
    k = F.col("s_suppkey")
    for v in (1, 2):
        s = table(spark, d, "supplier").withColumn("v", F.lit(v))
        modified = F.when(k % 2 == 0, F.lit(f"2026-01-0{v}")).otherwise("2026-01-01")
        rows = {
            "projects": s.select(k.cast("string").alias("project_id"), "v"),
            "contacts": s.select(k.cast("string").alias("project_id"), F.lit("a@x.org").alias("contact_email"), F.lit("REP").alias("contact_type"), F.lit(1).alias("v")),
            "task_templates": s.select(k.alias("task_id"), modified.alias("modified_date"), "v"),
        }
        sinks.write_all(targets, rows, _now())
    parts = [t.read().agg(F.count("*").alias("n"), F.sum("v").alias("total")).select(F.lit(name).alias("target"), "n", "total") for name, t in targets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@QUERIES.add("SELECT event_id AS id, event_type AS kind, 'none' AS note, CASE WHEN event_id % 2 = 0 THEN user_id END AS owner FROM events")
def plugin_sink(spark, d):
    """Two batches through a column mapping; the second has a further column, and a repeated batch adds nothing."""
    t, e = new_table(spark, partition_by=["kind"]), table(spark, d, "events").select("event_id", "event_type", "user_id")
    first, second = e.where("event_id % 2 = 1"), e.where("event_id % 2 = 0")
    plain = sinks.mapped_writer(t, {"id": "event_id", "kind": "event_type"}, {"note": "none"})
    plain(first, 0)
    plain(first, 0)
    sinks.mapped_writer(t, {"id": "event_id", "kind": "event_type", "owner": "user_id"}, {"note": "none"})(second, 1)
    return t.read().select("id", "kind", "note", "owner")


@QUERIES.add("SELECT 'events.' || event_type AS topic, CAST(user_id AS VARCHAR) AS key, '{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\"}' AS value, 'e' || event_id AS header FROM events WHERE event_type <> 'view'")
def message_sink(spark, d):
    e = table(spark, d, "events")
    topic = F.when(F.col("event_type") != "view", F.concat(F.lit("events."), "event_type"))
    messages = writers.as_messages(e, topic, F.col("user_id"), ["event_id", "event_type"], {"event": F.concat(F.lit("e"), "event_id"), "none": F.lit(None)})
    t = new_table(spark)
    writers.send(messages, {"kind": "table", "table": t, "token": "one"})
    writers.send(messages, {"kind": "table", "table": t, "token": "one"})
    return t.read().select("topic", "key", "value", F.col("headers")[0]["value"].cast("string").alias("header"))


@QUERIES.add("SELECT event_id, event_type FROM events WHERE event_id % 10 = 0")
def payload_files(spark, d):
    path = working.new_path(spark, "payloads")
    writers.payload_files(table(spark, d, "events").where("event_id % 10 = 0"), path, ["event_id", "event_type"])
    return spark.read.schema("event_id long, event_type string").json(path)


_NAMES = ("KafkaTimeoutError", "SaslAuthenticationError", "InvalidTopicError", "ProducerFencedException", "Odd")
_MESSAGES = ("Connection lost", "request TIMEOUT", "topic does not exist", "authorization failed", "invalid", "leader moved", "")
_BY_NAME = "CASE event_id % 5 WHEN 0 THEN 'timeout' WHEN 1 THEN 'auth' WHEN 2 THEN 'permanent' WHEN 3 THEN 'throttling' ELSE NULL END"


@QUERIES.add(f"""SELECT event_id, coalesce({_BY_NAME}, ['connection', 'timeout', 'kafka', 'auth', 'kafka', 'kafka', 'kafka'][event_id % 7 + 1]) AS consumer,
coalesce(CASE WHEN event_id % 5 = 2 AND event_id % 7 = 4 THEN 'validation' END, {_BY_NAME}, ['connection', 'timeout', 'kafka', 'auth', 'kafka', 'connection', 'kafka'][event_id % 7 + 1]) AS producer FROM events""")
def broker_errors(spark, d):
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("event_id") % len(values) + 1).cast("int"))
    e = table(spark, d, "events").select("event_id", pick(_NAMES).alias("name"), pick(_MESSAGES).alias("message"))
    return e.select("event_id", *[errors.of_broker(F.col("name"), F.col("message"), side).alias(side) for side in ("consumer", "producer")])


_STORE_MESSAGES = ("no access rights", "Too Many Requests", "read timeout", "service unavailable", "syntax error", "dns failure", "blob not found", "403")


@QUERIES.add("""SELECT event_id, ['auth', 'throttling', 'timeout', 'transient', 'query', 'kusto', 'kusto', 'kusto'][event_id % 8 + 1] AS kusto,
['delta', 'delta', 'timeout', 'delta', 'delta', 'connection', 'delta', 'delta'][event_id % 8 + 1] AS delta,
['onelake', 'onelake', 'timeout', 'transient', 'onelake', 'connection', 'permanent', 'permanent'][event_id % 8 + 1] AS onelake FROM events""")
def store_errors(spark, d):
    message = F.element_at(F.array(*[F.lit(m) for m in _STORE_MESSAGES]), (F.col("event_id") % 8 + 1).cast("int"))
    e = table(spark, d, "events").select("event_id", message.alias("m"))
    return e.select("event_id", errors.of_store("kusto", F.col("m"), F.lit("KustoServiceError")).alias("kusto"), errors.of_store("delta", F.col("m")).alias("delta"), errors.of_store("onelake", F.col("m")).alias("onelake"))


@QUERIES.add("SELECT event_id, event_id IS NULL OR event_id * 10000 > 52428800 AS streamed, (event_id % 1000) * 1000 AS waited_ms, '2026-02-01' AS today FROM events")
def size_and_time(spark, d):
    e = table(spark, d, "events").withColumn("since", F.col("ts").cast("timestamp"))
    until = F.timestamp_add("SECOND", (F.col("event_id") % 1000).cast("int"), F.col("since"))
    today = errors.as_of(_now())[1].cast("string")
    return e.select("event_id", errors.should_stream(F.col("event_id") * 10000).alias("streamed"), errors.elapsed_ms(F.col("since"), until).alias("waited_ms"), today.alias("today"))


@QUERIES.add("""SELECT event_id, CASE WHEN c = 'permanent' THEN 'dlq' WHEN r >= 2 THEN 'dlq' WHEN needs AND fresh IS NULL THEN 'dlq' ELSE 'files.retry.' || [5, 10][r + 1] || 'm' END AS route,
CASE WHEN c = 'permanent' THEN 'permanent' WHEN r >= 2 THEN 'exhausted' WHEN needs AND fresh IS NULL THEN 'no new link' ELSE 'retry' END AS reason, CASE WHEN needs AND fresh IS NOT NULL THEN fresh ELSE 'old' END AS download_url, needs AS url_refresh_attempted
FROM (SELECT event_id, c, r, c IN ('transient', 'unknown') AND r < 2 AND event_id % 3 = 0 AS needs, CASE WHEN event_id % 6 = 0 THEN 'new' || event_id END AS fresh FROM
(SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'transient' WHEN 1 THEN 'permanent' WHEN 2 THEN 'auth' ELSE 'unknown' END c, event_id % 5 % 3 r FROM events))""")
def download_router(spark, d):
    k = F.col("event_id")
    e = table(spark, d, "events").select("event_id", "ts", F.lit("old").alias("download_url"), F.when(k % 3 == 0, "HTTP 403 Forbidden").otherwise("reset").alias("error"), F.when(k % 4 == 0, "transient").when(k % 4 == 1, "permanent").when(k % 4 == 2, "auth").otherwise("unknown").alias("category"), (k % 5 % 3).alias("retries"))
    links = e.where("event_id % 6 = 0").select("event_id", F.concat(F.lit("new"), k.cast("string")).alias("download_url"))
    out = routing.download_route(e, links, "event_id", F.col("error"), F.col("category"), F.col("retries"), [300, 600], "files", "dlq", F.col("ts"))
    return out.select("event_id", "route", "reason", "download_url", "url_refresh_attempted")


@QUERIES.add("""SELECT CASE WHEN bad THEN 'out.error' ELSE 'out.success' END AS topic, CASE WHEN bad THEN '{"original_message":"{\\"event_id\\":' || event_id || ',\\"event_type\\":\\"' || event_type || '\\"}","error":"' ||
CASE WHEN event_type = 'error' THEN 'stopped at kind' ELSE 'API error 500: no' END || '","worker_name":"w"}' ELSE '{"enriched_data":{"event_id":' || event_id || ',"event_type":"' || event_type || '","size":' || (event_id * 2) || '},"response":"no","status_code":200,"worker_name":"w"}' END AS value
FROM (SELECT *, event_type = 'error' OR event_id % 4 = 0 AS bad FROM events)""")
def action_worker(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type")
    steps = [("kind", F.col("event_type") != "error", lambda x: x), ("size", F.lit(True), lambda x: x.withColumn("size", F.col("event_id") * 2))]
    return plugins.action_results(e, steps, F.when(F.col("event_id") % 4 == 0, 500).otherwise(200), F.lit("no"), "w", "out.success", "out.error")


_LETTERS = "(SELECT 't' AS topic, user_id % 4 AS p, event_id AS o, event_type FROM events)"


@QUERIES.add(f"SELECT l.p AS partition, count(*) AS pending FROM {_LETTERS} l LEFT JOIN (SELECT p, max(o) + 1 AS n FROM {_LETTERS} WHERE event_type = 'error' AND p < 3 GROUP BY p) c ON c.p = l.p WHERE n IS NULL OR o >= n GROUP BY 1")
def dlq_acknowledge(spark, d):
    letters = table(spark, d, "events").select(F.lit("t").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), "event_type")
    offsets = sinks.committed(letters, (F.col("event_type") == "error") & (F.col("partition") < 3))
    return sinks.pending(letters, offsets).groupBy("partition").agg(F.count("*").alias("pending"))


@QUERIES.add("SELECT 0 AS pending, count(*) AS purged FROM events")
def dlq_purge(spark, d):
    letters = table(spark, d, "events").select(F.lit("t").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"))
    left = sinks.pending(letters, sinks.committed(letters))
    return letters.agg(F.count("*").alias("purged")).join(left.agg(F.count("*").alias("pending"))).select("pending", "purged")


@QUERIES.add("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'replayed' WHEN event_id % 3 = 1 THEN 'dropped' ELSE 'open' END AS resolution FROM events")
def dlq_resolve(spark, d):
    e = table(spark, d, "events")
    status = e.where("event_id % 3 = 0").select("event_id", F.lit("dropped").alias("resolution"), F.lit(1).alias("at"))
    status = status.union(status.select("event_id", F.lit("replayed"), F.lit(2))).union(e.where("event_id % 3 = 1").select("event_id", F.lit("dropped"), F.lit(1)))
    return sinks.resolved(e.select("event_id"), status, ["event_id"])


@QUERIES.add("""SELECT 1 AS version, 'append' AS operation, (SELECT count(*) FROM events) AS rows_affected, '' AS schema_changes UNION ALL SELECT 2, 'append', (SELECT count(*) FROM events WHERE event_type = 'click'), '+value' UNION ALL SELECT 3, 'append', (SELECT count(*) FROM events WHERE event_type = 'view'), ''
UNION ALL SELECT 4, 'merge', (SELECT count(*) + count(*) FILTER (event_type = 'click') + count(*) FILTER (event_type = 'view') + CASE WHEN count(*) > count(event_id) THEN 1 ELSE 0 END FROM events), ''""")
def write_history(spark, d):
    """Each write with its rows, counted by the write itself, and the columns that it added.

    Three appends, and a merge of all events that meets, and so writes, every row of the table; a null
    key matches none, so it adds one.
    """
    t, e = new_table(spark, keys=["event_id"]), table(spark, d, "events")
    t.append(e.select("event_id", "event_type"))
    t.append(e.where("event_type = 'click'").select("event_id", "event_type", "value"))
    t.append(e.where("event_type = 'view'").select("event_id"))
    t.merge(e.select("event_id", "event_type"), ["event_id"])
    return tables.write_history(t).withColumn("schema_changes", F.array_join("schema_changes", ","))


@QUERIES.add("SELECT 'events' AS \"table\", 2 AS versions, (SELECT count(*) + count(*) FILTER (event_id % 2 = 0) FROM events) AS rows, 4 AS columns UNION ALL SELECT 'orders', 1, (SELECT count(*) FROM orders), 2")
def table_statistics(spark, d):
    named = {"events": new_table(spark), "orders": new_table(spark)}
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    named["events"].append(e)
    named["events"].append(e.where("event_id % 2 = 0").withColumn("extra", F.lit(1)))
    named["orders"].append(table(spark, d, "orders").select("o_orderkey", "o_totalprice"))
    return tables.table_statistics(named)


@QUERIES.add("SELECT count(*) AS written, count(*) FILTER (event_type = 'error') AS failed, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events")
def observed_counts(spark, d):
    """Counters that ride on a write: no second pass over the rows."""
    e, path = table(spark, d, "events").select("event_id", "event_type"), working.new_path(spark, "counted")
    counts = sinks.counted(e, lambda rows: rows.write.parquet(path), written=F.count(F.lit(1)), failed=F.count_if(F.col("event_type") == "error"), id_sum=F.sum("event_id"))
    return spark.createDataFrame([counts], "written long, failed long, id_sum long")


@QUERIES.add("SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) r FROM events) WHERE r > 50")
def cache_eviction(spark, d):
    return sinks.evicted(table(spark, d, "events").select("event_id", "ts"), "ts", "event_id", 500).select("event_id")


@QUERIES.add("SELECT event_id, event_type, upper(event_type) AS kind, event_id * 2 AS twice FROM events")
def columns_beside(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type")
    return sinks.beside(e, {"kind": F.upper("event_type"), "twice": F.col("event_id") * 2})


@QUERIES.add("SELECT conv_id, array_to_string(list(role ORDER BY role), ',') AS roles, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS n_words FROM conversations GROUP BY 1")
def bundle_lists(spark, d):
    c = table(spark, d, "conversations").select("conv_id", F.array("role").alias("roles"), F.split("text", " ").alias("words"))
    out = entities.bundles(c, "conv_id", ["roles", "words"])
    return out.select("conv_id", F.array_join(F.array_sort("roles"), ",").alias("roles"), F.size("words").cast("long").alias("n_words"))


def _draw(tag: str, n, *parts: str) -> str:
    return f"(CAST('0x' || left(md5(concat_ws('|', '7', '{tag}', {', '.join(parts)})), 8) AS BIGINT) % ({n}))"


def _pick(values, tag: str, *parts: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][{_draw(tag, len(values), *parts)} + 1]"


def _weighted(weights, tag: str, *parts: str) -> str:
    out, low = "CASE", 0
    for name, weight in weights.items():
        low += weight
        out += f" WHEN {_draw(tag, sum(weights.values()), *parts)} < {low} THEN '{name}'"
    return out + " END"


_DAMAGE = _pick(generators.DAMAGE, "damage", "id")
_LOW, _HIGH = (f"(CASE {_DAMAGE} " + " ".join(f"WHEN '{k}' THEN {v[i]}" for k, v in generators.LOSSES.items() if k) + f" ELSE {generators.LOSSES[''][i]} END)" for i in (0, 1))


@QUERIES.add(f"""SELECT 'CLM-' || upper(left(md5('7|claim|' || id), 8)) AS claim_id, {_pick(generators.FIRST, 'first', 'id')} || ' ' || {_pick(generators.LAST, 'last', 'id')} AS policyholder, {_DAMAGE} AS damage,
{_LOW} + {_draw('loss', f'{_HIGH} - {_LOW}', 'id')} AS loss, CAST(DATE '2026-01-31' - CAST({_draw('lost', 30, 'id')} + 1 AS INTEGER) AS VARCHAR) AS lost_on FROM (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer)""")
def generated_claims(spark, d):
    return generators.claims(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), 7).select("claim_id", "policyholder", "damage", F.col("loss").cast("long").alias("loss"), F.col("lost_on").cast("string").alias("lost_on"))


_FILE = {c: v[0] for c, v in generators.FILES.items()}


@QUERIES.add(f"""SELECT 'media_' || left(md5('7|media|' || id || '|' || i), 12) AS media_id, category, category || '_' || i || CASE category WHEN 'photo' THEN '.jpg' ELSE '.pdf' END AS file_name FROM
(SELECT id, i, {_weighted(_FILE, 'category', 'id', 'i')} AS category FROM (SELECT id, CAST(unnest(range(1, {_draw('files', 5, 'id')} + 2)) AS VARCHAR) AS i FROM (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer)))""")
def generated_attachments(spark, d):
    return generators.attachments(generators.claims(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), 7), 7).select("media_id", "category", "file_name")


@QUERIES.add(f"""SELECT left(md5('7|event|' || id), 24) AS event_id, {_weighted(generators.EVENTS, 'type', 'id')} AS event_type, 'proj_' || left(md5('7|project|' || {_draw('of', 20, 'id')}), 12) AS project_id,
CAST(TIMESTAMP '2026-01-01 00:00:00' + INTERVAL 1 SECOND * (CASE WHEN n % 100 >= 90 THEN n - n % 100 + 90 ELSE n END // 2) AS VARCHAR) AS ingested_at FROM (SELECT o_orderkey AS n, CAST(o_orderkey AS VARCHAR) AS id FROM orders)""")
def synthetic_events(spark, d):
    e = generators.events(table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), 7, 20, per_second=2, burst_every=100, burst=10)
    return e.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))


@QUERIES.add("""SELECT e.event_id, CASE WHEN r.ts IS NULL THEN 'missing' WHEN e.ts - r.ts < INTERVAL 6 HOUR THEN 'hit' ELSE 'expired' END AS lookup,
CASE WHEN e.ts - r.ts < INTERVAL 6 HOUR THEN r.value END AS answer FROM events e ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') r ON r.user_id = e.user_id AND r.ts <= e.ts""")
def ttl_lookup(spark, d):
    """Each event with its user's newest purchase, which holds for six hours."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    answers = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("fetched"), F.col("value").alias("answer"))
    out = plugins.with_lookup(e.select("event_id", "user_id", "ts"), answers, ["user_id"], "ts", "fetched", ["answer"], 6 * 3600)
    return out.select("event_id", "lookup", F.col("lookup_result.answer").alias("answer"))


@QUERIES.add("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 1 END AS first, CASE WHEN event_id % 5 = 0 THEN event_type END AS kind, CASE WHEN event_id % 5 = 3 THEN event_id END AS n,
CASE event_id % 5 WHEN 0 THEN '{"a":{"b":[1,{"c":"' || event_type || '"}]}}' WHEN 3 THEN '{"a":"x","n":' || event_id || '}' WHEN 4 THEN '[1,2]' ELSE '{}' END AS object FROM events""")
def variant_paths(spark, d):
    """Nested, broken, repeated, misfit and list JSON, parsed once a row, at paths that are given as text."""
    k = F.col("event_id") % 5
    nested = F.concat(F.lit('{"a":{"b":[1,{"c":"'), "event_type", F.lit('"}]}}'))
    data = F.when(k == 0, nested).when(k == 1, "{broken").when(k == 2, '{"a":1,"a":2}').when(k == 3, F.concat(F.lit('{"n":'), F.col("event_id").cast("string"), F.lit(',"a":"x"}'))).otherwise("[1,2]")
    e = table(spark, d, "events").select("event_id", text.json_object(data).alias("v"))
    paths = {"first": ("a.b[0]", "int"), "kind": ("$.a.b[1].c", "string"), "n": ("n", "bigint")}
    return e.select("event_id", *text.at_paths(F.col("v"), paths), F.to_json("v").alias("object"))


@QUERIES.add("SELECT event_id, event_type FROM events")
def paged_events(spark, d):
    """The events through a service that answers in pages, read by ranges of time in parallel.

    The service's key is the event's id and a number of its row, so that repeated rows have places of
    their own; events without a time come first.
    """
    folder, name, parts = working.new_path(spark, "service"), f"service_{uuid.uuid4().hex}", max(8, spark.sparkContext.defaultParallelism)
    at = F.coalesce(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit("0001-01-01T00:00:00.000000Z"))
    key = F.concat_ws("-", F.col("event_id").cast("string"), F.monotonically_increasing_id().cast("string"))
    rows = table(spark, d, "events").select(at.alias("at"), key.alias("id"), "event_id", "event_type")
    rows.repartitionByRange(parts, "at", "id").sortWithinPartitions("at", "id").write.json(folder)
    fields = ("at", "id", "event_id", "event_type")
    paged.register(spark, name, lambda: paged.FileService(folder, fields, "at", "id"), "at string, id string, event_id long, event_type string", "at", "id")
    return spark.read.format(name).options(page_size=500, parts=parts).load().select("event_id", "event_type")


@QUERIES.add("SELECT CASE event_type WHEN 'error' THEN 'webhook' WHEN 'view' THEN 'log' ELSE 'publish' END AS kind, event_type AS target, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1, 2")
def action_sink(spark, d):
    """The actions that events ask for, written twice under one batch name and done once."""
    kind = F.when(F.col("event_type") == "error", "webhook").when(F.col("event_type") == "view", "log").otherwise("publish")
    rows, folder = table(spark, d, "events").select(kind.alias("kind"), F.col("event_type").alias("target"), F.col("event_id").cast("string").alias("payload")), working.new_path(spark, "actions")
    for _ in range(2):
        actions.write(rows, folder, "one")
    return actions.done(spark, folder).groupBy("kind", "target").agg(F.count("*").alias("n"), F.sum(F.col("payload").cast("long")).alias("id_sum"))
