"""Further operators over the tables: entity overlays, stamps, samples, set differences, versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import errors, text, urls
from ..operators import analytics, entities, flatten
from .registry import Queries, new_table, table

QUERIES = Queries()


@QUERIES.add("SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN 'M' || s_suppkey END, s_name) AS s_name FROM supplier")
def column_overlay(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    other = s.where("s_suppkey % 3 = 0").select("s_suppkey", F.concat(F.lit("M"), F.col("s_suppkey").cast("string")).alias("s_name"))
    return entities.overlaid(s, other, ["s_suppkey"], "s_name")


@QUERIES.add("SELECT event_id, CASE WHEN event_type = 'signup' THEN ts END AS invited_at, CASE WHEN event_type = 'purchase' THEN ts END AS joined_at FROM events")
def event_stamps(spark, d):
    return entities.stamped(table(spark, d, "events"), "event_type", "ts", {"signup": "invited_at", "purchase": "joined_at"}).select("event_id", "invited_at", "joined_at")


@QUERIES.add("SELECT CAST(user_id AS VARCHAR) AS project_id, TRUE AS auto_link_failed, event_id FROM events WHERE event_type = 'error'")
def link_failures(spark, d):
    return entities.link_failures(table(spark, d, "events").withColumn("p", F.col("user_id").cast("string")), "event_type", "error", "p")


@QUERIES.add("SELECT CAST(page_id AS VARCHAR) AS media_id, url || '/f.PDF' AS url, 'p' || (page_id % 5) || '/media/' || CASE WHEN page_id % 2 = 0 THEN 'given.png' ELSE 'f.pdf' END AS blob_path, 0 AS retry_count FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages) WHERE page_id % 3 <> 0")
def media_downloads(spark, d):
    k = F.col("page_id")
    media = table(spark, d, "pages").select(k.cast("string").alias("media_id"), F.concat(F.lit("p"), (k % 5).cast("string")).alias("project_id"), F.when(k % 2 == 0, "given.png").alias("file_name"), F.when(k % 3 != 0, F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/f.PDF"))).otherwise("").alias("full_download_link"))
    return entities.download_tasks(media)


@QUERIES.add("SELECT event_type, count(*) AS calls, count(*) FILTER (user_id % 4 = 0) AS retried, count(*) FILTER (user_id % 4 = 0) / count(*) AS retry_ratio FROM events GROUP BY 1")
def retry_budget(spark, d):
    return analytics.retry_ratio(table(spark, d, "events"), ["event_type"], F.col("user_id") % 4 == 0)


@QUERIES.add("SELECT event_type, array_to_string(list(event_id ORDER BY event_id), ',') AS samples FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) r FROM events) WHERE r <= 10 GROUP BY 1")
def sample_ids(spark, d):
    return analytics.first_samples(table(spark, d, "events"), "event_type", "event_id", 10).select("event_type", F.array_join("samples", ",").alias("samples"))


@QUERIES.add("SELECT event_id, 1706745600 - event_id * 1000 / 1000 AS age_seconds FROM events")
def message_age(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("event_id") * 1000).alias("ms"))
    return analytics.age_seconds(e, "ms", F.lit(1706745600)).drop("ms")


@QUERIES.add("SELECT DISTINCT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000")
def set_difference(spark, d):
    return table(spark, d, "customer").select("c_custkey").distinct().exceptAll(table(spark, d, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey")).distinct())


@QUERIES.add("SELECT DISTINCT event_type FROM events")
def unique_values(spark, d):
    return table(spark, d, "events").select("event_type").distinct()


@QUERIES.add("SELECT conv_id, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles FROM conversations GROUP BY 1")
def distinct_lists(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))


@QUERIES.add("SELECT event_id, event_type || '-0' AS first_item, NULL AS absent FROM events")
def path_accessor(spark, d):
    j = F.to_json(F.struct(F.struct(F.array(F.struct(F.concat("event_type", F.lit("-0")).alias("id"))).alias("tasks")).alias("data")))
    e = table(spark, d, "events").select("event_id", j.alias("j"))
    return e.select("event_id", F.get_json_object("j", "$.data.tasks[0].id").alias("first_item"), F.get_json_object("j", "$.data.tasks[3].id").alias("absent"))


@QUERIES.add("SELECT event_id, CAST(ts AS VARCHAR) AS ingested_at, event_type, 'none' AS note FROM events WHERE event_type <> 'error'")
def typed_messages(spark, d):
    message = F.to_json(F.struct(F.col("event_id").alias("eventId"), F.col("ts").cast("string").alias("at"), F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("").alias("kind")))
    parsed = table(spark, d, "events").select(F.from_json(message, "eventId long, at timestamp_ntz, kind string").alias("m"))
    rows = parsed.select(F.col("m.eventId").alias("event_id"), F.col("m.at").alias("ingested_at"), text.first_clean(F.col("m.kind")).alias("event_type"))
    out = flatten.mapped(flatten.present(rows, "event_id", "event_type"), {"event_id": "event_id", "ingested_at": "ingested_at", "event_type": "event_type", "note": "note"}, {"note": "none"})
    return out.withColumn("ingested_at", F.col("ingested_at").cast("string"))


@QUERIES.add("SELECT n_nationkey, 'tasks.retry.' || [5, 10, 20][least(n_nationkey % 6 + 1, 3)] || 'm' AS topic FROM nation")
def level_topics(spark, d):
    return table(spark, d, "nation").select("n_nationkey", errors.level_topic("tasks", [300, 600, 1200], F.col("n_nationkey") % 6).alias("topic"))


@QUERIES.add("SELECT n_nationkey, 'base/dir/' || n_nationkey || '/x' AS joined, 'a_b_c' AS safe FROM nation")
def path_parts(spark, d):
    k = F.col("n_nationkey").cast("string")
    return table(spark, d, "nation").select("n_nationkey", urls.under(F.lit("base/dir//"), F.concat(F.lit("/"), k, F.lit("/x"))).alias("joined"), urls.safe_part(F.lit("a b/c")).alias("safe"))


@QUERIES.add("SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS o_totalprice FROM orders")
def versioned_merge(spark, d):
    """A table laid out by its keys, merged into and read back."""
    t = new_table(spark, keys=["o_orderkey"])
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    t.merge(o, ["o_totalprice"])
    t.merge(o.where("o_orderkey % 10 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_totalprice"])
    return t.read()
