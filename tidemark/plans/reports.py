"""Duplicate reports, lifecycle analytics and metric analytics over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics, entities, metrics, ordered, tables
from .registry import Queries, table

QUERIES = Queries()
_KEYS = ["l_orderkey", "l_linenumber"]
_PER_KEY = "SELECT count(*) n FROM lineitem GROUP BY l_orderkey, l_linenumber"


@QUERIES.add("SELECT date_trunc('hour', ts) AS hour, count(*) AS n_rows, count(DISTINCT user_id) AS n_keys FROM events GROUP BY 1")
def hourly_distribution(spark, d):
    return analytics.hourly(table(spark, d, "events"), "ts", "user_id")


@QUERIES.add(f"SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_keys, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows, round((sum(n) - count(*)) * 100.0 / sum(n), 2) AS duplicate_pct FROM ({_PER_KEY})")
def dup_summary(spark, d):
    return analytics.duplicate_summary(table(spark, d, "lineitem"), _KEYS)


@QUERIES.add("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_groups(spark, d):
    return analytics.duplicate_groups(table(spark, d, "lineitem"), _KEYS)


@QUERIES.add("SELECT l_orderkey, l_linenumber, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen, count(*) AS n, date_sub('second', min(l_shipdate), max(l_shipdate)) AS span_seconds FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_span(spark, d):
    return analytics.duplicate_spans(table(spark, d, "lineitem"), _KEYS, "l_shipdate")


@QUERIES.add("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def dup_rows(spark, d):
    return analytics.rows_of_duplicates(table(spark, d, "lineitem").select(*_KEYS, "l_partkey"), _KEYS)


@QUERIES.add("SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def dup_texts(spark, d):
    return analytics.duplicate_groups(table(spark, d, "documents"), ["text"])


@QUERIES.add("SELECT source, CASE WHEN p > 10 THEN 'high' WHEN p > 1 THEN 'moderate' ELSE 'low' END AS band FROM (SELECT source, (count(*) - count(DISTINCT text)) * 100.0 / count(*) AS p FROM documents GROUP BY source)")
def dup_banding(spark, d):
    per = table(spark, d, "documents").groupBy("source", F.xxhash64("text").alias("h")).agg(F.count("*").alias("n")).groupBy("source").agg(F.sum("n").alias("n"), F.count("*").alias("u"))
    return per.select("source", analytics.duplicate_band((F.col("n") - F.col("u")) * 100.0 / F.col("n")).alias("band"))


@QUERIES.add("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 10")
def type_distribution_topk(spark, d):
    return analytics.distribution(table(spark, d, "events"), "event_type", 10)


@QUERIES.add("SELECT count(*) FILTER (url LIKE '%?%') AS with_query, count(*) FILTER (url NOT LIKE '%?%') AS without_query FROM pages")
def attachment_presence(spark, d):
    return table(spark, d, "pages").agg(F.count_if(F.col("url").contains("?")).alias("with_query"), F.count_if(~F.col("url").contains("?")).alias("without_query"))


@QUERIES.add("SELECT event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_tasks FROM events GROUP BY 1")
def status_distribution(spark, d):
    return analytics.status_distribution(table(spark, d, "events"), "event_type", "user_id")


@QUERIES.add("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS activity_date, count(*) FILTER (event_type = 'signup') AS tasks_assigned, count(*) FILTER (event_type = 'purchase') AS tasks_completed, count(DISTINCT user_id) AS unique_tasks FROM events GROUP BY 1")
def daily_activity(spark, d):
    return analytics.daily_activity(table(spark, d, "events"), "ts", "event_type", "signup", "purchase", "user_id").withColumn("activity_date", F.col("activity_date").cast("string"))


@QUERIES.add("SELECT o_custkey, count(DISTINCT o_orderkey) AS tasks_assigned, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS tasks_completed, round(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) * 100.0 / count(DISTINCT o_orderkey), 2) AS completion_rate_pct FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1")
def completion_rate(spark, d):
    return analytics.completion_rate(table(spark, d, "orders"), "o_custkey", "o_orderkey", F.col("o_orderstatus") == "F")


@QUERIES.add("""SELECT o_custkey, count(DISTINCT o_orderkey) AS total_tasks, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS completed_tasks, count(DISTINCT CASE WHEN o_orderstatus IN ('O', 'P') THEN o_orderkey END) AS active_tasks,
avg(date_sub('hour', o_orderdate, l_shipdate)) AS avg_hours_to_complete FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY total_tasks DESC, o_custkey LIMIT 50""")
def project_metrics(spark, d):
    both = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    hours = F.timestamp_diff("HOUR", F.col("o_orderdate"), F.col("l_shipdate"))
    out = analytics.group_metrics(both, "o_custkey", "o_orderkey", F.col("o_orderstatus") == "F", F.col("o_orderstatus").isin("O", "P"), hours)
    return out.orderBy(F.desc("total_tasks"), "o_custkey").limit(50)


@QUERIES.add("SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS event_date, avg(date_sub('second', o_orderdate, l_shipdate)) AS avg_lag_seconds, max(date_sub('second', o_orderdate, l_shipdate)) AS max_lag_seconds, count(*) AS event_count FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def processing_lag(spark, d):
    both = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    return analytics.processing_lag(both, F.to_date("o_orderdate"), F.timestamp_diff("SECOND", F.col("o_orderdate"), F.col("l_shipdate"))).withColumn("event_date", F.col("event_date").cast("string"))


@QUERIES.add("""SELECT 'negative balance' AS issue_type, count(*) FILTER (c_acctbal < 0) AS count FROM customer UNION ALL SELECT 'missing segment', count(*) FILTER (nullif(c_mktsegment, 'BUILDING') IS NULL) FROM customer
UNION ALL SELECT 'open and old', count(*) FILTER (o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1995-01-01') FROM orders""")
def data_quality_union(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    return analytics.issue_counts([("negative balance", c, F.col("c_acctbal") < 0), ("missing segment", c, F.nullif("c_mktsegment", F.lit("BUILDING")).isNull()), ("open and old", o, (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp_ntz")))])


@QUERIES.add("SELECT event_id, user_id, date_sub('minute', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS since_last FROM events")
def time_since_last(spark, d):
    return analytics.time_since_last(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "ts").select("event_id", "user_id", "since_last")


@QUERIES.add("SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn = 1")
def latest_per_key(spark, d):
    return tables.keep_last(table(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"])


@QUERIES.add("SELECT user_id, event_type, date_diff('day', CAST(ts AS DATE), DATE '2024-06-01') AS days_since_last_update FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn = 1 AND event_type NOT IN ('purchase', 'error')")
def active_tasks(spark, d):
    latest = tables.keep_last(table(spark, d, "events"), ["user_id"], ["ts", "event_id"])
    return analytics.unfinished(latest, "event_type", ["purchase", "error"], "ts", F.lit("2024-06-01").cast("date")).select("user_id", "event_type", "days_since_last_update")


@QUERIES.add("SELECT coalesce(p, 'CREATED') AS from_status, event_type AS to_status, count(*) AS transition_count FROM (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) p FROM events) GROUP BY 1, 2")
def status_transitions(spark, d):
    return analytics.transitions(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type")


@QUERIES.add("SELECT coalesce(p, 'CREATED') AS from_status, role AS to_status, count(*) AS transition_count FROM (SELECT role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, text) p FROM conversations) GROUP BY 1, 2")
def role_transitions(spark, d):
    return analytics.transitions(table(spark, d, "conversations"), ["conv_id"], ["turn", "text"], "role")


@QUERIES.add("SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def recent_topk(spark, d):
    return table(spark, d, "events").select("event_id", "ts", "event_type").orderBy(F.desc("ts"), F.desc("event_id")).limit(20)


@QUERIES.add("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days_to_complete FROM lineitem JOIN orders ON l_orderkey = o_orderkey ORDER BY days_to_complete DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50")
def computed_topk(spark, d):
    both = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.datediff("l_shipdate", "o_orderdate").alias("days_to_complete"))
    return rows.orderBy(F.desc("days_to_complete"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").limit(50)


@QUERIES.add("SELECT event_type, count(*) AS total, count(*) FILTER (value > 50) AS succeeded, count(*) FILTER (NOT value > 50) AS failed, count(*) FILTER (NOT value > 50 AND user_id % 2 = 0) AS failed_permanent, CAST(sum(event_id % 3) AS BIGINT) AS api_calls FROM events GROUP BY 1")
def handler_totals(spark, d):
    e = table(spark, d, "events").withColumn("calls", F.col("event_id") % 3)
    return analytics.handler_results(e, "event_type", F.col("value") > 50, F.col("user_id") % 2 == 0, "calls")


@QUERIES.add("SELECT conv_id, count(*) AS n_turns, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS n_words, CAST(count(*) + sum(len(string_split(text, ' '))) AS BIGINT) AS n_all FROM conversations GROUP BY 1")
def bundle_concat(spark, d):
    c = table(spark, d, "conversations").select("conv_id", F.array("role").alias("turns"), F.split("text", " ").alias("words"))
    return entities.bundle_sizes(c, "conv_id", ["turns", "words"])


# --- metrics: a counter is the running number of events of a type, hidden resets every 100 -----

_COUNTER = "(SELECT event_type, ts, event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) % 100 AS DOUBLE) AS c FROM events)"
_STEPS = f"(SELECT *, CASE WHEN b IS NULL THEN 0 WHEN c < b THEN c ELSE c - b END AS gain FROM (SELECT *, lag(c) OVER (PARTITION BY event_type ORDER BY ts, event_id) b FROM {_COUNTER}))"


def _counter(spark, d):
    e = ordered.ranges(table(spark, d, "events").select("event_type", "ts", "event_id"), ["event_type"], ["ts", "event_id"])
    return e.scan(n=ordered.number()).with_columns({"c": (F.col("n") % 100).cast("double")})


@QUERIES.add(f"SELECT event_type, date_trunc('day', ts) AS window_start, sum(gain) AS increase FROM {_STEPS} GROUP BY 1, 2")
def metric_increase(spark, d):
    return metrics.increase(_counter(spark, d), ["event_type"], ["ts", "event_id"], "c", F.date_trunc("DAY", "ts").cast("timestamp_ntz"))


@QUERIES.add(f"""SELECT event_type, s, round(CASE WHEN s > lo THEN (total - first_gain) / (s - lo) END, 9) AS rate FROM (SELECT event_type, s, min(s) OVER w lo, sum(gain) OVER w total, first(gain) OVER w first_gain FROM
(SELECT event_type, s, CASE WHEN b IS NULL THEN 0 WHEN c < b THEN c ELSE c - b END gain FROM (SELECT *, lag(c) OVER (PARTITION BY event_type ORDER BY ts) b FROM (SELECT event_type, ts, CAST(floor(epoch(ts)) AS BIGINT) s, CAST(count(*) AS DOUBLE) AS k, sum(count(*)) OVER (PARTITION BY event_type ORDER BY ts) % 1000 c FROM events GROUP BY 1, 2, 3)))
WINDOW w AS (PARTITION BY event_type ORDER BY s RANGE BETWEEN 7200 PRECEDING AND CURRENT ROW))""")
def metric_rate(spark, d):
    per = table(spark, d, "events").groupBy("event_type", "ts").agg(F.count("*").alias("k"))
    counter = metrics.cumulated(per, ["event_type"], ["ts"], "k", "c").with_columns({"c": (F.col("c") % 1000).cast("double")})
    out = metrics.rate(counter, ["event_type"], "ts", "c", 7200)
    return out.select("event_type", F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("s"), F.round("rate", 9).alias("rate"))


@QUERIES.add("SELECT event_type, CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS BIGINT) AS part, count(*) AS whole, sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) / count(*) AS ratio FROM events GROUP BY 1")
def ratio_by_label(spark, d):
    return metrics.ratio(table(spark, d, "events"), ["event_type"], (F.col("value") > 50).cast("int"), F.lit(1))


@QUERIES.add("""WITH le AS (SELECT unnest([10.0, 50.0, 100.0, 200.0, 'inf'::DOUBLE]) le), b AS (SELECT event_type, le, CAST(count(*) FILTER (value <= le) AS DOUBLE) c FROM events, le GROUP BY 1, 2),
w AS (SELECT *, coalesce(lag(c) OVER p, 0) below, coalesce(lag(le) OVER p, 0) start, max(c) OVER (PARTITION BY event_type) total FROM b WINDOW p AS (PARTITION BY event_type ORDER BY le)),
f AS (SELECT event_type, min_by({s: start, e: le, b: below, u: c, t: total}, le) x FROM w WHERE c >= 0.95 * total AND (below < 0.95 * total OR start = 0) GROUP BY 1)
SELECT event_type, round(CASE WHEN x.e = 'inf'::DOUBLE THEN x.s ELSE x.s + (x.e - x.s) * (0.95 * x.t - x.b) / (x.u - x.b) END, 6) AS quantile FROM f""")
def histogram_quantile(spark, d):
    e = table(spark, d, "events")
    bounds = [10.0, 50.0, 100.0, 200.0, float("inf")]
    sums = e.groupBy("event_type").agg(*[F.count_if(F.col("value") <= b).cast("double").alias(f"b{i}") for i, b in enumerate(bounds)])
    buckets = sums.select("event_type", F.explode(F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("c")) for i, b in enumerate(bounds)])).alias("x")).select("event_type", "x.le", "x.c")
    return metrics.histogram_quantile(buckets, ["event_type"], "le", "c", 0.95).select("event_type", F.round("quantile", 6).alias("quantile"))


@QUERIES.add("""SELECT user_id, min(ts) AS since, max(ts) AS until, count(*) AS samples FROM (SELECT *, sum(CASE WHEN value > 20 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) run FROM events) WHERE value > 20 GROUP BY user_id, run HAVING date_sub('second', min(ts), max(ts)) >= 86400""")
def alert_for(spark, d):
    return metrics.sustained(table(spark, d, "events"), ["user_id"], "ts", F.col("value") > 20, 86400)


@QUERIES.add("SELECT event_type, max_by(value, ts) AS value, max(ts) AS at FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id DESC) = 1) GROUP BY 1")
def latest_values(spark, d):
    e = tables.keep_last(table(spark, d, "events"), ["event_type", "ts"], ["event_id"])
    return metrics.latest(e, ["event_type"], "ts", "value")


@QUERIES.add("SELECT user_id % 10 AS consumer_group, event_type AS topic, CAST(sum(lag) AS BIGINT) AS total_lag, max(lag) AS max_lag, count(*) AS partitions FROM (SELECT user_id % 10 AS user_id, event_type, event_id % 4 AS p, max(event_id) - (max(event_id - event_id % 7) + 1) AS lag FROM events GROUP BY 1, 2, 3) GROUP BY 1, 2")
def lag_rollup(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 10).alias("consumer_group"), F.col("event_type").alias("topic"), (F.col("event_id") % 4).alias("p"), F.col("event_id").alias("high"), (F.col("event_id") - F.col("event_id") % 7).alias("seen"))
    return metrics.lag_rollup(e, "consumer_group", "topic", "p", "high", "seen")


@QUERIES.add("SELECT count(*) FILTER (c_acctbal >= 0) AS healthy, count(*) FILTER (NOT c_acctbal >= 0) AS unhealthy FROM customer")
def worker_status(spark, d):
    return metrics.health(table(spark, d, "customer"), F.col("c_acctbal") >= 0)


@QUERIES.add("SELECT s_suppkey, 'lag_messages' AS metric, 't' || s_suppkey AS topic, CAST(s_suppkey * 2 AS DOUBLE) AS value FROM supplier WHERE s_suppkey % 3 <> 0")
def exposition_lines(spark, d):
    k = F.col("s_suppkey").cast("string")
    line = F.when(F.col("s_suppkey") % 3 == 0, "# HELP lag_messages").otherwise(F.concat(F.lit('lag_messages{topic="t'), k, F.lit('",key="'), k, F.lit('"} '), (F.col("s_suppkey") * 2).cast("string")))
    out = metrics.parsed_lines(table(spark, d, "supplier").select(line.alias("value")))
    return out.select(F.col("labels")["key"].cast("bigint").alias("s_suppkey"), "metric", F.col("labels")["topic"].alias("topic"), "value")
