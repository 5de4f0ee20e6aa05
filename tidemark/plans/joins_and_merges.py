"""Joins, keyed merges, appends and entity fan-out over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import entities, forms, plugins, tables
from .registry import Queries, new_table, table

QUERIES = Queries()


@QUERIES.add("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def semi_join(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 250000")
    return table(spark, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@QUERIES.add("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_join(spark, d):
    return table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@QUERIES.add("SELECT c_custkey, n_name, CASE WHEN n_name IS NULL THEN 'failed_permanent' ELSE 'found' END AS lookup_status FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON n_nationkey = c_nationkey")
def left_lookup_status(spark, d):
    items = table(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return entities.attached(table(spark, d, "customer").select("c_custkey", "c_nationkey"), items, "c_nationkey").select("c_custkey", "n_name", "lookup_status")


@QUERIES.add("SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON 'n-' || s_nationkey = 'n-' || n_nationkey")
def derived_key_join(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("n-"), "s_nationkey").alias("k"))
    return s.join(table(spark, d, "nation").select("n_name", F.concat(F.lit("n-"), "n_nationkey").alias("k")), "k", "left").drop("k")


@QUERIES.add("SELECT event_id, action, target FROM events JOIN (VALUES (1, 'purchase', 'publish', 'orders'), (1, 'purchase', 'log', 'audit'), (2, NULL, 'webhook', 'crm')) r(k, kind, action, target) ON user_id % 3 = k AND (kind IS NULL OR kind = event_type)")
def rule_lookup_actions(spark, d):
    act = lambda *pairs: F.array(*[F.struct(F.lit(a).alias("action"), F.lit(t).alias("target")) for a, t in pairs])
    rule = lambda k, on, acts: F.struct(F.lit(k).cast("long").alias("k"), F.lit(on).cast("string").alias("on"), acts.alias("actions"))
    rules = spark.range(1).select(F.inline(F.array(rule(1, "purchase", act(("publish", "orders"), ("log", "audit"))), rule(2, None, act(("webhook", "crm"))))))
    events = table(spark, d, "events").select("event_id", "event_type", (F.col("user_id") % 3).alias("k"))
    return plugins.triggered(events, rules, "k", "event_type").select("event_id", "action", "target")


@QUERIES.add("SELECT * FROM (SELECT l_orderkey, l_linenumber, max_by(l_partkey, (l_shipdate, l_partkey, l_suppkey)) AS l_partkey, max_by(l_suppkey, (l_shipdate, l_partkey, l_suppkey)) AS l_suppkey, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY 1, 2)")
def keep_last_distinct(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return tables.keep_last(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@QUERIES.add("SELECT user_id, max(event_id) AS event_id, max_by(k, event_id) FILTER (k IS NOT NULL) AS event_type, max_by(v, event_id) FILTER (v IS NOT NULL) AS value FROM (SELECT *, nullif(event_type, 'error') k, CASE WHEN value < 80 THEN value END v FROM events) GROUP BY 1")
def in_batch_coalesce(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), F.when(F.col("value") < 80, F.col("value")).alias("value"))
    return tables.coalesced_by_key(e, ["user_id"], ["event_id"])


def _sides(spark, d):
    o = table(spark, d, "orders")
    target = o.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").cast("string").alias("created_at"))
    source = o.where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit("N").alias("status"), F.lit("2030-01-01").alias("created_at"))
    return target, source


_T = "(SELECT o_orderkey, o_totalprice, o_orderstatus AS status, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS created_at FROM orders WHERE o_orderkey % 3 <> 0) t"
_S = "(SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, 'N' AS status, '2030-01-01' AS created_at FROM orders WHERE o_orderkey % 2 = 0) s"


@QUERIES.add(f"SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice, coalesce(s.status, t.status) AS status, coalesce(s.created_at, t.created_at) AS created_at FROM {_T} FULL JOIN {_S} ON t.o_orderkey = s.o_orderkey")
def merge_upsert(spark, d):
    return tables.merged(*_sides(spark, d), ["o_orderkey"], preserve=())


@QUERIES.add(f"SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice, coalesce(s.status, t.status) AS status, coalesce(t.created_at, s.created_at) AS created_at FROM {_T} FULL JOIN {_S} ON t.o_orderkey = s.o_orderkey")
def merge_preserve(spark, d):
    return tables.merged(*_sides(spark, d), ["o_orderkey"])


@QUERIES.add(f"SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND t.status <> 'F') THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice, CASE WHEN t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND t.status <> 'F') THEN s.status ELSE t.status END AS status, coalesce(t.created_at, s.created_at) AS created_at FROM {_T} FULL JOIN {_S} ON t.o_orderkey = s.o_orderkey")
def merge_conditional(spark, d):
    return tables.merged(*_sides(spark, d), ["o_orderkey"], condition="target.status <> 'F'")


@QUERIES.add(f"SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.o_totalprice, s.o_totalprice) AS o_totalprice, coalesce(t.status, s.status) AS status, coalesce(t.created_at, s.created_at) AS created_at FROM {_T} FULL JOIN {_S} ON t.o_orderkey = s.o_orderkey")
def merge_insert_only(spark, d):
    return tables.merged(*_sides(spark, d), ["o_orderkey"], when_matched="do_nothing")


@QUERIES.add(f"SELECT t.* FROM {_T} WHERE NOT EXISTS (SELECT 1 FROM {_S} WHERE s.o_orderkey = t.o_orderkey)")
def merge_delete(spark, d):
    return tables.merged(*_sides(spark, d), ["o_orderkey"], when_matched="delete", when_not_matched="do_nothing")


@QUERIES.add(f"SELECT count(*) FILTER (t.o_orderkey IS NOT NULL) AS rows_updated, count(*) FILTER (t.o_orderkey IS NULL) AS rows_inserted FROM {_S} LEFT JOIN {_T} ON t.o_orderkey = s.o_orderkey")
def merge_metrics(spark, d):
    return tables.merge_counts(*_sides(spark, d), ["o_orderkey"])


@QUERIES.add("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier")
def append_evolve(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").cast("string").alias("balance"), F.col("s_nationkey").alias("nation"))
    t = new_table(spark)
    t.append(c)
    t.append(s)
    return t.read()


@QUERIES.add("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 0)")
def idempotent_append(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return tables.unseen(o, o.where("o_orderkey % 4 = 0"), ["o_orderkey"])


@QUERIES.add("SELECT max_by(event_id, (ts, event_id)) AS event_id, user_id, max(ts) AS ts FROM events GROUP BY user_id")
def append_once(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    return tables.appended_once(e.union(e.where("event_id % 2 = 0")), "event_id", "user_id", ["ts", "event_id"])


def _projects(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    emails = F.when(k % 3 == 0, F.array().cast("array<struct<emailAddress:string,primary:boolean>>")).otherwise(F.array(F.struct(F.concat(F.lit("a"), k.cast("string")).alias("emailAddress"), F.lit(False).alias("primary")), F.struct(F.concat(F.lit("b"), k.cast("string")).alias("emailAddress"), (k % 3 == 1).alias("primary"))))
    team = F.array(F.struct(F.concat(F.lit("rep"), (k % 7).cast("string")).alias("userName"), (k % 2 == 0).alias("primaryContact"), F.lit("M1").alias("mfn")), F.struct(F.lit(" ").alias("userName"), F.lit(True).alias("primaryContact"), F.lit(None).cast("string").alias("mfn")))
    project = F.struct(k.cast("string").alias("projectId"), F.lit("open").alias("status"), F.lit("1990").alias("yearBuilt"), F.lit("2024-01-02T03:04:05Z").alias("createdDate"), F.struct(F.col("c_name").alias("firstName"), emails.alias("emails"), F.array(F.struct(F.lit("555").alias("phoneNumber"), F.lit("1").alias("phoneCountryCode"))).alias("phones")).alias("customerInformation"))
    payload = F.to_json(F.struct(F.struct(project.alias("project"), F.lit("Acme").alias("companyName"), team.alias("teamMembers")).alias("data")))
    return entities.parsed_projects(c.select(payload.alias("payload"), F.concat(F.lit("e"), k.cast("string")).alias("event_id")))


@QUERIES.add("SELECT CAST(c_custkey AS VARCHAR) AS project_id, 'open' AS status, 1990 AS year_built, '2024-01-02T03:04:05+00:00' AS created_date, c_name AS customer_first_name, CASE c_custkey % 3 WHEN 1 THEN 'b' || c_custkey WHEN 2 THEN 'a' || c_custkey END AS primary_email, '555' AS primary_phone, 1 AS primary_phone_country_code, 'Acme' AS company_name FROM customer")
def primary_pick(spark, d):
    return entities.project_rows(_projects(spark, d)).select("project_id", "status", "year_built", "created_date", "customer_first_name", "primary_email", "primary_phone", "primary_phone_country_code", "company_name")


@QUERIES.add("SELECT CAST(c_custkey AS VARCHAR) AS project_id, CASE c_custkey % 3 WHEN 1 THEN 'b' || c_custkey ELSE 'a' || c_custkey END AS contact_email, 'POLICYHOLDER' AS contact_type, TRUE AS is_primary_contact, NULL AS master_file_name FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'rep' || (c_custkey % 7), 'CLAIM_REP', c_custkey % 2 = 0, 'M1' FROM customer")
def entity_fanout(spark, d):
    return entities.contact_rows(_projects(spark, d)).select("project_id", "contact_email", "contact_type", "is_primary_contact", "master_file_name")


@QUERIES.add("SELECT event_id AS assignment_id, user_id AS task_id, event_type AS status, CAST(user_id AS VARCHAR) AS project_id, event_id % 2 = 0 AS stp_enabled, 'e' || event_id AS event_id FROM events")
def task_rows(spark, d):
    e = table(spark, d, "events")
    payload = F.to_json(F.struct(F.col("event_id").alias("assignmentId"), F.col("user_id").alias("taskId"), F.concat(F.lit(" "), "event_type").alias("status"), F.col("user_id").cast("double").alias("projectId"), (F.col("event_id") % 2 == 0).alias("stpEnabled")))
    rows = entities.flat_rows(e.select(payload.alias("p"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id")), F.col("p"), entities.TASK, "event_id")
    return rows.select("assignment_id", "task_id", "status", "project_id", "stp_enabled", "event_id")


@QUERIES.add("SELECT s_suppkey AS video_collaboration_id, CASE WHEN s_suppkey % 2 = 0 THEN 'Full ' || s_suppkey ELSE 'Ann ' || s_name END AS claim_rep_full_name, CAST(s_suppkey AS VARCHAR) AS total_time_seconds FROM supplier")
def video_rows(spark, d):
    k = F.col("s_suppkey")
    p = F.to_json(F.struct(F.when(k % 2 == 0, k).alias("videoCollaborationId"), F.when(k % 2 == 1, k).alias("id"), F.lit("Ann").alias("claimRepFirstName"), F.col("s_name").alias("claimRepLastName"), F.when(k % 2 == 0, F.concat(F.lit("Full "), k.cast("string"))).alias("claimRepFullName"), k.alias("totalTimeSeconds")))
    return entities.video_rows(table(spark, d, "supplier").select(p.alias("p")), F.col("p")).select("video_collaboration_id", "claim_rep_full_name", "total_time_seconds")


@QUERIES.add("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 2 THEN 1 ELSE 2 END AS n_items, CASE WHEN n_nationkey % 3 = 2 THEN n_name ELSE n_name || '-1' END AS first_name FROM nation")
def response_lists(spark, d):
    k, n = F.col("n_nationkey"), F.col("n_name")
    two = F.array(F.struct(F.concat(n, F.lit("-1")).alias("name")), F.struct(F.concat(n, F.lit("-2")).alias("name")))
    payload = F.when(k % 3 == 0, F.to_json(two)).when(k % 3 == 1, F.to_json(F.struct(two.alias("data")))).otherwise(F.to_json(F.struct(n.alias("name"))))
    items = entities.normalised_list(F.col("p"), "struct<name:string>", "media")
    return table(spark, d, "nation").select("n_nationkey", payload.alias("p")).select("n_nationkey", items.alias("i")).select("n_nationkey", F.size("i").alias("n_items"), F.col("i")[0]["name"].alias("first_name"))


@QUERIES.add("SELECT doc_id, w - 1 AS display_order, words[w] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) w FROM (SELECT doc_id, string_split(text, ' ') words FROM documents))")
def posexplode_order(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("display_order", "word"))


def _forms(spark, d):
    k = F.col("s_suppkey")
    kinds = "struct<name:string>"
    q = lambda text, kind, opt=None, num=None, txt=None, ctl=None, media=None: F.struct(F.lit(text).alias("questionText"), F.struct(F.lit(ctl).cast("string").alias("id")).alias("formControl"), F.struct(F.lit(kind).alias("type"), F.struct((opt if opt is not None else F.lit(None)).cast("string").alias("name")).cast(kinds).alias("optionAnswer"), (num if num is not None else F.lit(None)).cast("double").alias("numberAnswer"), (txt if txt is not None else F.lit(None)).cast("string").alias("textAnswer"), (media if media is not None else F.lit(None)).cast("array<string>").alias("claimMediaIds")).alias("responseAnswerExport"))
    first = F.array(q("Lower Cabinets Damaged?", "option", opt=F.when(k % 2 == 0, "Yes").otherwise("No")), q("Linear Feet of Lower Cabinets", "number", num=k + 0.7), q("Photos", "image", ctl="c1", media=F.array(F.concat(F.lit("m"), k.cast("string")), F.lit(""), F.lit("x"))))
    second = F.array(q("Describe the Damage", "text", txt=F.col("s_name")), q("Odd Question?", "option", opt=F.lit("Yes")), q("More photos", "image", ctl="c2", media=F.array(F.lit("y"))))
    response = F.to_json(F.struct(F.array(F.struct(first.alias("questionAndAnswers")), F.struct(second.alias("questionAndAnswers"))).alias("groups")))
    return table(spark, d, "supplier").select(k.alias("form"), response.alias("response"))


@QUERIES.add("SELECT s_suppkey AS form, CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE 'false' END AS lower_cabinets_damaged, CAST(s_suppkey AS VARCHAR) AS lower_cabinets_lf, s_name AS damage_description, 'Yes' AS odd_question FROM supplier")
def pivot_answers(spark, d):
    rows = forms.answers(_forms(spark, d), "response", "form", known=forms.QUESTION_FIELDS)
    return forms.submissions(rows, ["form"], ["lower_cabinets_damaged", "lower_cabinets_lf", "damage_description", "odd_question"])


@QUERIES.add("SELECT s_suppkey AS form, q AS question_key, m AS claim_media_id, o AS display_order FROM supplier, LATERAL (VALUES ('first', 'm' || s_suppkey, 0), ('first', 'x', 1), ('second', 'y', 2)) v(q, m, o)")
def form_attachments(spark, d):
    return forms.attachments(_forms(spark, d), "response", "form", {"c1": "first", "c2": "second"}).drop("question_text")


@QUERIES.add("SELECT s_suppkey AS form, 'm' || s_suppkey || ',x' AS first_media, 'y' AS second_media FROM supplier")
def nested_payload(spark, d):
    media = forms.media_by_question(forms.attachments(_forms(spark, d), "response", "form", {"c1": "first", "c2": "second"}), "form")
    return media.select("form", F.array_join(F.col("media")["first"], ",").alias("first_media"), F.array_join(F.col("media")["second"], ",").alias("second_media"))
