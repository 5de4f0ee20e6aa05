"""Scalar functions over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import errors, ids, text, urls
from .registry import Queries, table

QUERIES = Queries()
_NS = uuid.uuid5(uuid.NAMESPACE_DNS, "tidemark.example.org")
_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
_PATH = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_LAST = f"string_split({_PATH}, '/')[-1]"
_DOMAINS = ["example.com", "www.example.org", "site0.example", "example.org"]


@QUERIES.add(f"""SELECT page_id, CASE WHEN url IS NULL OR url = '' THEN 'Empty URL' WHEN h = '' THEN 'No hostname in URL' WHEN s NOT IN ('http', 'https') THEN 'Invalid scheme: ' || s
WHEN s = 'http' AND h <> 'localhost' THEN 'Must be HTTPS for non-localhost, got http' WHEN h NOT IN ({", ".join(f"'{x}'" for x in _DOMAINS)}) THEN 'Domain not in allowlist: ' || h ELSE '' END AS problem
FROM (SELECT *, {_HOST} AS h, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS s FROM pages)""")
def url_host_allowed(spark, d):
    return table(spark, d, "pages").select("page_id", urls.url_problem(F.col("url"), _DOMAINS).alias("problem"))


@QUERIES.add(f"""SELECT page_id, CASE WHEN l LIKE '%.%' THEN regexp_extract(l, '^(.*)\\.', 1) WHEN l = '' THEN 'unknown' ELSE l END AS file_name,
CASE WHEN l LIKE '%.%' THEN upper(string_split(l, '.')[-1]) ELSE 'UNKNOWN' END AS file_type FROM (SELECT page_id, {_LAST} AS l FROM (SELECT page_id, url || CASE page_id % 3 WHEN 0 THEN '/report.final.pdf?x=1' WHEN 1 THEN '/' ELSE '/noext' END AS url FROM pages))""")
def url_filename_ext(spark, d):
    tail = F.when(F.col("page_id") % 3 == 0, "/report.final.pdf?x=1").when(F.col("page_id") % 3 == 1, "/").otherwise("/noext")
    p = table(spark, d, "pages").select("page_id", F.concat(F.regexp_replace("url", "[?#].*$", ""), tail).alias("url"), F.concat("url", tail).alias("full"))
    return p.select("page_id", urls.file_name(F.col("full")).alias("file_name"), urls.file_type(F.col("full")).alias("file_type"))


@QUERIES.add(f"""SELECT page_id, regexp_replace(u, '([?&](?:{"|".join(text.SENSITIVE_PARAMS)})=)[^&#]*', '\\1[REDACTED]', 'gi') AS clean FROM (SELECT page_id, url || CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END || 'sig=ab' || page_id || '&page=2&Token=zz#top' AS u FROM pages)""")
def url_sanitize(spark, d):
    u = F.concat("url", F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("sig=ab"), F.col("page_id").cast("string"), F.lit("&page=2&Token=zz#top"))
    return table(spark, d, "pages").select("page_id", text.redacted_url(u).alias("clean"))


@QUERIES.add("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 's3' WHEN 1 THEN 's3' WHEN 2 THEN 'epoch' ELSE 'unknown' END AS url_type,
CASE page_id % 4 WHEN 0 THEN '2024-01-10 00:00:00' WHEN 2 THEN '2024-01-10 01:00:00' END AS expires_at,
CASE WHEN page_id % 4 IN (0, 2) THEN 3600 END AS ttl_seconds, page_id % 4 IN (0, 2) AS is_expired, CASE page_id % 4 WHEN 1 THEN 'Missing X-Amz-Expires' END AS parse_error FROM pages""")
def url_param_expiry(spark, d):
    k = F.col("page_id") % 4
    tail = F.when(k == 0, "https://b.s3.example/x.pdf?X-Amz-Date=20240109T230000Z&x-amz-expires=3600").when(k == 1, "https://b.s3.example/x?X-Amz-Date=20240109T230000Z").when(k == 2, "https://files.example.com/g?systemDate=1704844800000&expires=3600000").otherwise("https://plain.example/x")
    info = urls.presigned(tail, F.lit("2024-02-01").cast("timestamp"), ("files.example.com",))
    return table(spark, d, "pages").select("page_id", info.alias("i")).select("page_id", "i.url_type", F.date_format("i.expires_at", "yyyy-MM-dd HH:mm:ss").alias("expires_at"), "i.ttl_seconds", "i.is_expired", "i.parse_error")


_EXTS = "'" + "', '".join(urls.ALLOWED_EXTENSIONS) + "'"


@QUERIES.add(f"""SELECT page_id, CASE WHEN e IS NULL THEN 'No file extension found' WHEN e NOT IN ({_EXTS}) THEN 'File extension ''' || e || ''' not allowed'
WHEN t NOT IN ('application/pdf', 'image/png') THEN 'Content-Type ''' || t || ''' not allowed' WHEN (e = 'pdf' AND t <> 'application/pdf') OR (e = 'png' AND t <> 'image/png') THEN 'Content-Type ''' || t || ''' doesn''t match extension ''' || e || '''' ELSE '' END AS problem
FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'exe' WHEN 2 THEN 'png' END AS e, CASE page_id % 3 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'image/png' ELSE 'text/css' END AS t FROM pages)""")
def file_ext_valid(spark, d):
    k = F.col("page_id")
    name = F.when(k % 4 == 0, "docs/a.PDF").when(k % 4 == 1, "b.exe").when(k % 4 == 2, "get/uuid?filename=c.png").otherwise("none")
    kind = F.when(k % 3 == 0, "application/pdf; charset=x").when(k % 3 == 1, "IMAGE/PNG").otherwise("text/css")
    return table(spark, d, "pages").select("page_id", urls.file_problem(name, kind).alias("problem"))


@QUERIES.add("""SELECT s_suppkey, h AS host, h IN ('127.0.0.1', '0.0.0.0', 'metadata.google.internal', 'metadata.aws.internal', '169.254.169.254') OR regexp_matches(h, '^(10\\.|127\\.|192\\.168\\.|169\\.254\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.)[0-9.]+$') AS private
FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '10.0.0.' || s_suppkey WHEN 1 THEN '172.' || (s_suppkey % 40) || '.1.1' WHEN 2 THEN '8.8.8.8' ELSE 'metadata.google.internal' END AS h FROM supplier)""")
def private_hosts(spark, d):
    k = F.col("s_suppkey")
    h = F.when(k % 4 == 0, F.concat(F.lit("10.0.0."), k.cast("string"))).when(k % 4 == 1, F.concat(F.lit("172."), (k % 40).cast("string"), F.lit(".1.1"))).when(k % 4 == 2, "8.8.8.8").otherwise("metadata.google.internal")
    return table(spark, d, "supplier").select("s_suppkey", h.alias("host"), urls.is_private_host(h).alias("private"))


def _redact_sql(c: str) -> str:
    for key in text.MESSAGE_KEYS:
        c = f"regexp_replace({c}, '{key}=[^&\\s\"'']+', '{key}=[REDACTED]', 'gi')"
    c = f"regexp_replace({c}, 'bearer\\s+[a-zA-Z0-9\\-_.]+', 'bearer [REDACTED]', 'gi')"
    c = f"regexp_replace({c}, 'api[_-]?key[=:]\\s*[^\\s\"''&]+', 'api_key=[REDACTED]', 'gi')"
    return f"regexp_replace({c}, '([?&](?:{'|'.join(text.SENSITIVE_PARAMS)})=)[^&#]*', '\\1[REDACTED]', 'gi')"


@QUERIES.add(f"SELECT event_id, {_redact_sql('m')} AS clean FROM (SELECT event_id, 'failed ' || event_type || ' token=a' || event_id || ' at https://h/x?pwd=1&q=2 Bearer abc.def api_key: k1' AS m FROM events)")
def error_redact(spark, d):
    m = F.concat(F.lit("failed "), "event_type", F.lit(" token=a"), F.col("event_id").cast("string"), F.lit(" at https://h/x?pwd=1&q=2 Bearer abc.def api_key: k1"))
    return table(spark, d, "events").select("event_id", text.redacted_message(m).alias("clean"))


@QUERIES.add("SELECT doc_id, CASE WHEN length(text) > 500 THEN left(text, 497) || '...' ELSE text END AS error FROM documents")
def text_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", text.truncated(F.col("text")).alias("error"))


@QUERIES.add("""SELECT o_orderkey, s || '/A' || o_custkey || '/T' || o_orderkey || '/A' || o_custkey || CASE s WHEN 'firstNoticeOfLossReceived' THEN '_FNOL_' WHEN 'estimatePackageReceived' THEN CASE WHEN o_orderkey % 2 = 0 THEN '_v2_' ELSE '_unknown_' END ELSE '_' END || 'file.pdf' AS path
FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'documentsReceived' WHEN 1 THEN 'firstNoticeOfLossReceived' ELSE 'estimatePackageReceived' END AS s FROM orders)""")
def blob_path(spark, d):
    k = F.col("o_orderkey")
    s = F.when(k % 3 == 0, "documentsReceived").when(k % 3 == 1, "firstNoticeOfLossReceived").otherwise("estimatePackageReceived")
    path = urls.blob_path(s, F.concat(F.lit("T"), k.cast("string")), F.concat(F.lit("A"), F.col("o_custkey").cast("string")), F.lit("https://x.example/a/file.PDF?t=1"), F.when(k % 2 == 0, "v2"))
    return table(spark, d, "orders").select("o_orderkey", path.alias("path"))


@QUERIES.add("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'events' WHEN 1 THEN 'inventory' WHEN 2 THEN 'last' ELSE 'default' END AS name FROM part")
def table_name_case(spark, d):
    k = F.col("p_partkey") % 4
    path = F.when(k == 0, "store/Events_raw/x").when(k == 1, "a/INVENTORY/b").when(k == 2, "some/other/last/").otherwise("")
    return table(spark, d, "part").select("p_partkey", urls.table_name(path, ("events", "attachments", "inventory", "failed")).alias("name"))


@QUERIES.add("SELECT s_suppkey, 'c' || s_suppkey AS container, 'acct.dfs.example.net' AS account, 'data/t' || s_suppkey AS path FROM supplier")
def abfss_split(spark, d):
    k = F.col("s_suppkey").cast("string")
    return table(spark, d, "supplier").select("s_suppkey", urls.store_parts(F.concat(F.lit("abfss://c"), k, F.lit("@acct.dfs.example.net/data/t"), k)).alias("p")).select("s_suppkey", "p.*")


@QUERIES.add(f"""SELECT event_id, lower(h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', CAST(('0x' || h[17:17]) AS INTEGER) % 4 + 1, 1) || h[18:20] || '-' || h[21:32]) AS id FROM (SELECT event_id, sha1(unhex('{_NS.hex}') || encode(event_type || ':' || event_id)) AS h FROM events)""")
def uuid5_id(spark, d):
    return table(spark, d, "events").select("event_id", ids.uuid5(F.concat("event_type", F.lit(":"), F.col("event_id").cast("string")), _NS).alias("id"))


@QUERIES.add("SELECT event_id, concat_ws('|', event_id, nullif(event_type, 'error'), user_id) AS key, sha256(concat_ws('|', event_id, nullif(event_type, 'error'), user_id)) AS id, left(sha256(CAST(event_id AS VARCHAR)), 24) AS short_id FROM events")
def sha256_id(spark, d):
    parts = (F.col("event_id"), F.nullif("event_type", F.lit("error")), F.col("user_id"))
    return table(spark, d, "events").select("event_id", ids.composite_key(*parts).alias("key"), ids.sha256_id(*parts).alias("id"), ids.sha256_id(F.col("event_id"), length=24).alias("short_id"))


@QUERIES.add("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS as_int, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS INTEGER) END AS as_int32, CASE WHEN c_custkey % 3 <> 2 THEN CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS DOUBLE) ELSE 12.7 END END AS as_float,
CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN '12.7' END AS as_decimal, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN '12.7' ELSE 'n/a' END AS as_id, CASE WHEN c_custkey % 2 = 0 THEN 'x' END AS cleaned FROM customer""")
def safe_casts(spark, d):
    k = F.col("c_custkey")
    mixed = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, "12.7").otherwise(" n/a ")
    return table(spark, d, "customer").select("c_custkey", text.try_int(mixed).alias("as_int"), text.try_int32(mixed).alias("as_int32"), text.try_float(mixed).alias("as_float"), text.decimal_text(mixed).alias("as_decimal"), text.id_text(mixed).alias("as_id"), text.clean(F.when(k % 2 == 0, " x ").otherwise("  ")).alias("cleaned"))


@QUERIES.add("SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL ELSE event_id % 5 < 3 END AS flag FROM events")
def safe_bool_parse(spark, d):
    k = F.col("event_id") % 5
    v = F.when(k == 0, "TRUE").when(k == 1, "1").when(k == 2, "Yes").when(k == 3, "on")
    return table(spark, d, "events").select("event_id", text.loose_bool(v).alias("flag"))


@QUERIES.add("""SELECT p_partkey, CASE WHEN s BETWEEN 200 AND 299 THEN 'unknown' WHEN s IN (302, 401) THEN 'auth' WHEN s = 429 THEN 'transient' WHEN s BETWEEN 400 AND 499 THEN 'permanent' WHEN s >= 500 THEN 'transient' ELSE 'unknown' END AS category,
CASE WHEN s = 401 THEN 'auth' WHEN s = 429 THEN 'transient' WHEN s BETWEEN 400 AND 499 THEN 'permanent' ELSE 'transient' END AS api_category, s <> 401 AND (s = 429 OR s NOT BETWEEN 400 AND 499) AS retryable FROM (SELECT p_partkey, 200 + p_partkey % 350 AS s FROM part)""")
def http_category(spark, d):
    s = F.lit(200) + F.col("p_partkey") % 350
    api = errors.of_api(s)
    return table(spark, d, "part").select("p_partkey", errors.of_http(s).alias("category"), api["category"].alias("api_category"), api["retryable"].alias("retryable"))


_MESSAGES = ["Connection refused by host", "Read TIMEOUT", "401 Unauthorized", "rate limit hit", "HTTP 503", "403 Forbidden", "404 not found", "odd thing", "CommitFailedError: version conflict"]
_CATEGORIES = ["transient", "transient", "auth", "transient", "transient", "permanent", "permanent", "unknown", "transient"]


@QUERIES.add("SELECT event_id, category, category IN ('transient', 'auth', 'unknown') AS retryable, category IN ('transient', 'unknown') AND FALSE AS needs_link FROM (SELECT event_id, CASE event_id % 9 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CATEGORIES)) + " END AS category FROM events)")
def error_category(spark, d):
    m = F.element_at(F.array(*[F.lit(x) for x in _MESSAGES]), (F.col("event_id") % 9).cast("int") + 1)
    c = errors.of_text(m)
    return table(spark, d, "events").select("event_id", c.alias("category"), errors.is_retryable(c).alias("retryable"), errors.needs_new_link(m, c).alias("needs_link"))


@QUERIES.add("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'throttling' WHEN 1 THEN 'timeout' WHEN 2 THEN 'permanent' WHEN 3 THEN 'connection' WHEN 4 THEN 'auth' END AS category FROM part")
def service_codes(spark, d):
    code = F.element_at(F.array(*[F.lit(x) for x in ("40501", "OperationTimedOut", "BlobNotFound", "10054", "AADSTS50058", "other")]), (F.col("p_partkey") % 6).cast("int") + 1)
    return table(spark, d, "part").select("p_partkey", errors.of_code(code).alias("category"))


@QUERIES.add("SELECT p_partkey, least(2.0 * pow(2.0, p_partkey % 8), 60.0) AS seconds, least(2.0 * pow(2.0, p_partkey % 8), 60.0) * 0.75 AS jittered FROM part")
def backoff_schedule(spark, d):
    n = F.col("p_partkey") % 8
    return table(spark, d, "part").select("p_partkey", errors.backoff(2.0, n, 60.0).alias("seconds"), errors.backoff(2.0, n, 60.0, F.lit(0.5)).alias("jittered"))
