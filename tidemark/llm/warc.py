"""WARC archives (operator 13): pages to records, records to captures.

Writing: each page gives a request, a response and a metadata record, tied by WARC-Concurrent-To. Of
pages with equal payloads, one is a response and the others are revisits, which refer to it and carry
no payload. Each task writes gzip members, one a record, into files of its own attempt; the manifest
names sections of bounded size that begin at a record, so that reading spreads over tasks whatever the
files' sizes. Reading: a section's records become rows; requests and metadata meet their response
through the concurrent-to identifiers, and one nested row comes out for each capture.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import shared

#: Bytes of a section that one task reads at a time, and of a file, about.
SECTION, FILE = 1 << 25, 1 << 30
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, start long, stop long, n_records long"
RECORD = "record_id string, type string, target_uri string, date string, concurrent_to array<string>, refers_to string, content_type string, header string, fields map<string,string>, declared_digest string, payload binary, payload_bytes long, payload_digest string"
CAPTURES = ("response", "revisit", "resource")
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")


def marked(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, sha1, rid, kind (response or revisit) and refers (the response's rid) of each page.

    Of rows with equal payloads of at least `least` bytes, that with the largest page_id is the
    response; of rows that tie, one. Null ids are smallest, a null payload is empty.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"))
    rows = shared.written(rows.withColumn("rid", F.uuid()), "pages")  # names that later steps agree on
    shared_by = rows.where(F.octet_length("payload") >= least).groupBy("sha1").agg(F.max(F.struct("page_id", "rid")).alias("first"), F.count("*").alias("n"))
    # Written first, so that Spark knows the size of this side when it plans the join.
    firsts = shared.written(shared_by.where("n > 1").select(F.col("sha1").alias("__sha1"), F.col("first.rid").alias("__rid")), "firsts")
    both = rows.join(firsts, (F.col("sha1") == F.col("__sha1")) & (F.octet_length("payload") >= least), "left")
    again = F.col("__rid").isNotNull() & (F.col("__rid") != F.col("rid"))
    return both.select(*rows.columns, F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("__rid")).alias("refers"))


def record(kind: str, rid: str, date: str, content_type: str, content: bytes, url: str | None = None, more: Sequence[tuple[str, str]] = ()) -> bytes:
    """One WARC record. Control characters and spaces of a URL are percent-encoded; a missing one is left out."""
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{rid}>"), ("WARC-Date", date), *more, ("Content-Type", content_type), ("Content-Length", str(len(content)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
    if url is not None:
        head += b"WARC-Target-URI: " + _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url.encode()) + b"\r\n"
    return b"WARC/1.1\r\n" + head + b"\r\n" + content + b"\r\n\r\n"


def transaction(row: dict, date: str) -> list[bytes]:
    """The records of a page: request, response or revisit, metadata."""
    rid, url, payload = row["rid"], row["url"], row["payload"].encode()
    tie = ("WARC-Concurrent-To", f"<urn:uuid:{rid}>")
    path = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "", url or "") or "/"
    request = b"GET " + _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], path.encode()) + b" HTTP/1.1\r\n\r\n"
    answer = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    digest = [("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(row['sha1'])).decode()}")]
    if row["kind"] == "revisit":
        digest += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{row['refers']}>")]
    facts = b"" if row["page_id"] is None else b"page_id: %d\r\n" % row["page_id"]
    own = uuid.UUID(rid)
    return [
        record("request", str(uuid.uuid5(own, "request")), date, "application/http;msgtype=request", request, url, [tie]),
        record(row["kind"], rid, date, "application/http;msgtype=response", answer + (payload if row["kind"] == "response" else b""), url, digest),
        record("metadata", str(uuid.uuid5(own, "metadata")), date, "application/warc-fields", facts, url, [tie]),
    ]


def write(rows: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """Writes the records of marked() rows below a folder and returns the manifest: path, start, stop, n_records."""
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inside = pafs.FileSystem.from_uri(folder)
        out, path, at, start, n = None, None, 0, 0, 0

        def section() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [path], "start": pa.array([start], pa.int64()), "stop": pa.array([at], pa.int64()), "n_records": pa.array([n], pa.int64())})

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if out is None:
                    store.create_dir(inside, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path, at, start, n = store.open_output_stream(f"{inside}/{name}", compression=None), f"{folder}/{name}", 0, 0, 1
                    info = gzip.compress(record("warcinfo", str(uuid.uuid4()), date, "application/warc-fields", b"format: WARC File Format 1.1\r\n"), 6, mtime=0)
                    out.write(info)
                    at += len(info)
                for text in transaction(row, date):
                    member = gzip.compress(text, 6, mtime=0)
                    out.write(member)
                    at, n = at + len(member), n + 1
                if at - start >= SECTION:
                    yield section()
                    start, n = at, 0
                if at >= FILE:
                    if n:
                        yield section()
                    out.close()
                    out = None
        if out is not None:
            out.close()
            if n:
                yield section()

    return shared.written(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def archives(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A manifest of given archives, plain or gzip, each one section."""
    return spark.createDataFrame([(p, 0, None, None) for p in paths], MANIFEST)


def parsed(stream, where: str, keep: bool) -> Iterator[dict]:
    """The records of a stream of bytes; payloads are kept or only counted and hashed."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{where}: no WARC record: {line[:40]!r}")
        heads: list[tuple[str, str]] = []
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and heads:  # a folded line
                heads[-1] = (heads[-1][0], heads[-1][1] + " " + line.decode("utf-8", "replace").strip())
            else:
                name, _, value = line.decode("utf-8", "replace").partition(":")
                heads.append((name.strip().lower(), value.strip()))
        first = dict(reversed(heads))
        left = int(first.get("content-length", 0))
        kind, mime, http, fields = first.get("warc-type", ""), first.get("content-type", ""), None, None
        if mime.startswith("application/http"):
            lines = []
            while left:
                line = stream.readline(left)
                left -= len(line)
                if not line.strip() or not line:
                    break
                lines.append(line)
            http = b"".join(lines).decode("utf-8", "replace")
        elif mime.startswith("application/warc-fields"):
            text, left = stream.read(left).decode("utf-8", "replace"), 0
            fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in text.splitlines() if x.strip())}
        sha, size, body = hashlib.sha1(usedforsecurity=False), left, []
        while left:
            data = stream.read(min(left, 1 << 20))
            if not data:
                raise ValueError(f"{where}: a record ends early")
            left -= len(data)
            sha.update(data)
            if keep:
                body.append(data)
        plain = lambda v: None if v is None else v.strip("<>").removeprefix("urn:uuid:")
        yield {
            "record_id": plain(first.get("warc-record-id")), "type": kind, "target_uri": first.get("warc-target-uri"), "date": first.get("warc-date"),
            "concurrent_to": [plain(v) for k, v in heads if k == "warc-concurrent-to"], "refers_to": plain(first.get("warc-refers-to")), "content_type": mime, "header": http,
            "fields": fields, "declared_digest": (first.get("warc-payload-digest") or "").rpartition(":")[2] or None, "payload": b"".join(body) if keep else None, "payload_bytes": size, "payload_digest": base64.b32encode(sha.digest()).decode(),
        }


def records(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of a manifest's sections. Without payloads, these are only counted and hashed.

    payload_bytes and payload_digest are of what the record holds; declared_digest is what it says. A
    file that is no WARC, or that ends inside a record, is an error.
    """
    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                store, path = pafs.FileSystem.from_uri(part["path"])
                if part["stop"] is None:
                    raw = io.BufferedReader(store.open_input_stream(path, compression=None))
                else:
                    with store.open_input_file(path) as file:
                        raw = io.BufferedReader(io.BytesIO(file.read_at(part["stop"] - part["start"], part["start"])))
                stream = gzip.GzipFile(fileobj=raw) if raw.peek(2)[:2] == b"\x1f\x8b" else raw
                held, size = [], 0
                for row in parsed(stream, f"{part['path']} from {part['start']}", payloads):
                    held.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size >= 1 << 24 or len(held) >= 10_000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "path", "start").mapInArrow(run, RECORD)


def captures(rows: DataFrame) -> DataFrame:
    """One nested row for each capture: record_id, capture (the response, revisit or resource), requests, metadata.

    A request or metadata record belongs to the capture that it names as concurrent, or that names it,
    or that of the request which it names. Those that reach no capture give no row. requests and
    metadata are in order of their ids; a capture without any has empty arrays. Repeated links count once.
    """
    names = [c for c in rows.columns if c != "record_id"]
    main = rows.where(F.col("type").isin(*CAPTURES)).select("record_id", F.struct(*names).alias("capture"))
    # Written: parsed once, and of a size that Spark knows when it plans the joins.
    light = shared.written(rows.select("record_id", "type", "concurrent_to", "date", "header", "fields"), "records")
    side = light.where(F.col("type").isin("request", "metadata"))
    said = side.select(F.col("record_id").alias("of"), "type", F.explode("concurrent_to").alias("to"))
    heard = light.where(F.col("type").isin(*CAPTURES)).select(F.explode("concurrent_to").alias("of"), F.col("record_id").alias("to"))
    through = said.where("type = 'metadata'").alias("m").join(said.where("type = 'request'").alias("r"), F.col("m.to") == F.col("r.of")).select("m.of", "r.to")
    ties = said.select("of", "to").unionByName(heard).unionByName(through).distinct()
    parts = side.select(F.col("record_id").alias("of"), "type", F.struct("record_id", "date", "header", "fields").alias("part"))
    own = ties.join(parts, "of").groupBy(F.col("to").alias("__to"))
    listed = own.agg(*[F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.struct(F.col("part.record_id").alias("id"), F.col("part.date").alias("date"), F.col("part.header").alias("header"), F.to_json("part.fields").alias("fields"))))).alias(name) for kind, name in (("request", "requests"), ("metadata", "metadata"))])
    both = main.join(listed, F.col("record_id") == F.col("__to"), "left")
    return both.select("record_id", "capture", *[F.coalesce(c, F.array()).alias(c) for c in ("requests", "metadata")])


def op13_warc_captures(spark, sf_dir: str) -> DataFrame:
    """All pages, written as WARC archives and read back, one row a page.

    A null html is an empty payload; null and repeated ids and repeated rows each have their record.
    payload_bytes and payload_digest of a revisit are those of the response that it refers to and of
    its own header. An empty table gives no rows; other columns are ignored.
    """
    pages = shared.table(spark, sf_dir, "pages")
    manifest = write(marked(pages), shared.new_path(spark, "warc"))
    each = captures(shared.written(records(manifest, payloads=False), "records"))
    page = F.get_json_object(F.col("metadata")[0]["fields"], "$.page_id").cast("long")
    c = F.col("capture")
    rows = shared.written(each.select("record_id", page.alias("page_id"), c["type"].alias("record_type"), c["refers_to"].alias("__refers"), c["payload_bytes"].alias("n"), c["payload_digest"].alias("own"), c["declared_digest"].alias("said")), "captures")
    first = rows.where("record_type = 'response'").select(F.col("record_id").alias("__refers"), F.col("page_id").alias("__page"), F.col("n").alias("__n"))
    seen = rows.where("record_type = 'revisit'").join(first, "__refers", "left")
    again = seen.select("page_id", F.col("__n").alias("payload_bytes"), F.col("said").alias("payload_digest"), "record_type", F.col("__page").alias("refers_to"))
    return rows.where("record_type = 'response'").select("page_id", F.col("n").alias("payload_bytes"), F.col("own").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(again)


def oracle() -> str:
    return """WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) AS n, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, i // 4 * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1, 1) FOR i IN range(32)], '') AS payload_digest,
CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n > 1 THEN top END AS refers_to FROM r"""
