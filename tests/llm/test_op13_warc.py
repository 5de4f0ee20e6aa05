"""Archives against the pages they were made from, against SQL, and against hand-made archives."""

import base64
import gzip
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import shared, warc

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "https://a.example/x?q=1 2", "<p>one</p>"),
    (2, "http://b.example", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (3, "https://c.example/\u00e9\r\nHost: x", "caf\u00e9\r\n\r\nWARC/1.1\r\n\u6f22"),
    (4, "u", None),
    (5, "u", ""),
    (None, "u", "<p>one</p>"),
    (None, None, "alone"),
    (7, "u", "same"),
    (7, "u", "same"),
    (7, "v", "same"),
    (8, "u", "long " * 100_000),
]


def plain(rows, least=0):
    groups, out = {}, []
    for page, _url, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    for body, pages in groups.items():
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first, *again = sorted(pages, key=lambda p: (p is not None, p or 0), reverse=True)
        out.append((first, len(body), sha, "response", None))
        small = len(body) < least
        out += [(p, len(body), sha, "response" if small else "revisit", None if small else first) for p in again]
    return sorted(out, key=str)


def run(spark, df, folder):
    df.write.parquet(f"{folder}/pages.parquet")
    out = warc.op13_warc_captures(spark, str(folder))
    assert out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("section,file", [(1 << 25, 1 << 30), (1, 1), (600, 1500)])
def test_pages_come_back(spark, tmp_path, monkeypatch, section, file):
    monkeypatch.setattr(warc, "SECTION", section)
    monkeypatch.setattr(warc, "FILE", file)
    df = spark.createDataFrame(ROWS, PAGES)
    got = run(spark, df.withColumn("kind", F.lit("x")).withColumn("rid", F.lit(1)), tmp_path)
    assert got == plain(ROWS)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(con.execute(warc.oracle()).fetchall(), key=str) == got


def test_many_copies_and_a_least_size(spark):
    rows = [(i, "u", "x" * (i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, PAGES)
    manifest = warc.write(warc.marked(df, least=2), shared.new_path(spark, "w"), "2026-01-01T00:00:00Z")
    kinds = warc.records(manifest).groupBy("type", "payload_bytes").count().collect()
    assert {(r.type, r.payload_bytes): r["count"] for r in kinds if r.type in warc.CAPTURES} == {("response", 0): 100, ("response", 1): 100, ("response", 2): 1, ("revisit", 0): 99}
    assert manifest.agg(F.sum("n_records")).first()[0] - manifest.select("path").distinct().count() == 900


def test_captures_hold_their_transaction(spark):
    df = spark.createDataFrame(ROWS, PAGES)
    manifest = warc.write(warc.marked(df), shared.new_path(spark, "w"), "2026-01-01T00:00:00Z")
    got = warc.captures(warc.records(manifest)).collect()
    assert len(got) == len(ROWS) and all(len(r.requests) == len(r.metadata) == 1 for r in got)
    payloads = {r.capture.payload.decode() for r in got if r.capture.type == "response"}
    assert payloads == {h or "" for _, _, h in ROWS}
    odd = next(r for r in got if r.capture.payload_bytes > 10 and "caf" in r.capture.payload.decode())
    assert odd.capture.target_uri == "https://c.example/\u00e9%0D%0AHost:%20x" and odd.requests[0].header.startswith("GET /")
    assert all(r.capture.declared_digest == r.capture.payload_digest for r in got if r.capture.type == "response")


def made(*records):
    return b"".join(b"WARC/1.0\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in heads) + b"Content-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n" for heads, body in records)


@pytest.mark.parametrize("zipped", [False, True])
def test_archives_of_others(spark, tmp_path, zipped):
    http = b"HTTP/1.0 200\r\nX: y\r\n\r\nbody"
    text = made(
        ([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:0>")], b""),
        ([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Concurrent-To", "<urn:uuid:2>"), ("Content-Type", "application/http; msgtype=response")], http),
        ([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:uuid:2>"), ("Content-Type", "application/http")], b"GET / HTTP/1.0\r\n\r\n"),
        ([("WARC-Type", "metadata"), ("WARC-Record-ID", "<urn:uuid:3>"), ("WARC-Concurrent-To", "<urn:uuid:4>"), ("warc-concurrent-to", "<urn:uuid:1>"), ("Content-Type", "application/warc-fields")], b"a: b\r\n"),
        ([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:uuid:4>"), ("WARC-Concurrent-To", "<urn:uuid:5>"), ("Content-Type", "application/http")], b"GET /z HTTP/1.0\r\n\r\n"),
        ([("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:uuid:5>"), ("Content-Type", "text/plain")], b"plain\r\n\r\n"),
        ([("WARC-Type", "metadata"), ("WARC-Record-ID", "<urn:uuid:6>"), ("WARC-Concurrent-To", "<urn:uuid:99>")], b"x"),
    )
    path = tmp_path / "a.warc"
    path.write_bytes(gzip.compress(text) if zipped else text)
    got = {r.record_id: r for r in warc.captures(warc.records(warc.archives(spark, [f"file://{path}"]))).collect()}
    assert sorted(got) == ["1", "5"]
    assert bytes(got["1"].capture.payload) == b"body" and bytes(got["5"].capture.payload) == b"plain\r\n\r\n"
    assert [q.id for q in got["1"].requests] == ["2"] and [m.id for m in got["1"].metadata] == ["3"]
    assert [q.id for q in got["5"].requests] == ["4"] and [m.id for m in got["5"].metadata] == ["3"]  # through the request


def test_a_broken_archive_is_an_error(spark, tmp_path):
    (tmp_path / "b.warc").write_bytes(made(([("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:uuid:1>")], b"long body"))[:-9])
    with pytest.raises(Exception, match="ends early"):
        warc.records(warc.archives(spark, [f"file://{tmp_path}/b.warc"])).collect()


def test_empty_table(spark, tmp_path):
    assert run(spark, spark.createDataFrame([], PAGES), tmp_path) == []
