"""Scalar functions on awkward values."""

import uuid

from pyspark.sql import functions as F

from tidemark.functions import errors, ids, text, urls


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_text(spark):
    none = F.lit(None).cast("string")
    r = one(
        spark, a=text.last_segment(F.lit("a.b.c")), b=text.json_field(F.lit("[1]"), "a"), c=text.json_field(F.lit("{bad"), "a"), d=text.comma_joined(F.array().cast("array<string>")),
        e=text.comma_joined(F.array(F.lit(""), F.lit(None))), f=text.loose_bool(F.lit("nope")), g=text.loose_bool(none), h=text.id_text(F.lit("12.0")), i=text.id_text(F.lit(" x1 ")),
        j=text.try_int(F.lit("12.7")), k=text.truncated(F.lit("x" * 501)), m=text.iso_timestamp(F.lit(" 2024-01-01T00:00:00Z ")), n=text.json_list(F.lit('{"a": "x"}'), "a"),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g) == ("c", None, None, None, "", False, None)
    assert (r.h, r.i, r.j, len(r.k), r.k[-3:], r.m, r.n) == ("12", "x1", None, 500, "...", "2024-01-01T00:00:00+00:00", None)


def test_urls(spark):
    as_of = F.lit("2024-01-02").cast("timestamp")
    r = one(
        spark, a=urls.url_problem(F.lit("https://Files.Example.com:443/x"), ["files.example.com"]), b=urls.url_problem(F.lit("ftp://h/x"), ["h"]), c=urls.url_problem(F.lit("nothing"), ["h"]),
        d=urls.file_name(F.lit("https://e.com/path/file.pdf?token=abc")), e=urls.file_type(F.lit("https://e.com/path/file.pdf?token=abc")), f=urls.extension(F.lit("https://e.com/get/u?filename=Doc.PDF")),
        g=urls.extension(F.lit("no_extension")), h=urls.content_type(F.lit("image/JPEG; charset=utf-8")), i=urls.file_problem(F.lit("a.pdf"), F.lit("image/png")), j=urls.is_private_host(F.lit("172.32.0.1")),
        k=urls.is_private_host(F.lit("fe80::1")), m=urls.presigned(F.lit("https://b/x?x-amz-date=20240101T000000Z&X-Amz-Expires=60"), as_of), n=urls.presigned(F.lit(""), as_of), o=text.redacted_url(F.lit("https://h/p?SIG=1&x=2#f")),
    )
    assert (r.a, r.b, r.c) == ("", "Invalid scheme: ftp", "No hostname in URL")
    assert (r.d, r.e, r.f, r.g, r.h) == ("file", "PDF", "pdf", None, "image/jpeg")
    assert r.i == "Content-Type 'image/png' doesn't match extension 'pdf'" and (r.j, r.k) == (False, True)
    assert r.m.is_expired and r.m.ttl_seconds == 60 and r.n.parse_error == "Empty URL" and r.o == "https://h/p?SIG=[REDACTED]&x=2#f"


def test_ids_and_errors(spark):
    ns = uuid.uuid5(uuid.NAMESPACE_DNS, "x.example")
    r = one(spark, a=ids.uuid5(F.lit("naïve:1"), ns), b=errors.of_text(F.lit("Read timeout 403")), c=errors.of_http(F.lit(418)), d=errors.of_code(F.lit("nope")), e=errors.backoff(1, F.lit(10), 30), f=errors.level_topic("p", [300, 600], F.lit(7)), g=errors.needs_new_link(F.lit("link Expired"), F.lit("transient")))
    assert r.a == str(uuid.uuid5(ns, "naïve:1"))
    assert (r.b, r.c, r.d, r.e, r.f, r.g) == ("transient", "permanent", None, 30.0, "p.retry.10m", True)
