"""Column functions over URLs, file names and content types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Extensions and content types that downloads may have, and which belong together. Fixed values.
ALLOWED_EXTENSIONS = (
    "pdf", "xml", "txt", "html", "htm", "xls", "xlsx", "doc", "docx", "esx",
    "jpg", "jpeg", "png", "gif", "bmp", "tiff", "tif", "webp", "mov", "mp4",
)
ALLOWED_CONTENT_TYPES = (
    "application/pdf", "application/xml", "text/xml", "text/plain",
    "image/jpeg", "image/png", "image/gif", "image/bmp", "image/tiff", "image/webp", "video/quicktime", "video/mp4",
)
CONTENT_TYPES_OF = {
    "pdf": ["application/pdf"], "xml": ["application/xml", "text/xml"], "txt": ["text/plain"],
    "jpg": ["image/jpeg"], "jpeg": ["image/jpeg"], "png": ["image/png"], "gif": ["image/gif"], "bmp": ["image/bmp"],
    "tiff": ["image/tiff"], "tif": ["image/tiff"], "webp": ["image/webp"], "mov": ["video/quicktime"], "mp4": ["video/mp4"],
}
#: Hosts that are never fetched, and private address ranges as patterns of dotted quads. Fixed values.
BLOCKED_HOSTS = ("127.0.0.1", "0.0.0.0", "metadata.google.internal", "metadata.aws.internal", "169.254.169.254")
PRIVATE_IPV4 = "^(10\\.|127\\.|192\\.168\\.|169\\.254\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.)[0-9.]+$"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def host(url: Column) -> Column:
    """The host in lower case, without user and port; '' where there is none."""
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, "^[^?#]*\\?([^#]*)", 1)


def parameter(url: Column, name: str) -> Column:
    """The first value of a query parameter, by its name in any case; null where it is absent or empty."""
    return F.nullif(F.regexp_extract(url, f"(?i)[?&]{name}=([^&#]*)", 1), F.lit(""))


def url_problem(url: Column, domains: list[str]) -> Column:
    """Why a URL may not be fetched under an allow-list of hosts; '' where it may."""
    h, s = host(url), scheme(url)
    return (
        F.when(url.isNull() | (url == ""), "Empty URL")
        .when(h == "", "No hostname in URL")
        .when(~s.isin("http", "https"), F.concat(F.lit("Invalid scheme: "), s))
        .when((s == "http") & (h != "localhost"), "Must be HTTPS for non-localhost, got http")
        .when(~h.isin(*[d.lower() for d in domains]), F.concat(F.lit("Domain not in allowlist: "), h))
        .otherwise("")
    )


def is_private_host(h: Column) -> Column:
    """Whether a host is blocked by name or lies in a private range; names are not resolved."""
    low = F.lower(h)
    return low.isin(*BLOCKED_HOSTS) | low.rlike(PRIVATE_IPV4) | low.rlike("^(::1|f[cd][0-9a-f]{2}:.*|fe[89ab][0-9a-f]:.*)$")


def file_name(url: Column) -> Column:
    """The last part of the path without its extension; unknown where it is empty."""
    last = F.substring_index(path(url), "/", -1)
    return F.when(last.contains("."), F.regexp_extract(last, "^(.*)\\.", 1)).when(last == "", "unknown").otherwise(last)


def file_type(url: Column) -> Column:
    """The extension in upper case, UNKNOWN without one."""
    last = F.substring_index(path(url), "/", -1)
    return F.when(last.contains("."), F.upper(F.substring_index(last, ".", -1))).otherwise("UNKNOWN")


def extension(url: Column) -> Column:
    """The lower-case extension of a file name or URL path, else of its filename, file or name parameter; null without."""
    p = path(url)
    own = F.when(p.contains("."), F.nullif(F.lower(F.substring_index(p, ".", -1)), F.lit("")))
    given = F.coalesce(*[parameter(url, n) for n in ("filename", "file", "name")])
    return F.coalesce(own, F.when(given.contains("."), F.nullif(F.lower(F.substring_index(given, ".", -1)), F.lit(""))))


def content_type(c: Column) -> Column:
    """A content type in lower case, without parameters; '' for null."""
    return F.lower(F.trim(F.substring_index(F.coalesce(c, F.lit("")), ";", 1)))


def file_problem(url: Column, given_type: Column) -> Column:
    """Why a file may not be taken, by its extension and, if given, its content type; '' where it may."""
    ext, kind = extension(url), content_type(given_type)
    fits = F.lit(True)
    for e, kinds in CONTENT_TYPES_OF.items():
        fits = F.when(ext == e, kind.isin(*kinds)).otherwise(fits)
    has_type = given_type.isNotNull() & (given_type != "")
    return (
        F.when(url.isNull() | (url == ""), "Empty filename or URL")
        .when(ext.isNull(), "No file extension found")
        .when(~ext.isin(*ALLOWED_EXTENSIONS), F.concat(F.lit("File extension '"), ext, F.lit("' not allowed")))
        .when(has_type & (kind == ""), "Invalid Content-Type header")
        .when(has_type & ~kind.isin(*ALLOWED_CONTENT_TYPES), F.concat(F.lit("Content-Type '"), kind, F.lit("' not allowed")))
        .when(has_type & ~fits, F.concat(F.lit("Content-Type '"), kind, F.lit("' doesn't match extension '"), ext, F.lit("'")))
        .otherwise("")
    )


def presigned(url: Column, as_of: Column, epoch_hosts: tuple[str, ...] = ()) -> Column:
    """struct<url_type, is_presigned, signed_at, expires_at, ttl_seconds, is_expired, parse_error> of a signed URL.

    Two forms: a date and seconds (X-Amz-Date, X-Amz-Expires), and, for the given hosts,
    milliseconds (systemDate, expires). Other URLs count as unsigned and valid.
    """
    date, seconds = parameter(url, "X-Amz-Date"), parameter(url, "X-Amz-Expires")
    start, millis = parameter(url, "systemDate"), parameter(url, "expires")
    by_epoch = F.lit(False)
    for h in epoch_hosts:
        by_epoch = by_epoch | url.contains(h)
    by_date = F.lower(url).contains("x-amz-expires") | F.lower(url).contains("x-amz-date")
    kind = F.when(url.isNull() | (url == ""), "unknown").when(by_epoch, "epoch").when(by_date, "s3").otherwise("unknown")
    signed = F.when(kind == "s3", F.try_to_timestamp(date, F.lit("yyyyMMdd'T'HHmmss'Z'"))).when(kind == "epoch", F.timestamp_millis(start.try_cast("bigint")))
    ttl_ms = F.when(kind == "s3", seconds.try_cast("bigint") * 1000).when(kind == "epoch", millis.try_cast("bigint"))
    expires = F.timestamp_millis(F.unix_millis(signed) + ttl_ms)
    problem = (
        F.when(url.isNull() | (url == ""), "Empty URL")
        .when((kind == "s3") & date.isNull(), "Missing X-Amz-Date")
        .when((kind == "s3") & seconds.isNull(), "Missing X-Amz-Expires")
        .when((kind == "epoch") & start.isNull(), "Missing systemDate")
        .when((kind == "epoch") & millis.isNull(), "Missing expires")
        .when((kind != "unknown") & expires.isNull(), "Parse error")
    )
    return F.struct(
        kind.alias("url_type"), (kind != "unknown").alias("is_presigned"), signed.alias("signed_at"), expires.alias("expires_at"),
        F.floor(ttl_ms / 1000).alias("ttl_seconds"), F.coalesce(as_of >= expires, F.lit(False)).alias("is_expired"), problem.alias("parse_error"),
    )


def blob_path(subtype: Column, trace_id: Column, assignment_id: Column, url: Column, version: Column) -> Column:
    """{subtype}/{assignment}/{trace}/{file}; the file's prefix depends on the subtype."""
    kind = file_type(url)
    name = F.when(kind != "UNKNOWN", F.concat(file_name(url), F.lit("."), F.lower(kind))).otherwise(file_name(url))
    middle = F.when(subtype == "firstNoticeOfLossReceived", "_FNOL_").when(subtype == "estimatePackageReceived", F.concat(F.lit("_"), F.coalesce(F.nullif(version, F.lit("")), F.lit("unknown")), F.lit("_"))).otherwise("_")
    return F.concat_ws("/", subtype, assignment_id, trace_id, F.concat(assignment_id, middle, name))


def under(base: Column, relative: Column) -> Column:
    """A relative path below a base without doubled slashes."""
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(relative, F.lit("/")))


def media_path(project: Column, name: Column) -> Column:
    return F.concat(project, F.lit("/media/"), name)


def safe_part(c: Column) -> Column:
    """A path part: blanks and slashes as underscores."""
    return F.translate(c, " /\\", "___")


def store_parts(c: Column) -> Column:
    """struct<container, account, path> of container@account store addresses."""
    pattern = "^abfss?://([^@]+)@([^/]+)/?(.*)$"
    return F.struct(*[F.regexp_extract(c, pattern, i + 1).alias(n) for i, n in enumerate(("container", "account", "path"))])


def table_name(c: Column, known: tuple[str, ...]) -> Column:
    """The first known name that a path holds, else its last part, else default."""
    low, out = F.lower(c), None
    for k in known:
        out = F.when(low.contains(k), k) if out is None else out.when(low.contains(k), k)
    last = F.coalesce(F.nullif(F.substring_index(F.rtrim(c, F.lit("/")), "/", -1), F.lit("")), F.lit("default"))
    return out.otherwise(last) if out is not None else last
