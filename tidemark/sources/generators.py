"""Seeded rows for tests and load: claims, their attachments, events by weight, bursts.

Every value is drawn from a digest of the seed, the row's number and a tag, so that any engine that
knows MD5 draws the same, in any order and in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST = ("Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gia", "Hal")
LAST = ("Adler", "Brook", "Cole", "Dorn", "Ernst", "Frost")
PLACES = ("Ashford 10001", "Birkdale 20002", "Coldwater 30003", "Dunmore 40004")
DAMAGE = ("water", "fire", "wind", "hail", "theft", "smoke")
#: Kind of damage -> least and greatest loss; others take the last pair.
LOSSES = {"fire": (25_000, 150_000), "water": (5_000, 50_000), "wind": (5_000, 50_000), "": (1_000, 25_000)}
DEDUCTIBLES = (500, 1000, 1500, 2000, 2500)
#: Category -> weight, suffix, least and greatest size.
FILES = {"photo": (60, "jpg", 500_000, 5_000_000), "document": (30, "pdf", 50_000, 500_000), "report": (10, "pdf", 200_000, 2_000_000)}
#: Event type -> weight.
EVENTS = {
    "PROJECT_CREATED": 15, "PROJECT_FILE_ADDED": 50, "PROJECT_MFN_ADDED": 5, "CUSTOM_TASK_ASSIGNED": 30, "CUSTOM_TASK_COMPLETED": 30,
    "POLICYHOLDER_INVITED": 15, "POLICYHOLDER_JOINED": 15, "VIDEO_COLLABORATION_INVITE_SENT": 5, "VIDEO_COLLABORATION_COMPLETED": 5,
}


def digest(seed: int, tag: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(tag), *[p.cast("string") for p in parts]))


def drawn(n: int | Column, seed: int, tag: str, *parts: Column) -> Column:
    """A whole number below n."""
    return F.conv(F.left(digest(seed, tag, *parts), F.lit(8)), 16, 10).cast("bigint") % n


def one_of(values: Sequence, seed: int, tag: str, *parts: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (drawn(len(values), seed, tag, *parts) + 1).cast("int"))


def weighted(weights: Mapping[str, int], seed: int, tag: str, *parts: Column) -> Column:
    """A name, each as often as its weight says."""
    at, low, out = drawn(sum(weights.values()), seed, tag, *parts), 0, F.lit(None).cast("string")
    for name, weight in weights.items():
        out, low = F.when((at >= low) & (at < low + weight), name).otherwise(out), low + weight
    return out


def claims(ids: DataFrame, seed: int, day: str = "2026-01-31") -> DataFrame:
    """A claim for each row of ids (column id): id, claim_id, project_id, policyholder, place, damage, loss, deductible, lost_on, reported_on."""
    k = F.col("id")
    damage = one_of(DAMAGE, seed, "damage", k)
    low, high = (F.coalesce(*[F.when(damage == d, v[i]) for d, v in LOSSES.items() if d], F.lit(LOSSES[""][i])) for i in (0, 1))
    lost = F.date_sub(F.lit(day).cast("date"), (drawn(30, seed, "lost", k) + 1).cast("int"))
    return ids.select(
        "id",
        F.concat(F.lit("CLM-"), F.upper(F.left(digest(seed, "claim", k), F.lit(8)))).alias("claim_id"),
        F.concat(F.lit("proj_"), F.left(digest(seed, "project", k), F.lit(12))).alias("project_id"),
        F.concat_ws(" ", one_of(FIRST, seed, "first", k), one_of(LAST, seed, "last", k)).alias("policyholder"),
        one_of(PLACES, seed, "place", k).alias("place"),
        damage.alias("damage"),
        (low + drawn(high - low, seed, "loss", k)).alias("loss"),
        one_of(DEDUCTIBLES, seed, "deductible", k).alias("deductible"),
        lost.alias("lost_on"),
        F.date_add(lost, drawn(4, seed, "reported", k).cast("int")).alias("reported_on"),
    )


def attachments(of: DataFrame, seed: int, base_url: str = "http://localhost:8765") -> DataFrame:
    """One to five files for each claim: project_id, media_id, category, file_name, file_size, download_url."""
    k, i = F.col("id"), F.col("i")
    each = of.select("id", "project_id", F.explode(F.sequence(F.lit(1), (drawn(5, seed, "files", k) + 1).cast("int"))).alias("i"))
    each = each.withColumn("category", weighted({c: v[0] for c, v in FILES.items()}, seed, "category", k, i))
    suffix, low, high = (F.coalesce(*[F.when(F.col("category") == c, v[j]) for c, v in FILES.items()]) for j in (1, 2, 3))
    media = F.concat(F.lit("media_"), F.left(digest(seed, "media", k, i), F.lit(12)))
    named = each.select("project_id", media.alias("media_id"), "category", F.concat("category", F.lit("_"), i.cast("string"), F.lit("."), suffix).alias("file_name"), (low + drawn(high - low, seed, "size", k, i)).alias("file_size"))
    return named.withColumn("download_url", F.concat_ws("/", F.lit(base_url), F.lit("files"), "project_id", "media_id", "file_name"))


def events(ids: DataFrame, seed: int, projects: int, weights: Mapping[str, int] = EVENTS, start: str = "2026-01-01 00:00:00", per_second: int = 1, burst_every: int = 0, burst: int = 0) -> DataFrame:
    """An event for each row of ids (column id, whole numbers): event_id, event_type, project_id, ingested_at. per_second of them share a second.

    burst_every, burst: of each burst_every events, the last `burst` come at one time.
    """
    k = F.col("id")
    place = k
    if burst_every and burst:
        held = k % burst_every
        place = F.when(held >= burst_every - burst, k - held + burst_every - burst).otherwise(k)
    at = F.timestamp_add("SECOND", F.floor(place / per_second).cast("int"), F.lit(start).cast("timestamp_ntz"))
    project = F.concat(F.lit("proj_"), F.left(digest(seed, "project", drawn(projects, seed, "of", k)), F.lit(12)))
    return ids.select(F.left(digest(seed, "event", k), F.lit(24)).alias("event_id"), weighted(weights, seed, "type", k).alias("event_type"), project.alias("project_id"), at.alias("ingested_at"))
