"""Deterministic ids as column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid5(name: Column, namespace: uuid.UUID) -> Column:
    """The version-5 UUID of a name in a namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def composite_key(*parts: Column) -> Column:
    """Parts joined by bars; nulls are left out."""
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def sha256_id(*parts: Column, length: int = 64) -> Column:
    return F.left(F.sha2(composite_key(*parts), 256), F.lit(length))
