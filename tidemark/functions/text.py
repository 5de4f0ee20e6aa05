"""Column functions over strings and JSON text. Nulls give null unless stated otherwise."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_segment(c: Column, dot: str = ".") -> Column:
    """What follows the last dot; the whole string where there is none."""
    return F.substring_index(c, dot, -1)


def json_field(c: Column, *keys: str) -> Column:
    """The scalar or JSON text at a path of keys; null for invalid JSON, missing keys and null values."""
    return F.get_json_object(c, "$" + "".join(f".{k}" for k in keys))


def json_list(c: Column, *keys: str) -> Column:
    """The list at a path as array<string>; null where it is absent or not a list."""
    text = json_field(c, *keys)
    return F.when(F.substring(text, 1, 1) == "[", F.from_json(text, "array<string>"))


def kept_items(items: Column) -> Column:
    """The items that are not null or empty."""
    return F.filter(items, lambda x: x.isNotNull() & (x != ""))


def comma_joined(items: Column) -> Column:
    """Items joined by commas; null for an empty or missing list, '' if all items are empty."""
    return F.when(F.size(items) > 0, F.array_join(kept_items(items), ","))


def clean(c: Column) -> Column:
    """Trimmed text, null if empty."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def first_clean(*cs: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[clean(c) for c in cs])


def id_text(c: Column) -> Column:
    """Text of an id: whole numbers without fraction, other text trimmed, null if empty."""
    number = c.cast("string").try_cast("double")
    whole = number.isNotNull() & (number == F.floor(number)) & (F.abs(number) < F.lit(1e15))
    return F.when(whole, number.cast("bigint").cast("string")).otherwise(clean(c))


def loose_bool(c: Column) -> Column:
    """true, 1 and yes in any case are true; every other non-null text is false."""
    return F.when(c.isNotNull(), F.lower(c.cast("string")).isin("true", "1", "yes"))


def try_int(c: Column) -> Column:
    return c.cast("string").try_cast("bigint")


def try_int32(c: Column) -> Column:
    """Null where the number does not fit 32 bits."""
    return c.cast("string").try_cast("int")


def try_float(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def decimal_text(c: Column) -> Column:
    """The text itself where it is a decimal number, else null."""
    return F.when(F.trim(c).try_cast("decimal(38,10)").isNotNull(), F.trim(c))


def iso_timestamp(c: Column) -> Column:
    """Trimmed timestamp text with Z written as +00:00; no validation."""
    return F.replace(clean(c), F.lit("Z"), F.lit("+00:00"))


def truncated(c: Column, most: int = 500) -> Column:
    """Text of at most `most` characters, the last three of a longer one being dots."""
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most - 3)), F.lit("..."))).otherwise(c)


#: Query parameters whose values are hidden. Fixed values.
SENSITIVE_PARAMS = (
    "sig", "signature", "sv", "se", "st", "sp", "sr", "spr",
    "x-amz-signature", "x-amz-credential", "x-amz-security-token",
    "token", "access_token", "api_key", "apikey", "key",
    "secret", "password", "pwd", "auth", "authorization",
)


def redacted_url(c: Column) -> Column:
    """A URL with the values of sensitive query parameters replaced by [REDACTED]."""
    return F.regexp_replace(c, f"(?i)([?&](?:{'|'.join(SENSITIVE_PARAMS)})=)[^&#]*", "$1[REDACTED]")


#: Assignments in messages whose values are hidden, in this order. Fixed values.
MESSAGE_KEYS = ("sig", "sv", "se", "st", "token", "key", "password", "secret", "x-amz-signature", "x-amz-credential")


def redacted_message(c: Column, most: int = 500) -> Column:
    """A message without the values of sensitive keys, bearer tokens and URL parameters, cut to `most` characters."""
    out = c
    for key in MESSAGE_KEYS:
        out = F.regexp_replace(out, f"(?i){key}=[^&\\s\"']+", f"{key}=[REDACTED]")
    out = F.regexp_replace(out, "(?i)bearer\\s+[a-zA-Z0-9\\-_.]+", "bearer [REDACTED]")
    out = F.regexp_replace(out, "(?i)api[_-]?key[=:]\\s*[^\\s\"'&]+", "api_key=[REDACTED]")
    return truncated(redacted_url(out), most)


def json_object(data: Column) -> Column:
    """JSON text as a variant, parsed once a row; an empty object where it is null, broken or repeats a key."""
    return F.coalesce(F.try_parse_json(data), F.parse_json(F.lit("{}")))


def at_paths(value: Column, paths: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Columns of a variant, given at run time: name -> (path like a.b[0].c, type). Missing values and misfits are null."""
    return [F.try_variant_get(value, path if path.startswith("$") else f"$.{path}", kind).alias(name) for name, (path, kind) in paths.items()]
