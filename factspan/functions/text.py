"""String expressions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"(?U)^\s+|\s+$"
_UUID = r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
_SHA256 = r"^[0-9a-f]{64}$"


def strip_all(c: Column) -> Column:
    """``c`` without white space of any kind at its ends; ``trim`` removes spaces only."""
    return F.regexp_replace(c, _EDGES, "")


def is_blank(c: Column) -> Column:
    """Null, empty or white space only. Never null."""
    return c.isNull() | (F.length(strip_all(c)) == 0)


def canonical_identifier(c: Column) -> Column:
    """Stripped, without one leading apostrophe (a spreadsheet's text mark), stripped again."""
    bare = strip_all(c)
    return strip_all(F.when(bare.startswith("'"), F.substring(bare, 2, 1 << 30)).otherwise(bare))


def unresolvable_reason(c: Column) -> Column:
    """Why an identifier can't be resolved: 'blank', 'placeholder' (it has a '?'), or null if it can."""
    plain = canonical_identifier(c)
    return F.when(is_blank(plain), "blank").when(plain.contains(F.lit("?")), "placeholder")


def normalise_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def first_words(c: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(normalise_space(c), " "), 1, n), " ")


def media_type(header: Column) -> Column:
    """The type of a Content-Type header without its parameters."""
    return F.coalesce(F.nullif(F.lower(F.trim(F.element_at(F.split(header, ";"), 1))), F.lit("")), F.lit("application/octet-stream"))


def is_uuid(c: Column) -> Column:
    return F.lower(c).rlike(_UUID)


def is_sha256(c: Column) -> Column:
    return c.rlike(_SHA256)


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def object_key(digest: Column) -> Column:
    """Where content with this SHA-256 lies: sha256/<first two digits>/<digest>."""
    return F.concat_ws("/", F.lit("sha256"), F.substring(digest, 1, 2), digest)


def snapshot_id(source: Column, digest: Column) -> Column:
    return F.concat_ws(":", source, F.lit("sha256"), digest)


def derived_id(*parts: Column) -> Column:
    """An id that a recomputation gives again: the UUID-shaped start of a hash of a natural key."""
    h = F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
