"""JSON held in strings: compared by meaning, so always in canonical form."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(c: Column) -> Column:
    """Keys sorted, numbers normalised: equal values become equal strings."""
    return F.to_json(F.parse_json(c))


def same(a: Column, b: Column) -> Column:
    return canonical(a).eqNullSafe(canonical(b))


def field(c: Column, name: str) -> Column:
    return F.get_json_object(c, f"$.{name}")


def keys(c: Column) -> Column:
    return F.json_object_keys(c)


_REFUSALS = "array<struct<code:string,stage:string,message:string,detail:string>>"


def has_code(refusals: Column, code: str) -> Column:
    """Whether a JSON array of refusals holds one with this code."""
    listed = F.when(F.ltrim(refusals).startswith("["), F.from_json(refusals, _REFUSALS))
    return F.coalesce(F.exists(listed, lambda r: r["code"] == code), F.lit(False))


def codes_valid(refusals: Column, vocabulary: tuple[str, ...]) -> Column:
    """An array of objects, each with a code from the vocabulary; anything malformed is false."""
    rows = F.from_json(refusals, "array<map<string,string>>")
    known = F.forall(rows, lambda r: F.coalesce(r["code"].isin(*vocabulary), F.lit(False)))
    return F.coalesce(F.when(F.ltrim(refusals).startswith("["), known), F.lit(False))


def election_consistent(election: Column, refusals: Column) -> Column:
    """A required election is missing, an unsupported one is there; any other refusal says nothing of it."""
    return ~((has_code(refusals, "ELECTION_REQUIRED") & election.isNotNull()) | (has_code(refusals, "ELECTION_NOT_SUPPORTED") & election.isNull()))


def payload_text(payload: dict) -> str:
    """The text over which a payload's hash is taken: sorted keys, ', ' and ': ', ASCII only."""
    return json.dumps(payload, sort_keys=True)


def payload_hash(payload: dict) -> str:
    return hashlib.sha256(payload_text(payload).encode()).hexdigest()
