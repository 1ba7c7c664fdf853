"""JSON Schema as columns over VARIANT: a schema is compiled once, documents are checked where they lie.

Compiled are the keywords that packs need: type, enum, required, properties, additionalProperties,
items, minItems, minLength, pattern, format (date, uri) and $ref into $defs. A keyword that isn't
known is an error when the schema is compiled, never passed over. The result is a row for each
breach, with its path ($.sources[2].licence) and the keyword that it breaks.

A null document is a breach of ``document``, as is one that isn't JSON. Members that are null are
of the type null, as JSON says.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspan.plans.vocabulary import ENUMS

#: Keywords that say nothing about a document.
_SILENT = ("$schema", "$id", "$defs", "title", "description")
_KNOWN = ("type", "enum", "required", "properties", "additionalProperties", "items", "minItems", "minLength", "pattern", "format", "$ref")
_DATE, _URI = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$", r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s]+$"

#: The shapes of a jurisdiction's pack files.
_TEXT, _DAY = {"type": "string"}, {"type": ["string", "null"], "format": "date"}
SOURCES = {
    "type": "object", "required": ["jurisdiction", "pack_version", "sources"], "additionalProperties": False,
    "properties": {
        "jurisdiction": _TEXT, "pack_version": {"type": "string", "pattern": r"^[a-z0-9_]+@[0-9]+\.[0-9]+\.[0-9]+$"},
        "portals": {"type": "object", "additionalProperties": {"type": "string", "format": "uri"}},
        "sources": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/source"}},
    },
    "$defs": {"source": {
        "type": "object", "required": ["id", "display_name", "steward", "method", "licence", "phase_status", "phase_status_reason", "supplies"], "additionalProperties": False,
        "properties": {
            "id": _TEXT, "display_name": _TEXT, "steward": _TEXT, "method": {"type": "string", "enum": list(ENUMS["access_method"])}, "licence": _TEXT,
            "phase_status": {"type": "string", "enum": list(ENUMS["source_phase_status"])}, "phase_status_reason": {"type": "string", "minLength": 1}, "cadence_stated": _TEXT,
            "earliest_record_date": _DAY, "supplies": {"type": "array", "items": _TEXT}, "url_verified_at": _DAY, "active": {"type": "boolean"}, "excluded": {"type": "boolean"}, "notes": _TEXT,
        },
    }},
}

_FAULT = "array<struct<path:string,breaks:string>>"


def _none() -> Column:
    return F.array().cast(_FAULT)


def _fault(when: Column, path: Column, keyword: str) -> Column:
    return F.when(when, F.array(F.struct(path.alias("path"), F.lit(keyword).alias("breaks")))).otherwise(_none())


def _is(kind: Column, name: str) -> Column:
    """Whether a variant's type, as Spark names it, is the type of that name in JSON Schema."""
    numbers = kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return {
        "object": kind.startswith("OBJECT"), "array": kind.startswith("ARRAY"), "string": kind == "STRING", "boolean": kind == "BOOLEAN",
        "null": kind == "VOID", "integer": kind == "BIGINT", "number": (kind == "BIGINT") | numbers,
    }[name]


def _compiled(node: dict, root: dict, v: Column, path: Column, depth: int = 0) -> Column:
    if "$ref" in node:
        if depth > 20:
            raise ValueError("a schema refers to itself")
        target = root
        for step in node["$ref"].removeprefix("#/").split("/"):
            target = target[step]
        return _compiled(target, root, v, path, depth + 1)
    if unknown := set(node) - {*_SILENT, *_KNOWN}:
        raise ValueError(f"keywords that aren't compiled: {sorted(unknown)}")
    kind = F.schema_of_variant(v)
    get = lambda as_: F.try_variant_get(v, "$", as_)
    found = []
    if "type" in node:
        allowed = [node["type"]] if isinstance(node["type"], str) else node["type"]
        found.append(_fault(~reduce(Column.__or__, [_is(kind, t) for t in allowed]), path, "type"))
    text, is_text = get("string"), _is(kind, "string")
    if "enum" in node:
        found.append(_fault(~(is_text & text.isin(*node["enum"])), path, "enum"))
    if "minLength" in node:
        found.append(_fault(is_text & (F.char_length(text) < node["minLength"]), path, "minLength"))
    if "pattern" in node:
        found.append(_fault(is_text & ~text.rlike(node["pattern"]), path, "pattern"))
    if "format" in node:
        found.append(_fault(is_text & ~text.rlike({"date": _DATE, "uri": _URI}[node["format"]]), path, "format"))
    is_object, members = _is(kind, "object"), get("map<string,variant>")
    has = lambda k: is_object & F.coalesce(F.map_contains_key(members, F.lit(k)), F.lit(False))
    found += [_fault(is_object & ~has(k), F.concat(path, F.lit(f".{k}")), "required") for k in node.get("required", ())]
    own = node.get("properties", {})
    found += [F.when(has(k), _compiled(sub, root, members[F.lit(k)], F.concat(path, F.lit(f".{k}")), depth)).otherwise(_none()) for k, sub in own.items()]
    if (more := node.get("additionalProperties", True)) is not True:
        others = F.filter(F.map_entries(members), lambda e: ~e["key"].isin(*own)) if own else F.map_entries(members)
        at = lambda e: F.concat(path, F.lit("."), e["key"])
        each = (lambda e: _fault(F.lit(True), at(e), "additionalProperties")) if more is False else (lambda e: _compiled(more, root, e["value"], at(e), depth))
        found.append(F.when(is_object, F.flatten(F.transform(others, each))).otherwise(_none()))
    is_array, items = _is(kind, "array"), get("array<variant>")
    if "minItems" in node:
        found.append(_fault(is_array & (F.size(items) < node["minItems"]), path, "minItems"))
    if "items" in node:
        each = lambda x, i: _compiled(node["items"], root, x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), depth)
        found.append(F.when(is_array, F.flatten(F.transform(items, each))).otherwise(_none()))
    return F.concat(*found) if found else _none()


def breaches(documents: DataFrame, schema: dict, key: str, document: str) -> DataFrame:
    """(key, path, breaks): a row for each place of a JSON document that breaks a keyword of the schema."""
    rows = documents.select(F.col(key).alias("_key"), F.try_parse_json(F.col(document)).alias("_v"))
    faults = F.when(F.col("_v").isNull(), _fault(F.lit(True), F.lit("$"), "document")).otherwise(_compiled(schema, schema, F.col("_v"), F.lit("$")))
    return rows.select(F.col("_key").alias(key), F.inline(faults))
