"""Schemas and differences of JSON documents."""

import copy
import json
import random

import pytest

from factspan.operators import deferral, difference, golden, schema
from factspan.sources import stream

SOURCE = {"id": "j.a", "display_name": "A", "steward": "s", "method": "bulk", "licence": "open", "phase_status": "active", "phase_status_reason": "r", "supplies": ["x", "y"], "active": True, "earliest_record_date": None, "url_verified_at": "2026-01-31"}
PACK = {"jurisdiction": "j", "pack_version": "j@0.1.0", "portals": {"main": "https://example.org/x"}, "sources": [SOURCE, dict(SOURCE, id="j.b")]}


def pack(**change):
    out = copy.deepcopy(PACK)
    for path, value in change.items():
        at = out
        *way, last = path.split("__")
        for step in way:
            at = at[int(step[1:])] if step[0] == "n" and step[1:].isdigit() else at[step]
        if value is KeyError:
            del at[last]
        else:
            at[last] = value
    return out


CASES = [
    (PACK, []), (pack(pack_version="1.0"), [("$.pack_version", "pattern")]), (pack(jurisdiction=KeyError), [("$.jurisdiction", "required")]), (pack(more=1), [("$.more", "additionalProperties")]),
    (pack(sources=[]), [("$.sources", "minItems")]), (pack(sources={}), [("$.sources", "type")]), (pack(portals__main="no uri"), [("$.portals.main", "format")]), (pack(portals__other=3), [("$.portals.other", "type")]),
    (pack(sources__n1__method="fax", sources__n1__x=1), [("$.sources[1].method", "enum"), ("$.sources[1].x", "additionalProperties")]), (pack(sources__n0__supplies=["a", 2, None]), [("$.sources[0].supplies[1]", "type"), ("$.sources[0].supplies[2]", "type")]),
    (pack(sources__n0__phase_status_reason=""), [("$.sources[0].phase_status_reason", "minLength")]), (pack(sources__n0__url_verified_at="31.1.2026", sources__n0__active="yes"), [("$.sources[0].active", "type"), ("$.sources[0].url_verified_at", "format")]),
    ([], [("$", "type")]), ("x", [("$", "type")]),
]


def test_packs_are_held_against_their_schema(spark, frame):
    rows = [(k, json.dumps(d)) for k, (d, _) in enumerate(CASES)] + [(100, "{"), (101, None)]
    got = sorted(map(tuple, schema.breaches(frame(rows, "id long, doc string"), schema.SOURCES, "id", "doc").collect()))
    assert got == sorted([(k, *b) for k, (_, bs) in enumerate(CASES) for b in bs] + [(100, "$", "document"), (101, "$", "document")])
    for bad in ({"maxItems": 1}, {"$ref": "#/$defs/a", "$defs": {"a": {"$ref": "#/$defs/a"}}}):
        with pytest.raises(ValueError):
            schema.breaches(frame(rows, "id long, doc string"), bad, "id", "doc")


def flat(v, path="$", lst=None):
    if isinstance(v, dict) and v:
        return {k2: x for k, w in v.items() for k2, x in flat(w, f"{path}.{json.dumps(k, ensure_ascii=False)}").items()}
    if isinstance(v, list) and v:
        return {k2: x for i, w in enumerate(v) for k2, x in flat(w, f"{path}[{i}]", path).items()}
    return {path: (json.dumps(v, ensure_ascii=False), lst)}


def test_differences_account_for_every_leaf(spark, frame):
    rng = random.Random(8)

    def value(d):
        kind = rng.random()
        if d and kind < 0.35:
            return {rng.choice(["a", "b", 'q"x', "é", "c.d"]): value(d - 1) for _ in range(rng.randint(0, 3))}
        if d and kind < 0.7:
            return [value(d - 1) for _ in range(rng.randint(0, 4))]
        return rng.choice([1, 2, "x", "y]", None, True])

    pairs = [(k, value(4), value(4)) for k in range(60)]
    pairs += [(k + 60, a, a) for k, a, _ in pairs[:10]] + [(80, {"l": [1, 2, 3]}, {"l": [3, 1, 2]}), (81, {"l": [1, 1, 5]}, {"l": [5, 1, 7]})]
    df = lambda i: frame([(p[0], json.dumps(p[i])) for p in pairs], "id long, doc string")
    got = difference.differences(df(1), df(2), "id", "doc").collect()
    for k, a, b in pairs:
        fa, fb = flat(a), flat(b)
        own = [r for r in got if r.id == k]
        # applying the differences to the leaves before gives those after
        now = {p: x[0] for p, x in fa.items()}
        for r in own:
            if r.kind in ("removed", "moved"):
                assert now.get(r.path, r.was) == r.was
        gone = [r for r in own if r.kind in ("removed", "moved")]
        for r in gone:
            now.pop(r.path)
        for r in own:
            if r.kind == "changed":
                assert now[r.path] == r.was != r.now
            if r.kind in ("added", "changed"):
                now[r.path] = r.now
            if r.kind == "moved":
                assert fa[r.path][1] == fb[r.moved_to][1] and r.moved_to != r.path
                now[r.moved_to] = r.was
        assert now == {p: x[0] for p, x in fb.items()}
    assert not [r for r in got if 60 <= r.id < 70]
    assert sorted((r.path, r.moved_to) for r in got if r.id == 80) == [('$."l"[0]', '$."l"[1]'), ('$."l"[1]', '$."l"[2]'), ('$."l"[2]', '$."l"[0]')]
    assert sorted((r.path, r.kind) for r in got if r.id == 81) == [('$."l"[0]', "removed"), ('$."l"[2]', "added"), ('$."l"[2]', "moved")]


def test_blessed_forms_are_compared(spark, frame, tmp_path):
    rows = [(1, '{"a":[1,2],"b":"x"}'), (2, "{}")]
    golden.bless(frame(rows, "id long, form string"), "id", "form", f"{tmp_path}/golden")
    assert golden.compare(frame(rows, "id long, form string"), "id", "form", f"{tmp_path}/golden").isEmpty()
    now = [(1, '{"a":[2,1],"b":"y"}'), (3, "1")]
    got = sorted((r.key, r.path, r.kind) for r in golden.compare(frame(now, "id long, form string"), "id", "form", f"{tmp_path}/golden").collect())
    assert got == [("1", '$."a"[0]', "moved"), ("1", '$."a"[1]', "moved"), ("1", '$."b"', "changed"), ("2", "$", "removed"), ("3", "$", "added")]


def test_migration_files(spark, tmp_path):
    import hashlib

    for name in ("0001_first.sql", "0002_b.sql", "notes.sql", "0003_c.txt"):
        (tmp_path / name).write_text(name)
    got = sorted(map(tuple, stream.migration_files(spark, str(tmp_path)).collect()))
    assert got == [(n[:4], hashlib.sha256(n.encode()).hexdigest()) for n in ("0001_first.sql", "0002_b.sql")]


def test_deferred_fields_take_their_conclusions_along(spark, frame):
    manifest = frame([("size", "creek"), ("yard", "size"), ("yard", "lot")], "conclusion string, input string")
    fields = frame([("creek", True, "water"), ("lot", False, "s"), ("school", True, None)], "field_key string, deferred boolean, source_id string")
    lacking = deferral.lacking_fields(frame([(1,), (2,)], "parcel_id long"), fields, frame([(1, "lot"), (2, "creek")], "parcel_id long, field_key string"))
    told = sorted((r.parcel_id, r.field_key, r.source_id, list(r.cascades_to)) for r in deferral.source_deferred(lacking, manifest).collect())
    assert told == [(1, "creek", "water", ["size", "yard"]), (1, "school", None, []), (2, "school", None, [])]
    refused = sorted((r.parcel_id, r.conclusion, list(r.missing)) for r in deferral.refused_conclusions(lacking, manifest).collect())
    assert refused == [(1, "size", ["creek"]), (1, "yard", ["creek"]), (2, "yard", ["lot"])]
    assert deferral.lacking_fields(frame([(1,)], "parcel_id long"), fields.limit(0), manifest.selectExpr("1L parcel_id", "input field_key")).count() == 0
