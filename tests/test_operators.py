"""Operators that the catalogue's tables don't reach: rights, validators, exceptions, compose, audits, streams."""

import datetime as dt
import hashlib
import json
import re
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from factspan.functions import geo
from factspan.operators import audit, compose, current, exceptions, lineage, match, reconcile, rights, rules, spatial, validate
from factspan.plans import vocabulary
from factspan.sources import snapshot
from factspan.streaming import reconcile as streaming

T = lambda d, h=0: dt.datetime(2026, 1, d, h)


def test_each_clause_of_the_current_fact_counts(spark, frame):
    schema = "id string, parcel_id string, field_key string, source_id string, confidence string, retrieved_at timestamp, recorded_at timestamp, superseded_at timestamp, effective_from timestamp, effective_to timestamp"
    row = lambda i, f, s="a", c="high", r=T(1), rec=T(1), sup=None, ef=T(1), et=None: (i, "p", f, s, c, r, rec, sup, ef, et)
    facts = frame([
        row("1", "rank", "a"), row("2", "rank", "b"), row("3", "conf", c="low"), row("4", "conf", c="medium"), row("5", "conf2", c="low"), row("6", "conf2", c="high"),
        row("7", "date", r=None), row("8", "date", r=T(2)), row("9", "tie"), row("91", "tie"), row("a", "superseded", sup=T(5)), row("b", "future", rec=T(6)), row("c", "ended", et=T(5)), row("d", "notyet", ef=T(6)), row("e", "edge", sup=T(6), et=T(6)),
    ], schema)
    ranks = frame([("rank", "b", 1)], "field_key string, source_id string, rank int")
    got = current.current_fact_at(facts, ranks, F.lit("2026-01-05").cast("timestamp"), confidence=vocabulary.ordinal("confidence_level", F.col("confidence")))
    assert {r.field_key: r.id for r in got.collect()} == {"rank": "2", "conf": "4", "conf2": "6", "date": "8", "tie": "9", "edge": "e"}


def test_licence_inheritance(spark, frame):
    fact = frame([("d1", "wide"), ("d2", "narrow"), ("d3", "wide"), ("i1", "open"), ("i2", "closed"), ("i3", "credit")], "id string, licence_id string")
    edges = frame([("d1", "i1"), ("d1", "i2"), ("d2", "i1"), ("d2", "i3")], "fact_id string, input_fact_id string")
    licence = frame([("wide", "allowed", "allowed", "open"), ("narrow", "prohibited", "allowed", "attribution"), ("open", "allowed", "allowed", "open"), ("closed", "prohibited", "unknown", "open"), ("credit", "allowed", "allowed", "attribution")], "id string, commercial_use string, redistribution string, restriction string")
    channels = frame([("wide", "api", True), ("wide", "analytics", True), ("narrow", "api", True), ("open", "api", True), ("open", "analytics", True), ("closed", "api", True), ("closed", "analytics", False), ("credit", "api", True)], "licence_id string, channel string, allowed boolean")
    got = {tuple(r) for r in rights.inheritance_violations(edges, fact, licence, channels).collect()}
    assert got == {("d1", "channel", "analytics"), ("d1", "commercial_use", None), ("d1", "redistribution", None)}
    may = {r.fact_id: r for r in rights.inherited_licence(edges, fact, licence, channels).collect()}
    assert may["d1"].channels == ["api"] and may["d2"].channels == ["api"] and may["d2"].attribution and not may["d1"].commercial_use
    gate = rights.rights_gate(frame([("f", "open", "x"), ("f", "none", "y"), ("f", "none", "a")], "property_file_id string, licence_id string, field_key string"), channels, "api").collect()
    assert {(r.licence_id, r.allowed, tuple(r.field_keys)) for r in gate} == {("open", True, ("x",)), ("none", False, ("a", "y"))}


def test_facts_are_not_shuffled_by_licence_or_channel(spark, frame):
    """70 channels, licences without terms, without channels and none at all; no shuffle of facts by what few of them differ in."""
    fact = frame([("d1", "all"), ("d2", "all"), ("d3", "some"), ("d4", None), ("d5", "all"), ("i1", "all"), ("i2", "some"), ("i3", "bare"), ("i4", None), ("i5", "odd")], "id string, licence_id string")
    edges = frame([("d1", "i1"), ("d1", "i1"), ("d2", "i1"), ("d2", "i2"), ("d3", "i1"), ("d3", "i3"), ("d4", "i2"), ("d5", "i4"), ("d6", "i5")], "fact_id string, input_fact_id string")
    licence = frame([("all", "allowed", "allowed", "open"), ("some", "allowed", "prohibited", "attribution"), ("bare", None, "allowed", "open")], "id string, commercial_use string, redistribution string, restriction string")
    channels = frame([("all", f"c{k:02}", True) for k in range(70)] + [("some", f"c{k:02}", k not in (66, 68)) for k in range(2, 69)] + [("odd", "c05", True)], "licence_id string, channel string, allowed boolean")
    broken = rights.inheritance_violations(edges, fact, licence, channels)
    assert {tuple(r) for r in broken.collect()} == {("d2", "channel", "c00"), ("d2", "redistribution", None), ("d2", "attribution", None), ("d3", "channel", "c02"), ("d5", "channel", "c00")}
    may = rights.inherited_licence(edges, fact, licence, channels)
    want = [f"c{k:02}" for k in range(70)]
    some = [c for c in want[2:69] if c not in ("c66", "c68")]
    got = {r.fact_id: tuple(r)[1:] for r in may.collect()}
    assert got == {"d1": (True, True, False, want), "d2": (True, False, True, some), "d3": (True, True, False, []), "d4": (True, False, True, some)}
    assert rights.inherited_licence(edges, fact, licence, channels.where("not allowed")).where("size(channels) = 0").count() == 4
    assert rights.inheritance_violations(edges, fact, licence, channels.where("not allowed")).where("dimension = 'channel'").count() == 0
    claims, inputs, allowed = frame([("a", 1), ("a", 2), ("b", 1), ("c", 3), (None, 1)], "k string, ch int"), frame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("c", None)], "k string, l string"), frame([("x", 1), ("x", 1), ("x", 2), ("y", 1), ("y", None)], "l string, ch int")
    over = rights.over_permitted(claims, inputs, allowed, "k", "ch", "l")
    assert {tuple(r) for r in over.collect()} == {("a", 2), ("c", 3)}
    for df in (broken, may, over):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\((own#|\w+#\d+L?, \w+#)", plan)


def test_fact_validators_pass_unknown_and_find_breaches(spark, frame):
    base = {"id": "1", "parcel_id": "p", "field_key": "f", "value": "1", "source_id": "s", "source_url": "u", "snapshot_id": "n", "method": "bulk", "retrieved_at": T(1), "effective_from": T(1), "recorded_at": T(1)}
    rows = [base, base | {"id": "2", "method": "manual"}, base | {"id": "3", "source_id": None}, base | {"id": "4", "superseded_at": T(1) - dt.timedelta(1)}, base | {"id": "5", "effective_to": T(1)}, base | {"id": "6", "supersedes_fact_id": "6"}, base | {"id": "7", "supersedes_fact_id": "1", "supersession_reason": "unknown"}]
    schema = spark.createDataFrame([], vocabulary.FACT).schema
    df = spark.createDataFrame([[r.get(c) for c in schema.names] for r in rows], schema)
    got = {(r.id, r.violates) for r in validate.fact_checks(df).collect()}
    assert got == {("2", "method_automated"), ("3", "provenance_complete"), ("4", "transaction_time"), ("5", "valid_time"), ("6", "supersedes_not_self"), ("6", "supersession_reason")}
    assert [r.id for r in validate.supersession_targets(df.where("id in ('1', '7')")).collect()] == ["7"]
    assert validate.one_current_per_source(df.where("id in ('1', '5')")).first().n == 2
    before, after = df.where("id in ('1', '5', '7')"), df.where("id in ('1', '7')").withColumn("value", F.when(F.col("id") == "7", "2").otherwise(F.col("value"))).withColumn("superseded_at", F.lit(T(3)))
    assert sorted(r.id for r in validate.changed_rows(before, after, ["id"], ("superseded_at",)).collect()) == ["5", "7"]
    refs = frame([("a", 1), (None, 1), ("a", None), ("b", 1)], "k string, m int")
    assert [tuple(r) for r in validate.references(refs, ["k", "m"], frame([("a", 1)], "x string, y int"), ["x", "y"]).collect()] == [("b", 1)]


def test_exception_lifecycle_compares_reasons_null_safely(spark, frame):
    rows = frame([("1", "p", None, "open", "d", "v1", None), ("2", "p", "r", "open", "d", "v1", None), ("3", "p", None, "condition_cleared", "d", "v1", T(2)), ("4", "p", None, "confirmed", "d", "v1", T(3)), ("5", "q", "r", "open", "d", "v2", None)], "id string, parcel_id string, reason string, outcome string, detector_key string, detector_version string, resolved_at timestamp")
    now = F.lit(T(9))
    still = frame([("p", None), ("z", "r")], "parcel_id string, reason string")
    assert sorted(r.id for r in exceptions.close_resolved(rows, still, now).collect()) == ["2", "5"]
    assert sorted(r.id for r in exceptions.close_resolved(rows, still.limit(0), now).collect()) == ["1", "2", "5"]
    assert {r.id: r.prior for r in exceptions.relink_reopened(rows.where("outcome = 'open'"), rows.where("outcome <> 'open'"), [F.col("resolved_at").desc(), F.col("id")]).collect()} == {"1": "4"}
    assert [r.id for r in exceptions.retire_stranded(rows, "d", "v1", now).collect()] == ["5"]
    assert [r.id for r in exceptions.close_for(rows, frame([("q",)], "parcel_id string"), now).collect()] == ["5"]
    found = frame([("p", None), ("p", "new"), ("p", "new")], "parcel_id string, reason string")
    assert [(r.parcel_id, r.reason) for r in exceptions.not_yet_open(found, rows).collect()] == [("p", "new")]


def test_compose_accumulates_refusals(spark, frame):
    parcels = frame([("p1", "j"), ("p2", "j"), ("p3", "k")], "id string, jurisdiction_id string")
    places = frame([("j", False), ("k", True)], "id string, geometry_tier_enabled boolean")
    facts = frame([("f1", "p1", "zone", "bad", "s1"), ("f2", "p1", "apn", "bad", "s1"), ("f3", "p1", "x", "good", "s2"), ("f4", "p3", "x", "good", "s2")], "id string, parcel_id string, field_key string, licence_id string, snapshot_id string")
    channels = frame([("good", "api", True), ("bad", "api", False)], "licence_id string, channel string, allowed boolean")
    rule = frame([("j", "setback", 1, dt.date(2020, 1, 1), dt.date(2025, 1, 1)), ("j", "setback", 2, dt.date(2025, 1, 1), None), ("k", "setback", 3, dt.date(2020, 1, 1), None)], "jurisdiction_id string, rule_key string, version int, effective_from date, effective_to date")
    asked = frame([("r1", "p1", "city"), ("r2", "p1", None), ("r3", "p1", "state"), ("r4", "p2", "city"), ("r5", "nowhere", "city"), ("r6", "p3", "city"), ("r7", "p3", "old")], "request_id string, parcel_id string, election string")
    files, links = compose.compose(asked, parcels, facts, channels, places, rule, F.lit("2026-01-01").cast("date"), {"city": "setback", "old": "gone"}, "api")
    got = {r.request_id: r for r in files.collect()}
    codes = {k: [x.code for x in r.refusals] for k, r in got.items()}
    assert codes == {
        "r1": ["GEOMETRY_TIER_DISABLED", "RIGHTS_BLOCKED"], "r2": ["GEOMETRY_TIER_DISABLED", "ELECTION_REQUIRED", "RIGHTS_BLOCKED"], "r3": ["GEOMETRY_TIER_DISABLED", "ELECTION_NOT_SUPPORTED", "RIGHTS_BLOCKED"],
        "r4": ["GEOMETRY_TIER_DISABLED", "PARCEL_NO_FACTS"], "r5": ["PARCEL_REFERENCE_UNKNOWN"], "r6": [], "r7": ["RULE_UNAVAILABLE"],
    }
    assert got["r5"].status is None and got["r6"].status is None and got["r6"].payload is None
    assert got["r1"].ruleset_version == "setback@2" and got["r3"].ruleset_version == "no rule selected: ELECTION_NOT_SUPPORTED" and got["r7"].ruleset_version.startswith("no rule effective")
    payload = json.loads(got["r1"].payload)
    assert payload["refusals"][1]["detail"]["field_keys"] == "apn, zone" and hashlib.sha256(json.dumps(payload, sort_keys=True).encode()).hexdigest() == got["r1"].payload_hash
    assert sorted((r.request_id, r.fact_id) for r in links.collect() if r.request_id in ("r1", "r4", "r6")) == [("r1", "f1"), ("r1", "f2"), ("r1", "f3")]
    with pytest.raises(ValueError):
        compose.compose(asked, parcels, facts, channels, places, rule, F.current_date(), {}, "nowhere")
    with pytest.raises(ValueError):
        compose.geometry_gate("colour", F.lit(True))
    shown, hidden = compose.visible_facts(facts.withColumn("method", F.lit("bulk")), channels, "api", "p1")
    assert (shown.count(), hidden.count()) == (1, 2)
    need = frame([("apn", True, False), ("zone", True, True), ("x", False, False)], "field_key string, required_for_file boolean, phase1_deferred boolean")
    assert {r.parcel_id: (r.unmet_fields, r.deferred_fields) for r in compose.unmet_fields(need, facts, parcels).collect()} == {"p2": (["apn"], ["zone"]), "p3": (["apn"], ["zone"])}


def test_rule_selection_refuses(spark, frame):
    rule = frame([("j", "k", 1, dt.date(2020, 1, 1), None)], "jurisdiction_id string, rule_key string, version int, effective_from date, effective_to date")
    asked = frame([("j", "k"), ("j", "z")], "jurisdiction_id string, rule_key string")
    assert {r.rule_key: (r.version, r.refusal) for r in rules.select_rules(asked, rule, F.lit("2021-01-01").cast("date")).collect()} == {"k": (1, None), "z": (None, "RULE_UNAVAILABLE")}


def test_snapshots_are_verified_and_audited(spark, frame, tmp_path):
    (tmp_path / "a").write_bytes(b"one")
    (tmp_path / "b").write_bytes(b"two")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    snapshot.verify(spark, f"{tmp_path}/a", sha(b"one"), 3)
    for h, n in ((sha(b"two"), 3), (sha(b"one"), 4)):
        with pytest.raises(ValueError):
            snapshot.verify(spark, f"{tmp_path}/a", h, n)
    objects = snapshot.fetched(spark, str(tmp_path)).withColumn("object_uri", F.element_at(F.split("path", "/"), -1))
    snaps = frame([("s1", "a", sha(b"one"), 3, 200), ("s2", "b", sha(b"one"), 3, 200), ("s3", "c", sha(b"x"), 1, 200), ("s4", "a", sha(b"one"), 3, None), ("s5", "a", sha(b"one"), 3, 404)], "id string, object_uri string, content_hash string, byte_size long, http_status int")
    flagged = audit.flagged_snapshots(snaps, objects)
    assert {(r.id, r.reason) for r in flagged.collect()} == {("s2", "content_mismatch"), ("s3", "unreadable"), ("s4", "status"), ("s5", "status")}
    facts = frame([("s2", "f"), ("s2", "e"), ("s1", "f")], "snapshot_id string, field_key string")
    assert [tuple(r) for r in audit.facts_citing(facts, flagged).collect()] == [("s2", 2, ["e", "f"])]
    runs = frame([("1", "s", "load", "succeeded", T(1), T(1)), ("2", "s", "fetch", "succeeded", T(2), T(2)), ("3", "s", "load", "failed", T(3), T(3))], "id string, source_id string, kind string, status string, started_at timestamp, finished_at timestamp")
    assert audit.previous_load(runs, ["source_id"]).first().id == "1"


def test_file_sources(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes("﻿ASSESSORS,ISSUEDATE\n'67620002,1/1/2026 1:02:03 AM\n,\n".encode())
    rows = snapshot.read_csv(spark, f"{tmp_path}/p.csv")
    assert rows.columns == ["ASSESSORS", "ISSUEDATE"] and rows.first().ASSESSORS == "'67620002"
    shape = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"FACILITYID": "z1", "ZONING": None}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 0]]]}}]}
    (tmp_path / "z.geojson").write_text(json.dumps(shape))
    f = snapshot.read_geojson(spark, f"{tmp_path}/z.geojson", "FACILITYID string, ZONING string")
    assert f.select("FACILITYID", F.size(geo.multipolygon(F.col("geometry_type"), F.col("coordinates"))).alias("n")).first().asDict() == {"FACILITYID": "z1", "n": 1}
    raw = (tmp_path / "z.geojson").read_bytes()
    known = hashlib.sha256(raw).hexdigest()
    assert snapshot.read_geojson(spark, f"{tmp_path}/z.geojson", "FACILITYID string, ZONING string", known, len(raw)).collect() == f.collect()
    for h, n in ((known, len(raw) + 1), ("0" * 64, len(raw))):
        with pytest.raises(Exception, match="not the snapshot"):
            snapshot.read_geojson(spark, f"{tmp_path}/z.geojson", "FACILITYID string", h, n).collect()
    props = spark.createDataFrame([('{"a":1,"b":null}',), ('{"a":2}',)], "props string")
    assert {r.k: (r.present, r.null_values) for r in snapshot.property_keys(props, "props").collect()} == {"a": (2, 0), "b": (1, 1)}


def test_features_by_line(spark, tmp_path):
    one = lambda k: json.dumps({"type": "Feature", "properties": {"id": f"z{k}"}, "geometry": {"type": "Point", "coordinates": [k, 0]}})
    (tmp_path / "a").write_text('{"type": "FeatureCollection",\n"features": [\n' + ",\n".join(map(one, range(5))) + "\n]}\n")
    (tmp_path / "b").write_text("\ufeff" + "\n".join("\x1e" + one(k) for k in range(5)))
    (tmp_path / "c").write_text(",".join(map(one, range(5))))
    for f in "abc":
        rows = snapshot.read_features(spark, f"{tmp_path}/{f}", "id string").orderBy("id").collect()
        assert [(r.id, r.geometry_type, r.coordinates) for r in rows] == [(f"z{k}", "Point", f"[{k},0]") for k in range(5)]
    (tmp_path / "d").write_text('{"type": "FeatureCollection", "features": [' + one(1) + "]}")
    (tmp_path / "e").write_text(json.dumps(json.loads(one(1)), indent=1))
    for f in "de":
        with pytest.raises(Exception):
            snapshot.read_features(spark, f"{tmp_path}/{f}", "id string").collect()


def test_conformance_and_drift(spark, frame):
    pack = frame([("j.a", "active", "open", ["x", "y"]), ("j.b", "active", "gone", ["x"]), ("j.c", "deferred", "open", ["x"]), ("us.z", "active", "open", ["x"]), ("j.d", "active", "open", ["q"])], "id string, phase_status string, licence string, supplies array<string>")
    registry = frame([("j.a", "other", ["x", "w"]), ("j.b", "gone", ["x"])], "id string, licence_id string, expected_fields array<string>")
    got = {tuple(r) for r in audit.conformance(pack, registry, frame([("open",)], "id string"), frame([("x",), ("y",)], "field_key string"), "j").collect()}
    assert got == {("j.a", "licence_differs", "other"), ("j.a", "supplies_unexpected", "y"), ("j.a", "supplies_lacking", "w"), ("j.b", "licence_missing", "gone"), ("j.d", "source_missing", ""), ("j.d", "field_undefined", "q")}
    one = spark.range(1)
    assert audit.schema_drift({"a": one.schema.json(), "b": "{}", "c": "{}"}, {"a": one, "b": one, "d": one}) == [("b", "differs"), ("c", "missing"), ("d", "unexpected")]


def test_spatial_join_equals_brute_force_for_any_size(spark, frame):
    shapes = [(i, [[[[x, y], [x + d, y], [x + d / 2, y + d], [x, y]]]]) for i, (x, y, d) in enumerate([(0.0, 0.0, 100.0), (3.0, 3.0, 0.5), (50.0, 20.0, 7.0), (-20.0, -20.0, 30.0), (5.0, 5.0, 1e-4)])]
    points = [(k, (k * 37 % 1000) / 8 - 20.01, (k * 91 % 1000) / 9 - 19.97) for k in range(400)] + [(900, 3.25, 3.1), (901, 5.00005, 5.00002), (902, 0.0, 0.0)]
    df, pf = frame(shapes, f"zid int, geom {geo.MULTIPOLYGON}"), frame(points, "pid int, x double, y double")
    got = {(r.pid, r.zid) for r in spatial.point_in_polygon(pf, df, "geom", "x", "y").collect()}
    cross = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    inside = lambda g, p: all(cross(a, b, p) > 0 for a, b in zip(g[0][0], g[0][0][1:]))
    assert got == {(k, z) for k, x, y in points for z, g in shapes if inside(g, (x, y))} and len(got) > 50
    plan = spatial.point_in_polygon(pf, df, "geom", "x", "y")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert spatial.point_in_polygon(pf, df.limit(0), "geom", "x", "y").count() == 0


def test_classification_of_overlaps(spark, frame):
    pairs = frame([(1, "a", "R", "x"), (1, "b", "R", "x"), (2, "a", "R", "x"), (2, "c", "S", "x"), (3, "d", " ", "x"), (4, "a", "R", "x"), (4, "e", "R", "y"), (5, "a", "R", None), (6, "a", "R", "x"), (6, "n", None, "z")], "pid int, zid string, zoning string, abbr string")
    got = {r.pid: r for r in spatial.classify(frame([(i,) for i in range(1, 8)], "pid int"), pairs, "pid", "zid", "zoning", "abbr").collect()}
    assert [got[i].kind for i in range(1, 8)] == ["matched", "ambiguous", "zero_match", "matched", "matched", "matched", "zero_match"]
    assert got[1].anomaly_ids == ["a", "b"] and got[1].abbr == "x" and got[4].abbr is None and got[4].abbr_conflict == ["x", "y"] and got[5].abbr is None and got[6].abbr == "x" and got[6].anomaly_ids == ["a", "n"]


def test_set_and_match_helpers(spark, frame):
    table, rows = frame([(1, "a"), (2, "b")], "k int, v string"), frame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, reconcile.upsert(table, rows, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert [r.k for r in reconcile.insert_if_absent(table, rows, ["k"]).collect()] == [3]
    states = frame([(None, "1", None), ("1", "1", None), ("1", "2", None), ("1", "?", "placeholder"), (None, "?", "placeholder")], "was string, now string, why string")
    assert [r.x for r in states.select(reconcile.identifier_change(F.col("was"), F.col("now"), F.col("why")).alias("x")).collect()] == ["resolve", "same", "change", "degrade", "still_unresolvable"]
    raw = frame([("b ", 3), ("'a", 1), ("a", 2), (" ", 0), ("c", 9)], "raw string, o int")
    assert [r.raw for r in match.first_unique(raw, "raw", "o", 2).collect()] == ["'a", "b "]


def test_closure_of_a_graph_with_a_diamond_and_a_cycle(spark, frame):
    edges = frame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("x", "y"), ("y", "x")], "fact_id string, input_fact_id string")
    got = {(r.seed, r.ancestor): r.depth for r in lineage.closure(edges, frame([("d",), ("x",)], "fact_id string")).collect()}
    assert got == {("d", "b"): 1, ("d", "c"): 1, ("d", "a"): 2, ("x", "y"): 1}


def test_closure_goes_to_the_end_or_raises(spark, frame):
    edges = frame([(i, i - 1) for i in range(1, 54)], "fact_id long, input_fact_id long")
    seed = frame([(53,)], "fact_id long")
    assert lineage.closure(edges, seed).count() == 53
    assert lineage.closure(edges.where("fact_id <= 3"), frame([(3,)], "fact_id long"), max_depth=3).count() == 3
    with pytest.raises(RuntimeError):
        lineage.closure(edges, seed, max_depth=3)


def test_streams(spark, frame, tmp_path):
    schema = "parcel_id string, reason string, at timestamp, holds boolean"
    frame([("p", "r", T(1), True), ("p", "r", T(2), True), ("p", "r", T(3), False), ("p", "r", T(4), True), ("q", "r", T(1), False)], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = streaming.exception_lifecycle(streaming.incoming(spark, f"{tmp_path}/in", schema))
    q = stream.writeStream.format("memory").queryName("lifecycle").outputMode("append").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    assert sorted((r.parcel_id, r.event, r.openings) for r in spark.table("lifecycle").collect()) == [("p", "cleared", 1), ("p", "opened", 1), ("p", "reopened", 2)]
    runs = []
    q = streaming.reconcile_each(streaming.incoming(spark, f"{tmp_path}/in", schema), f"{tmp_path}/c2", lambda batch, run: runs.append((run, batch.count())))
    assert q.awaitTermination(180) and runs == [("batch-000000000000", 5)]
    once = streaming.first_sightings(streaming.incoming(spark, f"{tmp_path}/in", schema), "parcel_id", "at", "1 day")
    q = once.writeStream.format("memory").queryName("once").outputMode("append").option("checkpointLocation", f"{tmp_path}/c3").trigger(availableNow=True).start()
    assert q.awaitTermination(180) and spark.table("once").count() == 2
