"""Readers' views, packs, derived facts and geometry detectors."""

import pytest
from pyspark.sql import functions as F

from factspan.functions import geo
from factspan.operators import derive, views
from factspan.sources import pack


def test_arguments_are_validated():
    assert views.valid_id("0A" * 4 + "-1111-2222-3333-" + "ab" * 6).startswith("0a0a")
    for bad in ("1", "", "z" * 36):
        with pytest.raises(ValueError):
            views.valid_id(bad)
    with pytest.raises(ValueError):
        views.valid_enum("exception_outcome", "opened")


def test_lists(spark, frame):
    x = frame([("b", 1, "open", "d", "1"), ("a", 1, "open", "d", "2"), ("c", 2, "confirmed", "e", "1")], "id string, detected_at long, outcome string, detector_key string, detector_version string")
    assert [r.id for r in views.exceptions(x).collect()] == ["c", "a", "b"]
    assert [r.id for r in views.exceptions(x, "open", "d", "1").collect()] == ["b"]
    files = frame([("f1", 1), ("f2", 2), ("f3", 3)], "id string, composed_at long")
    links = frame([("f2", "y", "input"), ("f2", "x", "gate"), ("f1", "z", "input")], "property_file_id string, fact_id string, use string")
    got = {r.id: r.links for r in views.files(files, links, 2).collect()}
    assert set(got) == {"f2", "f3"} and [tuple(y) for y in got["f2"]] == [("x", "gate"), ("y", "input")] and got["f3"] is None
    lic = views.licences(frame([("l",), ("m",)], "id string"), frame([("l", "b", True), ("l", "a", False)], "licence_id string, channel string, allowed boolean")).collect()
    assert [tuple(c) for c in lic[0].channels] == [("a", False), ("b", True)] and lic[1].channels is None
    state = views.migrations(frame([("1", "h"), ("2", "h"), ("3", "h")], "version string, file_sha256 string"), frame([("1", "h"), ("3", "g"), ("4", "h")], "version string, file_sha256 string"))
    assert [tuple(r) for r in state.collect()] == [("1", "recorded"), ("2", "missing"), ("3", "changed"), ("4", "unexpected")]
    totals = views.refusal_totals(frame([('[{"code":"A"},{"code":"A"},{"code":"B"}]',), ('[{"code":"A"}]',), ("[]",)], "r string"), "r")
    assert [tuple(r) for r in totals.collect()] == [("A", 2), ("B", 1)]


def test_parcel_facts_hide_values(spark, frame):
    facts = frame([("p", "b", "1", "ok", "bulk"), ("p", "a", "2", "no", "derived"), ("q", "a", "3", "ok", "bulk")], "parcel_id string, field_key string, value string, licence_id string, method string")
    channels = frame([("ok", "api", True)], "licence_id string, channel string, allowed boolean")
    assert [tuple(r) for r in views.parcel_facts(facts, channels, "api", "p").collect()] == [("p", "a", None, True, True), ("p", "b", "1", False, False)]
    with pytest.raises(ValueError):
        views.parcel_facts(facts, channels, "fax", "p")


def test_packs(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "s.yaml").write_text("jurisdiction: j\nsources:\n- {id: j.a, licence: open, phase_status: active, supplies: [x, y]}\n")
    name, rows = pack.read_sources(spark, f"{tmp_path}/s.yaml")
    assert name == "j" and rows.first().supplies == ["x", "y"]
    (tmp_path / "bad.yaml").write_text("jurisdiction: j\nsources:\n- {id: j.a, licence: open}\n")
    (tmp_path / "l.yaml").write_text("jurisdiction: j\nlicences:\n- {id: open}\n- {id: open}\n")
    with pytest.raises(ValueError):
        pack.read_sources(spark, f"{tmp_path}/bad.yaml")
    with pytest.raises(ValueError):
        pack.read_licences(spark, f"{tmp_path}/l.yaml")


def test_derived_facts_have_lineage_and_the_narrower_licence(spark, frame):
    facts = frame([("1", "p", "lot", "10", "a"), ("2", "p", "far", "3", "b"), ("3", "q", "lot", "9", "a")], "id string, parcel_id string, field_key string, value string, licence_id string")
    out, edges = derive.derive(facts, ["lot", "far"], "max_area", (F.col("lot").cast("int") * F.col("far").cast("int")).cast("string"), "v1")
    assert [(r.parcel_id, r.value, r.method) for r in out.collect()] == [("p", "30", "derived")]
    assert [(r.ordinal, r.input_fact_id) for r in edges.orderBy("ordinal").collect()] == [(0, "1"), (1, "2")]
    licence = frame([("a", "allowed", "allowed", "open"), ("b", "prohibited", "allowed", "attribution")], "id string, commercial_use string, redistribution string, restriction string")
    channels = frame([("a", "api", True), ("a", "analytics", True), ("b", "api", True)], "licence_id string, channel string, allowed boolean")
    r = derive.with_licence(out, edges, facts, licence, channels).first()
    assert (r.channels, r.commercial_use, r.redistribution, r.attribution) == (["api"], False, True, True)


def test_geometry_detectors_tell_a_point_once(spark, frame):
    bow = lambda d: [[[[d, 0.0], [d + 2.0, 2.0], [d + 2.0, 0.0], [d, 2.0], [d, 0.0]]]]
    shapes = frame([("a", bow(0.0)), ("b", bow(0.1)), ("ok", [[[[5.0, 5.0], [9.0, 5.0], [9.0, 9.0], [5.0, 5.0]]]])], f"zid string, geom {geo.MULTIPOLYGON}")
    points = frame([(1, 1.9, 1.0), (2, 8.0, 6.0)], "pid int, x double, y double")
    assert [(r.pid, r.reason, r.polygon_ids) for r in derive.touched_by_invalid(points, shapes, "pid", "zid", "geom").collect()] == [(1, "self_intersection", ["a", "b"])]
    good = derive.approved_providers(frame([("x", "m", "j"), ("y", "m", "j")], "provider string, method string, jurisdiction_id string"), frame([("x", "m", "j", True), ("y", "m", "j", False)], "provider string, method string, jurisdiction_id string, approved boolean"))
    assert [r.provider for r in good.collect()] == ["x"]
