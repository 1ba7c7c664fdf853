"""A -> B -> A: three snapshots of parcels, zoning and permits, loaded one after the other."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from factspan.functions import geo
from factspan.operators.current import current_fact_at
from factspan.plans.pipelines import SCHEMAS, Ledger, load_parcels, load_permits, load_zoning
from factspan.sources.tables import Tables


def square(x, y, d=1.0):
    return [[[x, y], [x + d, y], [x + d, y + d], [x, y + d], [x, y]]]


def geometry(x, y):
    return json.dumps({"type": "Polygon", "coordinates": square(x, y)})


A = [("1", "100", geometry(0, 0)), ("2", "'200", geometry(10, 0)), ("3", "300", geometry(20, 0)), ("4", "4??", geometry(30, 0)), ("5", "500", geometry(40, 0)), ("6", " ", geometry(50, 0))]
B = [("1", "101", geometry(0, 0)), ("2", "200", geometry(10, 0)), ("4", "4??", geometry(31, 0)), ("5", "5?0", geometry(40, 0)), ("6", "600", geometry(50, 0)), ("7", "700", geometry(60, 0))]
ZONES_A = [("z1", "R-1", "r1", [square(-5.0, -5.0, 10.0)]), ("z2", "R-2", "r2", [square(8.0, -2.0, 6.0)]), ("z9", " ", None, [square(38.0, -2.0, 6.0)])]
ZONES_B = [("z2", "R-3", "r3", [square(8.0, -2.0, 6.0)]), ("z5", "R-M", "rm", [square(38.0, -2.0, 6.0)]), ("z6", "R-M2", "rm", [square(38.0, -2.0, 6.0)]), ("z7", "R-5", "a", [square(48.0, -2.0, 6.0)]), ("z8", "R-5", "b", [square(48.0, -2.0, 6.0)])]
PERMITS = {"A": [("100", "2026-01-01"), ("200", "2026-01-02")], "B": [("'200'", "2026-01-05"), (" 200", "2026-01-02"), ("200", "2025-12-01"), ("300", "2026-02-01"), ("", "2026-01-01"), ("999", "2026-01-01")]}


@pytest.fixture(scope="module")
def ledger(spark):
    held = Ledger(Tables(spark, tempfile.mkdtemp(prefix="spark-"), SCHEMAS), "here")
    for n, (parcels, zones, permits) in enumerate([(A, ZONES_A, "A"), (B, ZONES_B, "B"), (A, ZONES_A, "A")]):
        at = lambda m: F.lit(f"2026-01-0{n + 1} 0{m}:00:00").cast("timestamp")  # noqa: B023, E731
        load_parcels(held, spark.createDataFrame(parcels, "feature_id string, apn string, geometry string"), "src.parcels", f"snap{n}", f"{n}-1", at(1))
        polygons = spark.createDataFrame(zones, f"zone_id string, zoning string, abbreviation string, geom {geo.MULTIPOLYGON}")
        load_zoning(held, polygons, "src.parcels", "src.zoning", f"zone{n}", f"{n}-2", at(2))
        rows = spark.createDataFrame(PERMITS[permits], "raw string, issued string").withColumn("issued", F.col("issued").cast("date"))
        load_permits(held, rows, "src.parcels", "src.permits", f"permit{n}", f"{n}-3", at(3))
    return held


def believed(ledger, when, feature, field):
    """The value of a field of a parcel at a time, by the general resolution."""
    spark = ledger.tables.spark
    rank = spark.createDataFrame([], "field_key string, source_id string, rank int")
    parcel = ledger.identity().where(F.col("source_feature_id") == feature).first().parcel_id
    facts = ledger.facts().where((F.col("parcel_id") == parcel) & (F.col("field_key") == field))
    rows = current_fact_at(facts, rank, F.lit(when).cast("timestamp"), confidence="confidence").collect()
    return [r.value for r in rows]


DAY = ["2026-01-01 12:00:00", "2026-01-02 12:00:00", "2026-01-03 12:00:00"]
v = lambda x: [json.dumps({"v": x}, separators=(",", ":"))]


def test_identifiers_change_degrade_and_resolve(ledger):
    apn = lambda d, f: believed(ledger, DAY[d], f, "apn")
    assert [apn(d, "1") for d in range(3)] == [v("100"), v("101"), v("100")]
    assert [apn(d, "2") for d in range(3)] == [v("200")] * 3
    assert [apn(d, "5") for d in range(3)] == [v("500"), [], v("500")]
    assert [apn(d, "6") for d in range(3)] == [[], v("600"), []]
    rows = ledger.facts().where("field_key = 'apn'").groupBy("parcel_id").count().collect()
    assert max(r["count"] for r in rows) == 3


def test_degraded_identifier_has_no_successor_and_a_gap(ledger):
    parcel = ledger.identity().where("source_feature_id = '5'").first().parcel_id
    facts = ledger.facts().where((F.col("parcel_id") == parcel) & (F.col("field_key") == "apn")).orderBy("recorded_at").collect()
    assert len(facts) == 2 and facts[0].superseded_at is not None and facts[1].supersedes_fact_id is None
    gap = ledger.exceptions().where((F.col("parcel_id") == parcel) & (F.col("detector_key") == "parcels")).collect()
    assert [(g.reason, g.outcome) for g in gap] == [("unresolvable_placeholder", "condition_cleared")]


def test_features_leave_and_come_back_as_the_same_parcel(ledger):
    ids = {r.source_feature_id: r for r in ledger.identity().collect()}
    assert ids["3"].retired_at is None and ids["7"].retired_at is not None
    assert ledger.tables.read("identity_event").where("source_feature_id = '3'").select("parcel_id").distinct().count() == 1
    parcel = ids["7"].parcel_id
    lost = ledger.exceptions().where(F.col("parcel_id") == parcel).where("detector_key = 'parcels'").collect()
    assert [(x.reason, x.type, x.outcome) for x in lost] == [("feature_disappeared", "record_to_ground", "open")]
    assert believed(ledger, DAY[2], "7", "apn") == v("700")


def test_geometry_moves_although_the_identifier_is_unresolvable(ledger):
    assert [believed(ledger, d, "4", "geometry")[0] for d in DAY] == [geometry(30, 0), geometry(31, 0), geometry(30, 0)]
    parcel = ledger.identity().where("source_feature_id = '4'").first().parcel_id
    assert ledger.tables.read("exception_event").where((F.col("parcel_id") == parcel) & (F.col("detector_key") == "parcels")).count() == 1


def test_zoning(ledger):
    zone = lambda d, f, k="district": believed(ledger, DAY[d], f, f"zoning.{k}")
    assert [zone(d, "1") for d in range(3)] == [v("R-1"), [], v("R-1")]
    assert [zone(d, "2") for d in range(3)] == [v("R-2"), v("R-3"), v("R-2")]
    assert [zone(d, "5") for d in range(3)] == [[], [], []]
    assert [zone(d, "6") for d in range(3)] == [[], v("R-5"), []]
    assert [zone(d, "6", "district_verbatim") for d in range(3)] == [[], [], []]
    last = ledger.facts().where("field_key = 'zoning.district' and superseded_at is null and value like '%R-2%'").collect()
    assert [x.supersession_reason for x in last] == ["unknown"]


def test_zoning_exceptions_reopen_with_a_link(ledger):
    parcel = ledger.identity().where("source_feature_id = '5'").first().parcel_id
    x = ledger.exceptions().where((F.col("parcel_id") == parcel) & (F.col("detector_key") == "zoning")).orderBy("detected_at").collect()
    assert [(e.reason, e.outcome) for e in x] == [("no_containing_district", "condition_cleared"), ("multiple_containing_districts", "condition_cleared"), ("no_containing_district", "open")]
    assert [e.reopened_from_id for e in x] == [None, None, x[0].id]


def test_permits(ledger):
    get = lambda d, f, k: believed(ledger, DAY[d], f, f"permits.{k}")
    assert [get(d, "1", "active") for d in range(3)] == [["true"], ["false"], ["true"]]
    assert [get(d, "1", "series_earliest") for d in range(3)] == [v("2026-01-01"), [], v("2026-01-01")]
    assert [get(d, "2", "active") for d in range(3)] == [["true"]] * 3
    assert [get(d, "2", "series_earliest") for d in range(3)] == [v("2026-01-02"), v("2025-12-01"), v("2026-01-02")]
    assert [get(d, "3", "active") for d in range(3)] == [[], ["true"], ["false"]]


def test_a_run_commits_once_and_only_whole(ledger, spark):
    with pytest.raises(ValueError):
        ledger.tables.commit("0-1", {})
    before = ledger.facts().count()
    bad = ledger.facts().limit(1).withColumn("effective_to", F.col("effective_from"))
    from factspan.plans.pipelines import _checks

    with pytest.raises(ValueError, match="fact_checks"):
        ledger.tables.commit("9-bad", {"fact": bad.withColumn("id", F.lit("x"))}, _checks)
    assert ledger.facts().count() == before


def test_a_run_is_held_against_the_rows_it_touches(ledger):
    from factspan.plans.pipelines import _checks, _touched, audit_ledger

    assert all(x.isEmpty() for x in audit_ledger(ledger.tables).values())
    live = ledger.facts().where("superseded_at is null").limit(1)
    with pytest.raises(ValueError, match="one_current_per_source"):
        ledger.tables.commit("9-two", {"fact": live.withColumn("id", F.lit("y")), "fact_supersession": ledger.tables.read("fact_supersession").limit(0)}, _checks)
    heir = live.withColumns({"supersedes_fact_id": F.lit("nowhere"), "supersession_reason": F.lit("unknown"), "field_key": F.lit("other"), "id": F.lit("z")})
    with pytest.raises(ValueError, match="supersession_targets"):
        ledger.tables.commit("9-heir", {"fact": heir}, _checks)
    key = live.first()
    near = _touched(ledger.tables.read("fact"), live, ledger.tables.read("fact_supersession").limit(0))
    assert {(r.parcel_id, r.field_key) for r in near.collect()} == {(key.parcel_id, key.field_key)}


def test_a_run_that_missed_another_fails(ledger):
    known = ledger.tables.runs()
    with pytest.raises(ValueError, match="has not seen"):
        ledger.tables.commit("9-late", {}, None, known[:-1])
    assert ledger.tables.runs() == known


def test_reload_changes_nothing(ledger, spark):
    before = ledger.facts().count(), ledger.exceptions().count()
    load_parcels(ledger, spark.createDataFrame(A, "feature_id string, apn string, geometry string"), "src.parcels", "snap3", "3-1", F.lit("2026-01-04").cast("timestamp"))
    assert (ledger.facts().count(), ledger.exceptions().count()) == before


def test_bad_features_abort(ledger, spark):
    for rows in ([("", "1", geometry(0, 0))], [("1", "1", geometry(0, 0))] * 2):
        with pytest.raises(ValueError):
            load_parcels(ledger, spark.createDataFrame(rows, "feature_id string, apn string, geometry string"), "src.parcels", "s", "bad", F.current_timestamp())
