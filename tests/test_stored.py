"""The stored current fact against ranking all facts anew, and what runs tell of themselves."""

import json
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from factspan.operators import stored
from factspan.operators.current import current_fact_at
from factspan.plans import pipelines
from factspan.plans.pipelines import SCHEMAS, Ledger, load_parcels, refresh_current, stored_current
from factspan.plans.vocabulary import ordinal
from factspan.sources.tables import Tables

DAY = datetime(2026, 1, 1)
FEATURES = "feature_id string, apn string, geometry string"


def at(day, hour=0):
    return F.lit(str(DAY + timedelta(days=day, hours=hour))).cast("timestamp")


def ranked(ledger, rank, now):
    return current_fact_at(ledger.facts(), rank, now, confidence=ordinal("confidence_level", F.col("confidence")))


def same(ledger, rank, now):
    held = lambda df: sorted((r.parcel_id, r.field_key, r.id) for r in df.collect())
    got = held(stored_current(ledger))
    assert got == held(ranked(ledger, rank, now)) and got
    return len(got)


def test_refreshes_equal_ranking_all_facts(spark):
    rank = spark.createDataFrame([("apn", "src", 1)], "field_key string, source_id string, rank int")
    ledger = Ledger(Tables(spark, tempfile.mkdtemp(prefix="spark-"), SCHEMAS), "here")
    a = [(str(k), f"A{k}", f'{{"g":{k}}}') for k in range(6)]
    b = [(str(k), "?" if k == 2 else f"B{k % 3}", f'{{"g":{k}}}') for k in range(1, 8)]
    for n, rows in enumerate((a, b, a)):
        load_parcels(ledger, spark.createDataFrame(rows, FEATURES), "src", f"snap{n}", f"{n}-1", at(n, 1))
        refresh_current(ledger, rank, f"{n}-2", at(n, 2))
        same(ledger, rank, at(n, 2))
    log = ledger.tables.read("current_fact")
    # the last load changed six entities' identifiers: what it left alone was not ranked again
    third = log.where(F.col("event_at") == at(2, 2))
    assert third.where("field_key = 'geometry'").count() <= 1 and third.count() < log.where(F.col("event_at") == at(0, 2)).count()
    # a refresh without news writes nothing
    refresh_current(ledger, rank, "3-2", at(3, 2))
    assert ledger.tables.read("current_fact", ["3-2"]).isEmpty()
    metrics = {r.id: json.loads(r.metrics) for r in ledger.tables.read("job_run").where("job_key = 'parcels'").collect()}
    assert metrics["0-1"] == {"new": 6, "seen": 0, "reappeared": 0, "disappeared": 0, "apn_resolvable": 6, "apn_unresolvable": 0, "apn_unresolvable_reasons": {"blank": 0, "placeholder": 0}, "facts": {"inserted": 18, "superseded": 0, "retired": 0, "unchanged": 0, "changed_fields": {"apn": 0, "geometry": 0, "source_parcel_id": 0}}}
    assert metrics["1-1"]["new"] == 2 and metrics["1-1"]["disappeared"] == 1 and metrics["1-1"]["apn_unresolvable_reasons"] == {"blank": 0, "placeholder": 1}
    assert metrics["1-1"]["facts"]["retired"] == 1 and metrics["1-1"]["facts"]["changed_fields"] == {"apn": 4, "geometry": 0, "source_parcel_id": 0}
    assert metrics["2-1"]["reappeared"] == 1 and metrics["2-1"]["disappeared"] == 2


def test_time_passes(spark, frame):
    """Facts that begin and end to be in effect on their own: the calendar alone brings them in."""
    rng, rows = random.Random(2), []
    for k in range(300):
        recorded = DAY + timedelta(days=rng.randint(0, 20))
        begins = recorded + timedelta(days=rng.choice([-3, 0, 2, 7]))
        ends = rng.choice([None, begins + timedelta(days=rng.randint(1, 9))])
        gone = rng.choice([None, None, recorded + timedelta(days=rng.randint(1, 9))])
        rows.append((k, rng.randint(0, 30), rng.choice("ab"), rng.choice("st"), rng.randint(1, 2), recorded, begins, ends, recorded, gone))
    facts = frame(rows, "id long, parcel_id long, field_key string, source_id string, confidence_ord int, retrieved_at timestamp, effective_from timestamp, effective_to timestamp, recorded_at timestamp, superseded_at timestamp")
    rank = frame([("a", "t", 1)], "field_key string, source_id string, rank int")
    log, since = None, at(-1)
    for day in (3, 4, 9, 15, 40):
        now = at(day)
        keys = stored.due(stored.calendar(facts, since), since, now)
        changed = stored.refresh(facts, rank, keys, now).checkpoint()
        log, since = (changed if log is None else log.unionByName(changed)), now
        held = lambda df: sorted((r.parcel_id, r.field_key, r.id) for r in df.collect())
        assert held(stored.latest(log)) == held(current_fact_at(facts, rank, now))
    assert changed.select("parcel_id", "field_key").distinct().count() < 62


def test_a_failed_refresh_and_a_failed_load_leave_a_row_and_lose_nothing(spark, monkeypatch):
    rank = spark.createDataFrame([], "field_key string, source_id string, rank int")
    ledger = Ledger(Tables(spark, tempfile.mkdtemp(prefix="spark-"), SCHEMAS), "here")
    load_parcels(ledger, spark.createDataFrame([("1", "A", "{}")], FEATURES), "src", "s", "0-1", at(0))
    real = pipelines.stored.refresh
    monkeypatch.setattr(pipelines.stored, "refresh", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("no lock")))
    with pytest.raises(RuntimeError):
        refresh_current(ledger, rank, "0-2", at(0, 1))
    monkeypatch.setattr(pipelines.stored, "refresh", real)
    with pytest.raises(ValueError):
        load_parcels(ledger, spark.createDataFrame([(" ", "A", "{}")], FEATURES), "src", "s", "0-3", at(0, 2))
    jobs = {r.id: (r.job_key, r.status, r.error) for r in ledger.tables.read("job_run").collect()}
    assert jobs["0-1"] == ("parcels", "succeeded", None)
    assert jobs["0-2.failed"] == ("current_fact", "failed", "RuntimeError: no lock")
    assert jobs["0-3.failed"][1:] == ("failed", "ValueError: a feature id is blank or repeated")
    refresh_current(ledger, rank, "0-4", at(0, 3))
    assert same(ledger, rank, at(0, 3)) == 3


def test_facts_with_unwritten_columns_are_refused(spark):
    ledger = Ledger(Tables(spark, tempfile.mkdtemp(prefix="spark-"), SCHEMAS), "here")
    one = spark.range(1).select(F.lit("p").alias("parcel_id"), F.lit("here").alias("jurisdiction_id"), F.lit("zone").alias("field_key"), F.lit('"R"').alias("value"), F.lit("bulk").alias("method"), F.lit("s").alias("source_id"), F.lit("snap").alias("snapshot_id"), at(0).alias("retrieved_at"), F.lit("u").alias("source_url"), F.lit("open").alias("licence_id"), F.lit("high").alias("confidence"), F.lit("r").alias("confidence_rule_id"), at(0).alias("effective_from"), F.lit("p@1").alias("pack_version"))
    for extra in ("unit", "effective_to", "nonsense"):
        with pytest.raises(ValueError, match=extra):
            pipelines.insert_facts(ledger, one.withColumn(extra, F.lit("x")), "0", at(0))
    with pytest.raises(ValueError, match="value"):
        pipelines.insert_facts(ledger, one.drop("value"), "0", at(0))
    pipelines.insert_facts(ledger, one, "1", at(0))
    with pytest.raises(ValueError, match="one_current_per_source"):
        pipelines.insert_facts(ledger, one, "2", at(1))
    heir = one.withColumns({"value": F.lit('"S"'), "supersedes_fact_id": F.lit(ledger.facts().first().id), "supersession_reason": F.lit("world_change")})
    pipelines.insert_facts(ledger, heir, "3", at(1))
    assert sorted((r.value, r.superseded_at is None) for r in ledger.facts().collect()) == [('"R"', False), ('"S"', True)]


def test_geometry_is_flagged_and_cleared(spark):
    from factspan.functions import geo

    ledger = Ledger(Tables(spark, tempfile.mkdtemp(prefix="spark-"), SCHEMAS), "here")
    shape = lambda *ring: json.dumps({"type": "Polygon", "coordinates": [[list(p) for p in ring]]})
    square = lambda x, d=2: shape((x, 0), (x + d, 0), (x + d, d), (x, d), (x, 0))
    bow = shape((10, 0), (12, 2), (12, 0), (10, 2), (10, 0))
    zones = lambda *polygons: spark.createDataFrame([(f"z{k}", [[[[float(a), float(b)] for a, b in ring]]]) for k, ring in enumerate(polygons)], f"zone_id string, geom {geo.MULTIPOLYGON}")
    bent, fine = ((-5, -5), (5, 5), (5, -5), (-5, 15), (-5, -5)), ((-5, -5), (5, -5), (5, 5), (-5, 5), (-5, -5))
    for n, (middle, ring) in enumerate(((bow, bent), (bow, bent), (square(10), fine))):
        load_parcels(ledger, spark.createDataFrame([("1", "A", square(-3)), ("2", "B", middle)], FEATURES), "src", f"s{n}", f"{n}-1", at(n))
        pipelines.flag_geometry(ledger, zones(ring), "src", "zoning", f"{n}-2", at(n, 1))
    parcel = {r.source_feature_id: r.parcel_id for r in ledger.identity().collect()}
    got = sorted((r.detector_key, r.parcel_id, r.reason, r.outcome) for r in ledger.exceptions().where("detector_key like '%geometry'").collect())
    assert got == [("parcel_geometry", parcel["2"], "self_intersection", "condition_cleared"), ("zoning_geometry", parcel["1"], "self_intersection", "condition_cleared")]
    assert [json.loads(r.metrics) for r in ledger.tables.read("job_run").where("job_key = 'geometry'").orderBy("id").collect()] == [{"parcel_geometry": 1, "zoning_geometry": 1}] * 2 + [{"parcel_geometry": 0, "zoning_geometry": 0}]
