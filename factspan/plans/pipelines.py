"""Loading a source: snapshot in, facts, supersessions, identities and exceptions out.

Each load reads the ledger's committed state, reconciles one verified snapshot with it, and
commits all tables of its run at once. ``run_ts`` is one moment: what a run supersedes ends
exactly where the successor begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from factspan.functions import geo
from factspan.functions.json import payload_text
from factspan.functions.text import canonical_identifier, derived_id, snapshot_id, unresolvable_reason
from factspan.operators import exceptions as exc
from factspan.operators import derive, match, reconcile, spatial, stored, validate
from factspan.operators.current import live
from factspan.plans.vocabulary import ENUMS, EXCEPTION, FACT, IDENTITY, ordinal
from factspan.sources.tables import Tables, cut, facts_as_of_now

SCHEMAS = {
    "fact": FACT,
    "fact_supersession": "fact_id string, superseded_at timestamp",
    "parcel": "id string, jurisdiction_id string, first_seen_at timestamp",
    "identity_event": IDENTITY + ", event_at timestamp",
    "exception_event": EXCEPTION + ", reason string, event_at timestamp",
    "snapshot": "id string, source_id string, object_uri string, content_hash string, media_type string, byte_size long, http_status int, fetched_at timestamp",
    "property_file": "id string, parcel_id string, jurisdiction_id string, channel string, status string, composed_at timestamp, as_of timestamp, ruleset_version string, geometry_tier_used boolean, refusals string, payload string, payload_hash string, unmet_fields array<string>, election string",
    "property_file_fact": "property_file_id string, fact_id string, use string, parcel_id string",
    "job_run": "id string, job_key string, source_id string, kind string, status string, started_at timestamp, finished_at timestamp, snapshot_id string, rows_in long, error string, metrics string",
    "current_fact": FACT + ", held boolean, event_at timestamp",
    "fact_calendar": "parcel_id string, field_key string, at timestamp",
    "refreshed_run": "run string",
}


class Ledger:
    """The committed state of a ledger and the context of one source's run."""

    def __init__(self, tables: Tables, jurisdiction: str, licence: str = "open", pack: str = "pack@1"):
        self.tables, self.jurisdiction, self.licence, self.pack = tables, jurisdiction, licence, pack

    def facts(self) -> DataFrame:
        return facts_as_of_now(self.tables.read("fact"), self.tables.read("fact_supersession"))

    def live(self, source: str, *fields: str) -> DataFrame:
        return live(self.facts(), source, *fields)

    def exceptions(self) -> DataFrame:
        return exc.fold(self.tables.read("exception_event"))

    def identity(self) -> DataFrame:
        from factspan.operators.current import top_per_group

        return top_per_group(self.tables.read("identity_event"), ["source_id", "source_feature_id"], [F.col("event_at").desc()]).drop("event_at")

    def new_facts(self, rows: DataFrame, source: str, snapshot: str, run_ts: Column) -> DataFrame:
        """rows(parcel_id, field_key, value, supersedes_fact_id, supersession_reason) as facts."""
        given = {
            "id": derived_id(F.col("parcel_id"), F.col("field_key"), F.lit(source), F.lit(snapshot), run_ts), "source_id": F.lit(source), "snapshot_id": F.lit(snapshot),
            "source_url": F.lit(snapshot), "method": F.lit("bulk"), "retrieved_at": run_ts, "effective_from": run_ts, "recorded_at": run_ts, "licence_id": F.lit(self.licence),
            "confidence": F.lit("high"), "confidence_rule_id": F.lit("bulk.v1"), "conflict": F.lit("agree"), "pack_version": F.lit(self.pack), "jurisdiction_id": F.lit(self.jurisdiction),
        }
        kept = {"parcel_id", "field_key", "value", "supersedes_fact_id", "supersession_reason"}
        out = rows.select(*kept).withColumns(given)
        schema = self.tables.spark.createDataFrame([], FACT).schema
        return out.select(*[(F.col(f.name) if f.name in out.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    def exception_events(self, found: DataFrame, closed: DataFrame, detector: str, version: str, run_ts: Column) -> DataFrame:
        """Openings of found(parcel_id, reason, type, severity), linked to what they reopen, and closings."""
        schema = self.tables.spark.createDataFrame([], SCHEMAS["exception_event"]).schema
        before = self.exceptions().where(F.col("detector_key") == detector)
        ended = before.where("outcome <> 'open'").select("id", "parcel_id", "reason", "resolved_at").unionByName(closed.select("id", "parcel_id", "reason", "resolved_at"))
        opened = found.withColumns({"id": derived_id(F.col("parcel_id"), F.col("reason"), F.lit(detector), run_ts), "jurisdiction_id": F.lit(self.jurisdiction), "detector_key": F.lit(detector), "detector_version": F.lit(version), "detected_at": run_ts, "outcome": F.lit("open"), "detail": F.to_json(F.struct("reason")), "event_at": run_ts})
        links = exc.relink_reopened(opened, ended, [F.col("resolved_at").desc(), F.col("id")])
        opened = opened.join(links, "id", "left").withColumnRenamed("prior", "reopened_from_id")
        shape = lambda df: df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        return shape(opened).unionByName(shape(closed.withColumn("event_at", run_ts)))


def _apply(ledger: Ledger, steps: DataFrame, source: str, snapshot: str, run_ts: Column, fields: tuple[str, ...]) -> tuple[dict[str, DataFrame], dict]:
    """Facts, supersessions and coming dates that ``successors``' instructions ask for, decided once, and their counts."""
    did = lambda action: F.col("action") == action
    flags = {"inserted": did("insert"), "superseded": did("supersede"), "retired": did("retire"), "unchanged": did("keep")}
    steps, counts = counted(steps, flags | {f"changed_fields/{f}": did("supersede") & (F.col("field_key") == f) for f in fields})
    fact = ledger.new_facts(steps.where("action in ('insert', 'supersede')"), source, snapshot, run_ts)
    return {
        "fact": fact,
        "fact_supersession": steps.where("action in ('supersede', 'retire')").select(F.col("live_id").alias("fact_id"), run_ts.alias("superseded_at")),
        "fact_calendar": stored.calendar(fact, run_ts),
    }, counts


def counted(rows: DataFrame, flags: dict[str, Column]) -> tuple[DataFrame, dict]:
    """``rows``, written once, and for how many of them each condition holds, observed in that very pass.

    A name with a slash is a member of a nested object.
    """
    seen, out = Observation(), {}
    rows = cut(rows.observe(seen, F.count("*").alias("rows"), *[F.count_if(c).alias(f"c{k}") for k, c in enumerate(flags.values())]))
    for k, name in enumerate(flags):
        group, _, member = name.rpartition("/")
        (out.setdefault(group, {}) if group else out)[member] = seen.get[f"c{k}"]
    return rows, out


@contextmanager
def recorded(ledger: Ledger, job: str, source: str, run: str, run_ts: Column) -> Iterator[None]:
    """A run that fails leaves a row that says so, in a run of its own: nothing of the failed one becomes visible."""
    try:
        yield
    except Exception as e:
        record_job(ledger, job, source, "failed", f"{run}.failed", run_ts, F.greatest(run_ts, F.current_timestamp()), error=f"{type(e).__name__}: {e}"[:2000])
        raise


def _touched(fact: DataFrame, staged: DataFrame, ended: DataFrame) -> DataFrame:
    """Committed facts that a run may bring into conflict: of an entity and field it writes, or named by it."""
    keys = staged.select("parcel_id", "field_key").distinct()
    ids = staged.select(F.col("supersedes_fact_id").alias("id")).union(ended.select("fact_id")).where("id is not null").distinct()
    return fact.join(keys, ["parcel_id", "field_key"], "left_semi").unionByName(fact.join(keys, ["parcel_id", "field_key"], "left_anti").join(ids, "id", "left_semi"))


def _breaches(fact: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    open_ = exc.fold(events).where("outcome = 'open'")
    return {
        "one_current_per_source": validate.one_current_per_source(fact), "fact_checks": validate.fact_checks(fact), "supersession_targets": validate.supersession_targets(fact),
        "one_open_exception": validate.one_open_exception(open_, ["parcel_id", "detector_key"], F.col("reason")),
    }


def audit_ledger(tables: Tables) -> dict[str, DataFrame]:
    """The breaches of every rule over all committed rows: none in a ledger that only loads have written."""
    return _breaches(facts_as_of_now(tables.read("fact"), tables.read("fact_supersession")), tables.read("exception_event"))


def _checks(tables: Tables, run: str) -> list[str]:
    """What a run breaks: its rows together with the committed rows it touches, so that only these are shuffled.

    Rows that no run touches were checked when they, or what they are at odds with, were committed.
    """
    staged, ended = tables.read("fact", [run]), tables.read("fact_supersession", [run])
    rows = _touched(tables.read("fact"), staged, ended).unionByName(staged)
    log = tables.read("fact_supersession", [*tables.runs(), run])
    fact = cut(facts_as_of_now(rows, log.join(rows.select(F.col("id").alias("fact_id")), "fact_id", "left_semi")))
    told, subject = tables.read("exception_event", [run]), ["parcel_id", "detector_key"]
    events = tables.read("exception_event").alias("e").join(told.select(*subject).distinct().alias("s"), exc.same("e", "s", subject), "left_semi").unionByName(told)
    found = _breaches(fact, events)
    # what an earlier fact supersedes was checked with its own run and need not be among these rows
    found["supersession_targets"] = found["supersession_targets"].join(staged.select("id"), "id", "left_semi")
    return [name for name, rows in found.items() if not rows.isEmpty()]


def _job(ledger: Ledger, job: str, source: str, snapshot: str, run: str, run_ts: Column, rows_in: int, metrics: dict) -> DataFrame:
    return ledger.tables.spark.range(1).select(F.lit(run).alias("id"), F.lit(job).alias("job_key"), F.lit(source).alias("source_id"), F.lit("load").alias("kind"), F.lit("succeeded").alias("status"), run_ts.alias("started_at"), run_ts.alias("finished_at"), F.lit(snapshot).alias("snapshot_id"), F.lit(rows_in).cast("long").alias("rows_in"), F.lit(None).cast("string").alias("error"), F.lit(payload_text(metrics)).alias("metrics"))


def parcel_changes(features: DataFrame, identity: DataFrame, live_facts: DataFrame, source: str) -> dict[str, DataFrame]:
    """What a snapshot of features(feature_id, apn, geometry) changes, given the source's identities and live facts.

    events: every feature with what became of it; here: the features of the snapshot with their
    parcel; steps: what happens to each fact; unresolved and lost: the exceptions it calls for.
    """
    rows = features.select(F.trim("feature_id").alias("source_feature_id"), canonical_identifier(F.col("apn")).alias("apn"), unresolvable_reason(F.col("apn")).alias("problem"), "geometry")
    events = reconcile.identity_events(identity, rows, ["source_feature_id"])
    events = events.withColumn("parcel_id", F.coalesce("parcel_id", derived_id(F.lit(source), F.col("source_feature_id"))))
    here = rows.join(events.where("event <> 'disappeared'"), "source_feature_id")
    value = {"apn": F.when(F.col("problem").isNull(), F.to_json(F.struct(F.col("apn").alias("v")))), "geometry": F.col("geometry"), "source_parcel_id": F.to_json(F.struct(F.col("source_feature_id").alias("v")))}
    fresh = here.select("parcel_id", F.explode(F.array(*[F.struct(F.lit(k).alias("field_key"), v.alias("value")) for k, v in value.items()])).alias("f")).select("parcel_id", "f.*").where("value is not null")
    gone = events.where("event = 'disappeared'").select("parcel_id")
    # facts of features that went away stay believed; only what the snapshot speaks of is compared
    steps = reconcile.successors(live_facts.join(gone, "parcel_id", "left_anti").select("parcel_id", "field_key", "id", "value"), fresh, ["parcel_id", "field_key"], F.lit("unknown"))
    unresolved = here.where("problem is not null").select("parcel_id", F.concat(F.lit("unresolvable_"), F.col("problem")).alias("reason"), F.lit("coverage_gap").alias("type"), F.lit("warning").alias("severity"))
    lost = gone.select("parcel_id", F.lit("feature_disappeared").alias("reason"), F.lit("record_to_ground").alias("type"), F.lit("warning").alias("severity"))
    return {"events": events, "here": here, "steps": steps, "unresolved": unresolved, "lost": lost}


def zoning_changes(points: DataFrame, polygons: DataFrame, live_facts: DataFrame, cell: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """(steps, told): what happens to each parcel's district facts, and what there is to say of its match."""
    found = spatial.classified(points, polygons, "geom", "x", "y", "parcel_id", "zone_id", "zoning", "abbreviation", cell=cell)
    found = cut(found.select("parcel_id", "kind", "n_cand", "zoning", "abbreviation"))  # both results read it; lists of polygons are not needed
    text = lambda c: F.to_json(F.struct(F.col(c).alias("v")))
    fresh = found.where("kind = 'matched'").select("parcel_id", F.explode(F.array(F.struct(F.lit("zoning.district").alias("field_key"), text("zoning").alias("value")), F.struct(F.lit("zoning.district_verbatim").alias("field_key"), F.when(F.col("abbreviation").isNotNull(), text("abbreviation")).alias("value")))).alias("f")).select("parcel_id", "f.*").where("value is not null")
    steps = reconcile.successors(live_facts.select("parcel_id", "field_key", "id", "value"), fresh, ["parcel_id", "field_key"], F.lit("unknown"))
    reason = F.when(F.col("kind") == "zero_match", "no_containing_district").when(F.col("kind") == "ambiguous", "multiple_containing_districts").when(F.col("n_cand") > 1, "multiple_polygons_agree")
    told = found.withColumn("reason", reason).where("reason is not null").select("parcel_id", "reason", F.lit("cross_source").alias("type"), F.when(F.col("kind") == "matched", "info").otherwise("warning").alias("severity"))
    return steps, told


def permit_changes(permits: DataFrame, apn: DataFrame, live_facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(steps, matched) for permits(raw, issued) and apn(parcel_id, apn): a parcel that drops out turns from true to false, once."""
    matched = match.match(permits, "raw", apn, "apn", "parcel_id")
    first = matched.where("cls = 'matched'").groupBy(F.col("entity").alias("parcel_id")).agg(F.min("issued").alias("first"))
    both = live_facts.where("field_key = 'permits.active'").select("parcel_id").join(first, "parcel_id", "full")
    value = {"permits.active": F.when(F.col("first").isNotNull(), "true").otherwise("false"), "permits.series_earliest": F.when(F.col("first").isNotNull(), F.to_json(F.struct(F.col("first").cast("string").alias("v"))))}
    fresh = both.select("parcel_id", F.explode(F.array(*[F.struct(F.lit(k).alias("field_key"), v.alias("value")) for k, v in value.items()])).alias("f")).select("parcel_id", "f.*").where("value is not null")
    return reconcile.successors(live_facts.select("parcel_id", "field_key", "id", "value"), fresh, ["parcel_id", "field_key"], F.lit("world_change")), matched


def load_parcels(ledger: Ledger, features: DataFrame, source: str, snapshot: str, run: str, run_ts: Column) -> None:
    """features(feature_id, apn, geometry as JSON text): parcels, identities, their facts and gaps.

    A feature id may not be blank or repeated: the load fails. A feature that comes back is the
    same parcel. An identifier that can no longer be resolved ends without a successor and
    leaves a coverage gap; one that can be again is a new fact and closes the gap.
    """
    with recorded(ledger, "parcels", source, run, run_ts):
        _load_parcels(ledger, features, source, snapshot, run, run_ts)


def _load_parcels(ledger: Ledger, features: DataFrame, source: str, snapshot: str, run: str, run_ts: Column) -> None:
    ids = features.select(F.trim("feature_id").alias("feature_id"))
    if not ids.where("feature_id is null or feature_id = ''").isEmpty() or not validate.unique(ids, ["feature_id"]).isEmpty():
        raise ValueError("a feature id is blank or repeated")
    known = ledger.tables.runs()
    changes = parcel_changes(features, ledger.identity().where(F.col("source_id") == source), ledger.live(source, "apn", "geometry", "source_parcel_id"), source)
    events, here, steps, unresolved, lost = (changes[k] for k in ("events", "here", "steps", "unresolved", "lost"))
    became = lambda *e: F.col("event").isin(*e)
    problems = here.select("source_feature_id", "problem")
    events, met = counted(events.join(problems, "source_feature_id", "left"), {
        "new": became("new"), "seen": became("seen"), "reappeared": became("reappeared"), "disappeared": became("disappeared"),
        "apn_resolvable": ~became("disappeared") & F.col("problem").isNull(), "apn_unresolvable": F.col("problem").isNotNull(),
        **{f"apn_unresolvable_reasons/{r}": F.col("problem") == r for r in ("blank", "placeholder")}})
    own = ledger.exceptions().where("detector_key = 'parcels'")
    still = unresolved.select("parcel_id", "reason").unionByName(lost.select("parcel_id", "reason"))
    away = ledger.identity().where((F.col("source_id") == source) & F.col("retired_at").isNotNull()).join(here.select("source_feature_id"), "source_feature_id", "left_anti")
    still = still.unionByName(away.select("parcel_id", F.lit("feature_disappeared").alias("reason")))
    closed = exc.close_resolved(own, still, run_ts)
    opened = exc.not_yet_open(unresolved.unionByName(lost), own)
    seen = ["first_seen_snapshot_id", "first_seen_at", "last_seen_snapshot_id", "last_seen_at"]
    identity = events.join(ledger.identity().where(F.col("source_id") == source).select("source_feature_id", *seen), "source_feature_id", "left")  # a feature seen again is touched too
    out = F.col("event") == "disappeared"
    identity = identity.select(
        F.lit(source).alias("source_id"), "source_feature_id", "parcel_id", F.coalesce("first_seen_snapshot_id", F.lit(snapshot)).alias("first_seen_snapshot_id"), F.coalesce("first_seen_at", run_ts).alias("first_seen_at"),
        F.when(out, F.col("last_seen_snapshot_id")).otherwise(snapshot).alias("last_seen_snapshot_id"), F.when(out, F.col("last_seen_at")).otherwise(run_ts).alias("last_seen_at"), F.when(out, F.lit(snapshot)).alias("retired_snapshot_id"), F.when(out, run_ts).alias("retired_at"), F.when(out, F.lit("absent")).alias("retirement_reason"), run_ts.alias("event_at"))
    tables, counts = _apply(ledger, steps, source, snapshot, run_ts, ("apn", "geometry", "source_parcel_id"))
    tables |= {
        "parcel": events.where("event = 'new'").select(F.col("parcel_id").alias("id"), F.lit(ledger.jurisdiction).alias("jurisdiction_id"), run_ts.alias("first_seen_at")),
        "identity_event": identity,
        "exception_event": ledger.exception_events(opened, closed, "parcels", "1", run_ts),
        "job_run": _job(ledger, "parcels", source, snapshot, run, run_ts, met["apn_resolvable"] + met["apn_unresolvable"], met | {"facts": counts}),
    }
    ledger.tables.commit(run, tables, _checks, known)


def centroids(ledger: Ledger, source: str) -> DataFrame:
    """(parcel_id, x, y) of the live geometry facts."""
    g = ledger.live(source, "geometry").select("parcel_id", F.get_json_object("value", "$.type").alias("k"), F.get_json_object("value", "$.coordinates").alias("c"))
    centre = geo.centroid(geo.multipolygon(F.col("k"), F.col("c")))
    return g.withColumn("p", centre).select("parcel_id", "p.x", "p.y")


def load_zoning(ledger: Ledger, polygons: DataFrame, parcel_source: str, source: str, snapshot: str, run: str, run_ts: Column) -> None:
    """polygons(zone_id, zoning, abbreviation, geom): the district of every parcel, all anew.

    It depends on parcels too, so an unchanged snapshot is reconciled all the same.
    """
    with recorded(ledger, "zoning", source, run, run_ts):
        _load_zoning(ledger, polygons, parcel_source, source, snapshot, run, run_ts)


def _load_zoning(ledger: Ledger, polygons: DataFrame, parcel_source: str, source: str, snapshot: str, run: str, run_ts: Column) -> None:
    known, points = ledger.tables.runs(), centroids(ledger, parcel_source)
    polygons, n = counted(polygons, {"polygons": F.lit(True)})
    steps, told = zoning_changes(points, polygons, ledger.live(source, "zoning.district", "zoning.district_verbatim"))
    reasons = ("no_containing_district", "multiple_containing_districts", "multiple_polygons_agree")
    told, found = counted(told, {f"matches/{r}": F.col("reason") == r for r in reasons})
    own = ledger.exceptions().where("detector_key = 'zoning'")
    closed = exc.close_resolved(own, told, run_ts)
    opened = exc.not_yet_open(told, own)
    tables, counts = _apply(ledger, steps, source, snapshot, run_ts, ("zoning.district", "zoning.district_verbatim"))
    tables |= {"exception_event": ledger.exception_events(opened, closed, "zoning", "2", run_ts), "job_run": _job(ledger, "zoning", source, snapshot, run, run_ts, n["polygons"], found | {"facts": counts})}
    ledger.tables.commit(run, tables, _checks, known)


def load_permits(ledger: Ledger, permits: DataFrame, parcel_source: str, source: str, snapshot: str, run: str, run_ts: Column) -> DataFrame:
    """permits(raw, issued): whether a parcel has an active permit, and since when. Returns the losses.

    A parcel that drops out of the list turns from true to false, once; its earliest date ends.
    """
    with recorded(ledger, "permits", source, run, run_ts):
        return _load_permits(ledger, permits, parcel_source, source, snapshot, run, run_ts)


def _load_permits(ledger: Ledger, permits: DataFrame, parcel_source: str, source: str, snapshot: str, run: str, run_ts: Column) -> DataFrame:
    known = ledger.tables.runs()
    apn = ledger.live(parcel_source, "apn").select("parcel_id", F.get_json_object("value", "$.v").alias("apn"))
    steps, matched = permit_changes(permits, apn, ledger.live(source, "permits.active", "permits.series_earliest"))
    matched, met = counted(matched, {f"rows/{c}": F.col("cls") == c for c in ("blank", "not_found", "ambiguous", "matched")})
    tables, counts = _apply(ledger, steps, source, snapshot, run_ts, ("permits.active", "permits.series_earliest"))
    ledger.tables.commit(run, tables | {"job_run": _job(ledger, "permits", source, snapshot, run, run_ts, sum(met["rows"].values()), met | {"facts": counts})}, _checks, known)
    return match.breakdown(matched, "issued")


def _shaped(ledger: Ledger, table: str, rows: DataFrame) -> DataFrame:
    schema = ledger.tables.spark.createDataFrame([], SCHEMAS[table]).schema
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def record_snapshots(ledger: Ledger, fetched: DataFrame, run: str) -> None:
    """fetched(source_id, object_uri, content_hash, media_type, byte_size, http_status, fetched_at): the snapshots not known yet.

    The id is made of source and content, so fetching the same content again adds nothing.
    """
    rows = _shaped(ledger, "snapshot", fetched.withColumn("id", snapshot_id(F.col("source_id"), F.col("content_hash"))))
    if not validate.table_checks("snapshot", rows, "id").isEmpty():
        raise ValueError("a snapshot breaks a rule of its table")
    ledger.tables.commit(run, {"snapshot": reconcile.insert_if_absent(ledger.tables.read("snapshot"), rows, ["id"])}, lambda *_: [])


def record_job(ledger: Ledger, job: str, source: str, status: str, run: str, started: Column, finished: Column | None = None, kind: str = "load", metrics: dict | None = None, error: str | None = None) -> None:
    """A run that began, was skipped or failed; what loads succeed is committed with their rows."""
    if status not in ENUMS["job_status"] or (status == "running") != (finished is None):
        raise ValueError("a run ends unless it is running")
    row = ledger.tables.spark.range(1).select(F.lit(run).alias("id"), F.lit(job).alias("job_key"), F.lit(source).alias("source_id"), F.lit(kind).alias("kind"), F.lit(status).alias("status"), started.alias("started_at"), (F.lit(None) if finished is None else finished).alias("finished_at"), F.lit(error).alias("error"), F.lit(payload_text(metrics) if metrics else None).alias("metrics"))
    ledger.tables.commit(run, {"job_run": _shaped(ledger, "job_run", row)}, lambda *_: [])


def record_files(ledger: Ledger, files: DataFrame, links: DataFrame, run: str, run_ts: Column, as_of: Column) -> None:
    """What ``compose`` gave: the files that have a status, and a link for every fact that one touched."""
    made = files.where("status is not null").withColumns({"id": derived_id(F.col("request_id"), run_ts), "composed_at": run_ts, "as_of": as_of, "refusals": F.to_json("refusals")})
    held = links.join(made.select("request_id", F.col("id").alias("property_file_id"), "parcel_id"), "request_id")
    rows = {"property_file": _shaped(ledger, "property_file", made), "property_file_fact": _shaped(ledger, "property_file_fact", held)}
    counted = rows["property_file"].select("id", "status", "election", F.size(F.from_json("refusals", "array<struct<code:string>>")).alias("n_refusals"), F.size("unmet_fields").alias("n_unmet"), F.lit(None).cast("timestamp").alias("delivered_at"), F.lit(0).alias("compose_ms"))
    broken = validate.table_checks("property_file", counted, "id").where("violates <> 'election'")
    if not broken.isEmpty():
        raise ValueError("a file breaks a rule of its table")
    ledger.tables.commit(run, rows, lambda *_: [])


def refresh_current(ledger: Ledger, source_rank: DataFrame, run: str, now: Column) -> None:
    """Bring the stored current facts up to ``now``.

    Looked at again are the entities and fields of the facts and supersessions in runs that no
    refresh has seen, and those with a date in the calendar since the last one. It is a run of its
    own: where it fails, what the loads committed stays, and the next one finds the same runs.
    """
    with recorded(ledger, "current_fact", "ledger", run, now):
        tables, known = ledger.tables, ledger.tables.runs()
        seen = {r.run for r in tables.read("refreshed_run").collect()}  # a row per run
        new = [r for r in known if r not in seen]
        facts = ledger.facts()
        ended = facts.join(tables.read("fact_supersession", new).select(F.col("fact_id").alias("id")), "id", "left_semi")
        since = F.coalesce(F.lit(tables.read("current_fact").agg(F.max("event_at")).first()[0]), F.lit("0001-01-01")).cast("timestamp")
        keys = [df.select("parcel_id", "field_key") for df in (tables.read("fact", new), ended, stored.due(tables.read("fact_calendar"), since, now))]
        changed, met = counted(stored.refresh(facts, source_rank, keys[0].unionByName(keys[1]).unionByName(keys[2]), now, confidence=ordinal("confidence_level", F.col("confidence"))), {"held": F.col("held"), "none": ~F.col("held")})
        rows = {"current_fact": changed, "refreshed_run": tables.spark.createDataFrame([(r,) for r in new], "run string"), "job_run": _job(ledger, "current_fact", "ledger", None, run, now, met["held"] + met["none"], met).withColumn("kind", F.lit("refresh"))}
        tables.commit(run, rows, lambda *_: [], known)


def stored_current(ledger: Ledger) -> DataFrame:
    """The current facts as of the last refresh."""
    return stored.latest(ledger.tables.read("current_fact"))


#: The fields of a fact that a writer gives; the ledger sets the others.
WRITTEN = (
    "parcel_id", "jurisdiction_id", "field_key", "value", "method", "source_id", "snapshot_id", "retrieved_at", "source_url", "licence_id",
    "confidence", "confidence_rule_id", "effective_from", "pack_version", "local_verbatim", "supersedes_fact_id", "supersession_reason",
)


def insert_facts(ledger: Ledger, rows: DataFrame, run: str, run_ts: Column) -> None:
    """Commit facts as they are given. A column that would not be written is refused, as is one that lacks.

    Facts without a breach of the tables' rules become visible together, or none does.
    """
    if unwritten := sorted(set(rows.columns) - set(WRITTEN)):
        raise ValueError(f"not written, so refused: {', '.join(unwritten)}")
    if lacking := sorted({"parcel_id", "field_key", "value", "method"} - set(rows.columns)):
        raise ValueError(f"a fact lacks {', '.join(lacking)}")
    known = ledger.tables.runs()
    fact = cut(_shaped(ledger, "fact", rows.withColumns({"id": derived_id(F.col("parcel_id"), F.col("field_key"), F.coalesce(*[F.col(c) for c in ("source_id",) if c in rows.columns], F.lit("derived")), run_ts), "recorded_at": run_ts, "conflict": F.lit("agree")})))
    ended = fact.where("supersedes_fact_id is not null").select(F.col("supersedes_fact_id").alias("fact_id"), run_ts.alias("superseded_at"))
    ledger.tables.commit(run, {"fact": fact, "fact_supersession": ended, "fact_calendar": stored.calendar(fact, run_ts)}, _checks, known)


def flag_geometry(ledger: Ledger, polygons: DataFrame, parcel_source: str, source: str, run: str, run_ts: Column) -> None:
    """Exceptions for geometry that isn't valid: of parcels, and of zoning polygons (zone_id, geom) that parcels lie in.

    A parcel has one open exception of each detector at most. One whose geometry is valid again, or
    that lies in no such polygon any more, has it closed.
    """
    with recorded(ledger, "geometry", source, run, run_ts):
        known = ledger.tables.runs()
        g = ledger.live(parcel_source, "geometry").select("parcel_id", geo.multipolygon(F.get_json_object("value", "$.type"), F.get_json_object("value", "$.coordinates")).alias("geom"))
        own = derive.invalid_geometry(g.where("geom is not null"), "parcel_id", "geom").withColumns({"type": F.lit("record_to_ground"), "severity": F.lit("warning")})
        around = derive.touched_by_invalid(centroids(ledger, parcel_source), polygons.select("zone_id", "geom"), "parcel_id", "zone_id", "geom")
        around = around.select("parcel_id", "reason", F.lit("record_to_ground").alias("type"), F.lit("info").alias("severity"))
        events, metrics = None, {}
        for detector, told in (("parcel_geometry", own), ("zoning_geometry", around)):
            told, met = counted(told, {"invalid": F.lit(True)})
            before = ledger.exceptions().where(F.col("detector_key") == detector)
            rows = ledger.exception_events(exc.not_yet_open(told, before), exc.close_resolved(before, told, run_ts), detector, "1", run_ts)
            events, metrics[detector] = (rows if events is None else events.unionByName(rows)), met["invalid"]
        ledger.tables.commit(run, {"exception_event": events, "job_run": _job(ledger, "geometry", source, None, run, run_ts, sum(metrics.values()), metrics)}, _checks, known)
