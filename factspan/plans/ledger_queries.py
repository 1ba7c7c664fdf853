"""Queries of ledger states, files, audits and geometry over the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspan.functions import geo, json, text, time
from factspan.operators import audit, compose, current, derive, exceptions, golden, measure, reconcile, rights, rules, validate, views
from factspan.plans import pipelines
from factspan.plans import testdata as t
from factspan.plans.catalog import _APN, _LEDGER, _RAW, _VISIBLE, _parcels, _permits
from factspan.plans.registry import query
from factspan.plans.vocabulary import REFUSAL_CODES


def _day(d: str):
    return F.lit(d).cast("timestamp_ntz")


def _text(c: str):
    return F.col(c).cast("string")


def _latest(read) -> DataFrame:
    """The latest event of each user and type, as current facts."""
    rows = read("events").select(F.col("user_id").alias("parcel_id"), F.col("event_type").alias("field_key"), F.col("event_id").alias("id"), "value", "ts")
    return current.top_per_group(rows, ["parcel_id", "field_key"], [F.col("ts").desc(), F.col("id").desc()])


_LATEST = "latest as (select user_id parcel_id, event_type field_key, event_id id, value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1)"


@query(f"with {_LEDGER} select fact_id, entity_id from ledger where superseded_at is null and source_id = 's1' and field_key in ('click', 'view')")
def live_facts(spark, read):
    return current.live(t.ledger(read("events")), "s1", "click", "view").select("fact_id", "entity_id")


@query(f"""with {_LEDGER}, cur as (select *, case when fact_id % 5 <> 0 then fact_id % 500 end snap from ledger where {_VISIBLE})
 select fact_id, c_nationkey parcel_nation, s.source snapshot_source from cur join customer on c_custkey = entity_id left join documents s on s.doc_id = snap""")
def facts_in_context(spark, read):
    seen = t.ledger(read("events")).where(time.visible(_day("2024-01-20"))).withColumn("snapshot_id", F.when(F.col("fact_id") % 5 != 0, F.col("fact_id") % 500))
    parcels, snapshots = read("customer").selectExpr("c_custkey id", "c_nationkey nation"), read("documents").selectExpr("doc_id id", "source")
    return current.with_context(seen, parcels, snapshots, "entity_id").select("fact_id", "parcel_nation", "snapshot_source")


_IDENTIFIER = """select c_custkey k, case when c_custkey % 5 = 0 then null else 'A' || (c_custkey % 7) end was,
 case c_custkey % 4 when 0 then ' ' when 1 then '?' || c_custkey when 2 then '''A' || (c_custkey % 7) else 'A' || (c_custkey % 3) end raw from customer"""


@query(f"""with x as ({_IDENTIFIER}), y as (select k, was, trim(case when substr(trim(raw), 1, 1) = '''' then substr(trim(raw), 2) else trim(raw) end) now from x)
 select k, case when now = '' or contains(now, '?') then case when was is not null then 'degrade' else 'still_unresolvable' end when was is null then 'resolve' when was = now then 'same' else 'change' end change from y""")
def identifier_changes(spark, read):
    k = F.col("c_custkey")
    was = F.when(k % 5 != 0, F.concat(F.lit("A"), (k % 7).cast("string")))
    raw = F.when(k % 4 == 0, " ").when(k % 4 == 1, F.concat(F.lit("?"), k.cast("string"))).when(k % 4 == 2, F.concat(F.lit("'A"), (k % 7).cast("string"))).otherwise(F.concat(F.lit("A"), (k % 3).cast("string")))
    return read("customer").select(k.alias("k"), reconcile.identifier_change(was, text.canonical_identifier(raw), text.unresolvable_reason(raw)).alias("change"))


@query("""with x as (select event_id, event_id % 6 m, case when event_id % 4 <> 0 then event_type end election from events)
 select event_id, m in (1, 5) has_rights, m in (0, 1, 4, 5) valid, not (m = 4 and election is not null) and not (m = 5 and election is null) consistent from x""")
def refusal_shapes(spark, read):
    m = F.col("event_id") % 6
    one = lambda *codes: "[" + ",".join(f'{{"code":"{c}","stage":"L8"}}' for c in codes) + "]"
    refusals = F.when(m == 0, "[]").when(m == 1, one("RIGHTS_BLOCKED")).when(m == 2, one("NOPE")).when(m == 3, '{"code":"RIGHTS_BLOCKED"}').when(m == 4, one("ELECTION_REQUIRED")).otherwise(one("RIGHTS_BLOCKED", "ELECTION_NOT_SUPPORTED"))
    election = F.when(F.col("event_id") % 4 != 0, F.col("event_type"))
    return read("events").select("event_id", json.has_code(refusals, "RIGHTS_BLOCKED").alias("has_rights"), json.codes_valid(refusals, REFUSAL_CODES).alias("valid"), json.election_consistent(election, refusals).alias("consistent"))


_SNAPSHOTS = """snap as (select cast(doc_id as varchar) id, sha256(coalesce(text, '')) h, doc_id % 7 = 0 gone, doc_id % 9 = 0 other, case when doc_id % 5 = 0 then 404 when doc_id % 11 <> 0 then 200 end st from documents),
 bad as (select id, 'unreadable' reason from snap where gone union all select id, 'content_mismatch' from snap where not gone and other union all select id, 'status' from snap where st is distinct from 200)"""


def _snapshots(read):
    k, content = F.col("doc_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    kept = read("documents").where(k % 7 != 0).select(F.concat(F.lit("doc/"), k.cast("string")).alias("object_uri"), content.alias("content"))
    snapshots = read("documents").select(
        k.cast("string").alias("id"), F.concat(F.lit("doc/"), k.cast("string")).alias("object_uri"), F.sha2(F.when(k % 9 == 0, F.lit(b"other")).otherwise(content), 256).alias("content_hash"),
        F.octet_length(content).cast("long").alias("byte_size"), F.when(k % 5 == 0, 404).when(k % 11 != 0, 200).alias("http_status"))
    return audit.flagged_snapshots(snapshots, kept)


@query(f"with {_SNAPSHOTS} select * from bad")
def provenance_audit(spark, read):
    return _snapshots(read)


@query(f"""with {_SNAPSHOTS}, f as (select cast(event_id % 1000 as varchar) snapshot_id, event_type from events)
 select snapshot_id, count(*) n_facts, list_sort(list(distinct event_type)) field_keys from f where snapshot_id in (select id from bad) group by 1""")
def facts_citing_flagged(spark, read):
    facts = read("events").select((F.col("event_id") % 1000).cast("string").alias("snapshot_id"), F.col("event_type").alias("field_key"))
    return audit.facts_citing(facts, _snapshots(read))


@query("""select o_custkey source_id, o_orderkey id from orders where o_orderstatus = 'F' and o_orderkey % 3 <> 0
 qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1""")
def previous_load(spark, read):
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    runs = read("orders").select(F.col("o_custkey").alias("source_id"), k.alias("id"), F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("failed").alias("status"), F.when(k % 3 == 0, "fetch").otherwise("load").alias("kind"), at.alias("started_at"), at.alias("finished_at"))
    return audit.previous_load(runs, ["source_id"]).select("source_id", "id")


@query("select event_id id, event_type detector_key, 'open' outcome from events where value > 300 and event_type = 'click' order by ts desc, event_id limit 500")
def exceptions_filtered(spark, read):
    x = t.exceptions(read("events")).withColumnsRenamed({"reason": "detector_key", "ts": "detected_at"})
    return views.exceptions(x, outcome="open", detector_key="click").select("id", "detector_key", "outcome")


_BRANDS = """lic as (select p_brand id, min(p_size) z from part group by 1), ch as (select id, c.channel, (z + c.n) % 3 <> 0 allowed from lic join (values ('api', 0), ('bulk_export', 1)) c(channel, n) on id <> 'Brand#11')"""


def _brands(read):
    licence = read("part").groupBy(F.col("p_brand").alias("id")).agg(F.min("p_size").alias("z"))
    pairs = F.array(*[F.struct(F.lit(c).alias("channel"), ((F.col("z") + n) % 3 != 0).alias("allowed")) for n, c in enumerate(("api", "bulk_export"))])
    return licence, licence.where("id <> 'Brand#11'").select(F.col("id").alias("licence_id"), F.inline(pairs))


@query(f"with {_BRANDS} select lic.id, coalesce(list_sort(list(channel || ':' || allowed) filter (where channel is not null)), []) channels from lic left join ch using (id) group by 1")
def licence_list(spark, read):
    licence, channels = _brands(read)
    told = F.transform("channels", lambda c: F.concat_ws(":", c["channel"], c["allowed"].cast("string")))
    return views.licences(licence, channels).select("id", F.coalesce(told, F.array().cast("array<string>")).alias("channels"))


@query(f"with {_BRANDS} select * from (select id licence_id, channel, allowed from ch union all select id, c, false from lic, (values ('api'), ('analytics')) n(c) where not exists (select 1 from ch where ch.id = lic.id and channel = c))")
def licences_with_new_channels(spark, read):
    return rights.with_new_channels(*_brands(read), ("api", "analytics"))


@query("""with f as (select o_orderkey id from orders order by o_orderdate desc, o_orderkey limit 200)
 select id, (select list_sort(list(l_partkey)) from lineitem where l_orderkey = id) facts from f""")
def files_with_links(spark, read):
    files = read("orders").selectExpr("o_orderkey id", "o_orderdate composed_at")
    links = read("lineitem").selectExpr("l_orderkey property_file_id", "l_partkey fact_id", "'input' use")
    return views.files(files, links).select("id", F.transform("links", lambda x: x["fact_id"]).alias("facts"))


@query("select l_orderkey property_file_id, list_sort(list('input ' || p_brand || ' ' || p_size)) facts from lineitem join part on p_partkey = l_partkey group by 1")
def golden_links(spark, read):
    links = read("lineitem").selectExpr("l_orderkey property_file_id", "l_partkey fact_id", "'input' use")
    return golden.linked_facts(links, read("part").selectExpr("p_partkey id", "p_brand field_key", "p_size value"))


@query("""select event_id, case event_id % 3 when 0 then '{"at": "<TIME>", "ids": ["<UUID:1>", "<UUID:1>", "<UUID:2>"], "z": {"a": "<UUID:2>"}}' when 1 then '{"a": [1, 2, 3], "b": null}' else 'none' end form from events""")
def golden_normal_form(spark, read):
    k = F.col("event_id")
    uuid = lambda n: F.concat(F.lpad(F.hex(k), 8, "0"), F.lit(f"-0000-0000-0000-{n:012d}"))
    first = F.concat(F.lit('{"z":{"a":"'), uuid(2), F.lit('"},"ids":["'), uuid(1), F.lit('","'), uuid(2), F.lit('","'), F.upper(uuid(1)), F.lit('"],"at":"'), F.col("ts").cast("string"), F.lit('"}'))
    payload = F.when(k % 3 == 0, first).when(k % 3 == 1, '{"b":null,"a":[3,1,2]}').otherwise("none")
    return read("events").select("event_id", golden.normalised(payload).alias("form"))


@query(f"""with {_LATEST}, h as (select parcel_id, max(id) filter (where field_key = 'click') a, max(id) filter (where field_key = 'view') b, max(value) filter (where field_key = 'click') va, max(value) filter (where field_key = 'view') vb from latest group by 1),
 d as (select *, sha256(parcel_id || chr(31) || 'gap' || chr(31) || 'v1' || chr(31) || a || ',' || b) h from h where a is not null and b is not null)
 select substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) id, parcel_id, va - vb as value, i ordinal, case i when 0 then a else b end input_fact_id from d, (values (0), (1)) n(i)""")
def derived_facts(spark, read):
    facts, edges = derive.derive(_latest(read), ["click", "view"], "gap", F.col("click") - F.col("view"), "v1")
    return facts.join(edges, F.col("id") == F.col("fact_id")).select("id", "parcel_id", "value", "ordinal", "input_fact_id")


_CODES = "case o_orderkey % 4 when 0 then null when 1 then 'city' when 2 then 'state' else 'moon' end"
_COMPOSE = f"""{_LATEST}, f as (select latest.*, case when value > 400 then 'closed' else 'open' end lic from latest),
 req as (select o_orderkey request_id, case when o_orderkey % 50 = 0 then -1 else o_custkey end parcel_id, {_CODES} election from orders),
 held as (select parcel_id, count(*) n, list_sort(list(distinct lic) filter (where lic = 'closed')) closed, bool_or(field_key = 'click') has_click from f group by 1),
 x as (select req.*, c_nationkey j, n, closed, coalesce(has_click, false) has_click from req left join customer on c_custkey = req.parcel_id left join held on held.parcel_id = req.parcel_id),
 r as (select *, case when j is null then ['PARCEL_REFERENCE_UNKNOWN'] else list_filter([case when j % 3 <> 0 then 'GEOMETRY_TIER_DISABLED' end, case when n is null then 'PARCEL_NO_FACTS' end,
  case when election is null then 'ELECTION_REQUIRED' when election = 'moon' then 'ELECTION_NOT_SUPPORTED' when election = 'state' and j % 2 = 1 then 'RULE_UNAVAILABLE' end, case when len(closed) > 0 then 'RIGHTS_BLOCKED' end], lambda c: c is not null) end codes from x)"""


def _requests(spark, read, **given):
    k = F.col("o_orderkey")
    election = F.when(k % 4 == 1, "city").when(k % 4 == 2, "state").when(k % 4 == 3, "moon")
    requests = read("orders").select(k.alias("request_id"), F.when(k % 50 == 0, -1).otherwise(F.col("o_custkey")).alias("parcel_id"), election.alias("election"))
    facts = _latest(read).withColumns({"licence_id": F.when(F.col("value") > 400, "closed").otherwise("open"), "snapshot_id": F.lit("s")})
    rule = read("nation").select(F.col("n_nationkey").alias("jurisdiction_id"), F.explode(F.when(F.col("n_nationkey") % 2 == 0, F.array(F.lit("r.city"), F.lit("r.state"))).otherwise(F.array(F.lit("r.city")))).alias("rule_key"))
    rule = rule.withColumns({"version": F.col("jurisdiction_id") % 3 + 1, "effective_from": _day("2020-01-01"), "effective_to": F.lit(None).cast("timestamp_ntz")})
    channels = spark.createDataFrame([("open", "api", True), ("closed", "api", False)], "licence_id string, channel string, allowed boolean")
    places = read("nation").select(F.col("n_nationkey").alias("id"), (F.col("n_nationkey") % 3 == 0).alias("geometry_tier_enabled"))
    return compose.compose(requests, read("customer").selectExpr("c_custkey id", "c_nationkey jurisdiction_id"), facts, channels, places, rule, _day("2024-02-01"), {"city": "r.city", "state": "r.state"}, "api", **given)


@query(f"""with {_COMPOSE} select request_id, codes, case when j is null then null when len(codes) > 0 then 'refused' when not has_click then 'partial' else 'composed' end status,
 case when election in ('city', 'state') and j is not null and not (election = 'state' and j % 2 = 1) then 'r.' || election || '@' || (j % 3 + 1) when j is not null and coalesce(election, 'moon') = 'moon' then 'no rule selected: ' || case when election is null then 'ELECTION_REQUIRED' else 'ELECTION_NOT_SUPPORTED' end end ruleset from r""")
def composed_files(spark, read):
    need = spark.createDataFrame([("click", True, False), ("view", False, False)], "field_key string, required_for_file boolean, phase1_deferred boolean")
    files, _ = _requests(spark, read, definitions=need)
    ruleset = F.when(F.col("jurisdiction_id").isNotNull() & ~F.col("ruleset_version").startswith("no rule effective"), F.col("ruleset_version"))
    return files.select("request_id", F.col("refusals.code").alias("codes"), "status", ruleset.alias("ruleset"))


@query(f"""with {_COMPOSE} select request_id, f.id fact_id, case when len(codes) > 0 then 'input' else 'rendered' end "use" from r join f on f.parcel_id = r.parcel_id where j is not null""")
def file_links(spark, read):
    need = spark.createDataFrame([("click", True, False)], "field_key string, required_for_file boolean, phase1_deferred boolean")
    return _requests(spark, read, definitions=need)[1].select("request_id", "fact_id", "use")


@query(f"""with {_COMPOSE}, p as (select request_id, '{{"attribution": [], "omitted_for_rights": [], "refusals": [{{"code": "PARCEL_REFERENCE_UNKNOWN", "detail": {{"parcel_id": "-1"}}, "message": "no such parcel", "stage": "L0"}}], "status": "refused"}}' t from r where j is null)
 select request_id, sha256(t) h from p""")
def payload_hashes(spark, read):
    """The payload of requests for no known parcel, by the operator's own refusal."""
    files, _ = _requests(spark, read)
    told = F.struct(F.lit("refused").alias("status"), "refusals", F.array().cast("array<string>").alias("attribution"), F.array().cast("array<string>").alias("unmet_fields"), F.create_map().cast("map<string,string>").alias("facts"))
    return files.where("jurisdiction_id is null").select("request_id", compose._payload(told)["payload_hash"].alias("h"))


@query("""with w as (select o_custkey jurisdiction_id, case when o_orderkey % 2 = 0 then 'a' else 'b' end rule_key from orders), rl as (select c_custkey j, k, v from customer, (values ('a', 1), ('a', 2), ('b', 1)) x(k, v) where (c_custkey + v) % 3 <> 0)
 select jurisdiction_id, rule_key, count(*) n, max(v) "version", case when max(v) is null then 'RULE_UNAVAILABLE' end refusal from (select w.*, (select max(v) from rl where j = jurisdiction_id and k = rule_key) v from w) group by 1, 2""")
def rules_selected(spark, read):
    wanted = read("orders").select(F.col("o_custkey").alias("jurisdiction_id"), F.when(F.col("o_orderkey") % 2 == 0, "a").otherwise("b").alias("rule_key"))
    given = F.explode(F.array(*[F.struct(F.lit(k).alias("rule_key"), F.lit(v).alias("version")) for k, v in (("a", 1), ("a", 2), ("b", 1))]))
    held = read("customer").select(F.col("c_custkey").alias("jurisdiction_id"), given.alias("r")).select("jurisdiction_id", "r.*").where("(jurisdiction_id + version) % 3 <> 0").withColumns({"effective_from": _day("2020-01-01"), "effective_to": F.lit(None).cast("timestamp_ntz")})
    return rules.select_rules(wanted, held, _day("2024-01-01")).groupBy("jurisdiction_id", "rule_key").agg(F.count("*").alias("n"), F.max("version").alias("version"), F.max("refusal").alias("refusal"))


@query("""with pack as (select 'here.' || p_partkey id, 'l' || (p_partkey % 4) lic, list_sort(list_distinct([p_brand, p_brand || case when p_partkey % 6 = 0 then 'x' else '' end])) supplies, p_partkey k, p_brand b from part where p_partkey % 10 <> 0 and p_partkey % 8 <> 0),
 j as (select *, k % 7 <> 0 there from pack)
 select id, failure, detail from (
 select id, 'source_missing' failure, '' detail from j where not there union all select id, 'licence_missing', lic from j where lic = 'l3' union all select id, 'licence_differs', 'l0' from j where there and k % 9 = 0 and lic <> 'l0'
 union all select id, 'supplies_unexpected', b || 'x' from j where there and k % 6 = 0 union all select id, 'supplies_lacking', 'more' from j where there and k % 11 = 0 union all select id, 'field_undefined', s from (select id, unnest(supplies) s from j) where not s in (select p_brand from part))""")
def pack_conformance(spark, read):
    k, b, lic = F.col("p_partkey"), F.col("p_brand"), F.concat(F.lit("l"), (F.col("p_partkey") % 4).cast("string"))
    supplies = F.array_distinct(F.array(b, F.concat(b, F.when(k % 6 == 0, "x").otherwise(""))))
    pack = read("part").select(F.concat(F.when(k % 10 == 0, "other.").otherwise("here."), k.cast("string")).alias("id"), F.when(k % 8 == 0, "deferred").otherwise("active").alias("phase_status"), lic.alias("licence"), supplies.alias("supplies"))
    registry = read("part").where(k % 7 != 0).select(F.concat(F.lit("here."), k.cast("string")).alias("id"), F.when(k % 9 == 0, "l0").otherwise(lic).alias("licence_id"), F.when(k % 11 == 0, F.array(b, F.lit("more"))).otherwise(F.array(b)).alias("expected_fields"))
    licences = spark.createDataFrame([("l0",), ("l1",), ("l2",)], "id string")
    return audit.conformance(pack, registry, licences, read("part").select(b.alias("field_key")).distinct(), "here")


@query("""select o_orderkey from orders where o_orderkey % 13 = 0 or o_orderkey % 7 = 0 or o_orderkey % 6 = 0""")
def immutability_breaches(spark, read):
    k = F.col("o_orderkey")
    before = read("orders").select("o_orderkey", "o_totalprice", F.when(k % 2 == 0, F.lit("x")).alias("superseded"))
    after = before.where(k % 13 != 0).select("o_orderkey", (F.col("o_totalprice") + F.when(k % 7 == 0, 1).otherwise(0)).alias("o_totalprice"), F.when((k % 6 == 0) | (k % 2 != 0), F.lit("y")).otherwise(F.col("superseded")).alias("superseded"))
    return validate.changed_rows(before, after, ["o_orderkey"], ("superseded",))


@query("""with f as (select event_id id, event_id % 4 m, event_id % 5 n, event_id % 7 r from events)
 select id, v violates from (select id, case when m = 0 and n = 0 or m <> 0 and n = 1 then 'provenance_complete' end v from f union all select id, case when m = 3 then 'method_automated' end from f union all select id, case when r = 1 then 'supersedes_not_self' end from f
 union all select id, case when r = 2 then 'supersession_reason' end from f union all select id, case when r = 3 then 'transaction_time' end from f union all select id, case when r = 4 then 'valid_time' end from f) where v is not null""")
def fact_rule_breaches(spark, read):
    k, at = F.col("event_id"), F.col("ts")
    derived, day = k % 4 == 0, F.expr("interval '1' day")
    fact = read("events").select(
        k.alias("id"), F.when(derived, "derived").when(k % 4 == 1, "direct").when(k % 4 == 2, "bulk").otherwise("portal").alias("method"), F.when(~derived, "s").alias("source_id"), F.when(~derived & (k % 5 != 1), "snap").alias("snapshot_id"),
        F.when(derived & (k % 5 != 0), "v1").alias("method_version"), at.alias("retrieved_at"), F.lit("u").alias("source_url"), F.when(k % 7 == 1, k).when(k % 7 == 2, k + 1).alias("supersedes_fact_id"), F.when(k % 7 == 1, "unknown").alias("supersession_reason"),
        at.alias("recorded_at"), F.when(k % 7 == 3, at - day).alias("superseded_at"), at.alias("effective_from"), F.when(k % 7 == 4, at).alias("effective_to"))
    return validate.fact_checks(fact)


@query("""with j as (select o_orderkey id, o_orderkey % 6 m from orders) select id, v violates from (select id, case when m = 1 then 'finished_after_started' end v from j union all select id, case when m = 2 then 'rows_in' end from j
 union all select id, case when m = 3 then 'metrics_object' end from j union all select id, case when m in (4, 5) then 'finished_unless_running' end from j) where v is not null""")
def job_run_breaches(spark, read):
    m, at = F.col("o_orderkey") % 6, F.col("o_orderdate")
    rows = read("orders").select(
        F.col("o_orderkey").alias("id"), F.when(m == 4, "running").otherwise("succeeded").alias("status"), at.alias("started_at"), F.when(m == 1, at - F.expr("interval '1' hour")).when(m != 5, at).alias("finished_at"),
        F.when(m == 2, -1).otherwise(5).alias("rows_in"), F.lit(None).cast("long").alias("rows_out"), F.when(m == 3, "[1]").otherwise('{"n": 1}').alias("metrics"))
    return validate.table_checks("job_run", rows, "id")


@query("""with s as (select doc_id id, doc_id % 5 m from documents) select id, v violates from (select id, case when m = 1 then 'content_hash' end v from s union all select id, case when m in (1, 2) then 'id' end from s
 union all select id, case when m = 3 then 'media_type' end from s union all select id, case when m = 4 then 'byte_size' end from s) where v is not null""")
def snapshot_breaches(spark, read):
    m, h = F.col("doc_id") % 5, F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = read("documents").select(
        F.col("doc_id").alias("key"), F.when(m == 1, "short").otherwise(h).alias("content_hash"), F.lit("s").alias("source_id"), F.when(m == 2, h).otherwise(F.concat(F.lit("s:sha256:"), h)).alias("id"),
        F.when(m == 3, "  ").otherwise("text/plain").alias("media_type"), F.when(m == 4, -1).otherwise(1).alias("byte_size"), F.lit("sha256/x").alias("object_uri"))
    return validate.table_checks("snapshot", rows, "key").withColumnRenamed("key", "id")


@query("""with e as (select l_orderkey * 10 + l_linenumber id, l_partkey fact, l_orderkey file from lineitem)
 select id, refers_to from (select id, 'property_file' refers_to from e where not exists (select 1 from orders where o_orderkey = file and o_custkey % 2 = 0) union all select id, 'fact' from e where not exists (select 1 from part where p_partkey = fact and p_size > 10))""")
def link_references(spark, read):
    links = read("lineitem").selectExpr("l_orderkey * 10 + l_linenumber id", "l_orderkey property_file_id", "l_partkey fact_id", "1 parcel_id")
    tables = {"property_file_fact": links, "property_file": read("orders").where("o_custkey % 2 = 0").selectExpr("o_orderkey id", "1 parcel_id"), "fact": read("part").where("p_size > 10").selectExpr("p_partkey id", "1 parcel_id")}
    return validate.broken_references(tables, "property_file_fact", "id")


@query(f"""with {_LEDGER}, o as (select *, lag(fact_id) over (partition by entity_id, field_key order by recorded_at, fact_id) prior, lag(source_id) over (partition by entity_id, field_key order by recorded_at, fact_id) prior_source, lag(superseded_at) over (partition by entity_id, field_key order by recorded_at, fact_id) prior_end from ledger)
 select fact_id id, prior supersedes_fact_id from o where prior is not null and not coalesce(prior_source = source_id and prior_end is not null, false)""")
def supersession_breaches(spark, read):
    from pyspark.sql import Window

    w = Window.partitionBy("entity_id", "field_key").orderBy("recorded_at", "fact_id")
    fact = t.ledger(read("events")).select(F.col("fact_id").alias("id"), F.col("entity_id").alias("parcel_id"), "field_key", "source_id", "superseded_at", F.lit("bulk").alias("method"), F.lag("fact_id").over(w).alias("supersedes_fact_id"))
    return validate.supersession_targets(fact)


@query("""with e as (select l_orderkey fact_id, p_size % 3 k from lineitem join part on p_partkey = l_partkey), own as (select fact_id, fact_id % 3 o from (select distinct l_orderkey fact_id from lineitem)),
 p as (select * from e join own using (fact_id)), ch as (select fact_id, min('c' || c) c from p, (values (0), (1), (2)) n(c) where (o + c) % 3 <> 0 and (k + c) % 3 = 0 group by 1)
 select fact_id, 'channel' dimension, c detail from ch union all select distinct fact_id, 'commercial_use', null from p where o <> 0 and k = 0 union all select distinct fact_id, 'redistribution', null from p where o <> 1 and k = 1 union all select distinct fact_id, 'attribution', null from p where o <> 2 and k = 2""")
def inheritance_breaches(spark, read):
    kind = lambda c: F.concat(F.lit("k"), (c % 3).cast("string"))
    parts = read("part").select(F.concat(F.lit("p"), _text("p_partkey")).alias("id"), kind(F.col("p_size")).alias("licence_id"))
    own = read("lineitem").select(F.concat(F.lit("o"), _text("l_orderkey")).alias("id"), kind(F.col("l_orderkey")).alias("licence_id")).distinct()
    inputs = read("lineitem").select(F.concat(F.lit("o"), _text("l_orderkey")).alias("fact_id"), F.concat(F.lit("p"), _text("l_partkey")).alias("input_fact_id"))
    licence = spark.createDataFrame([("k0", "prohibited", "allowed", "open"), ("k1", "allowed", "prohibited", "open"), ("k2", "allowed", "allowed", "attribution")], "id string, commercial_use string, redistribution string, restriction string")
    channels = spark.createDataFrame([(f"k{k}", f"c{c}", (k + c) % 3 != 0) for k in range(3) for c in range(3)], "licence_id string, channel string, allowed boolean")
    found = rights.inheritance_violations(inputs, parts.union(own), licence, channels)
    return found.select(F.substring("fact_id", 2, 20).cast("long").alias("fact_id"), "dimension", "detail")


def _shapes(read):
    """Suppliers as GeoJSON: a square, a triangle, two squares, and polygons with faults."""
    k = F.col("s_suppkey")
    x, y = k * 7 % 90, k * 13 % 90
    ring = lambda *points: F.concat(F.lit("["), F.concat_ws(",", *[F.format_string("[%d,%d]", x + dx, y + dy) for dx, dy in points]), F.lit("]"))
    square = lambda a, b, d: ring((a, b), (a + d, b), (a + d, b + d), (a, b + d), (a, b))
    poly = lambda *rings: F.concat(F.lit("["), F.concat_ws(",", *rings), F.lit("]"))
    one = square(0, 0, 12)
    shapes = [
        ("Polygon", poly(one)), ("Polygon", poly(ring((0, 0), (12, 0), (0, 12), (0, 0)))), ("MultiPolygon", poly(poly(square(0, 0, 2)), poly(square(10, 10, 4)))),
        ("Polygon", poly(ring((0, 0), (12, 12), (12, 0), (0, 12), (0, 0)))), ("Polygon", poly(ring((0, 0), (12, 0), (12, 12), (0, 12)))), ("Polygon", poly(ring((0, 0), (12, 0), (0, 0)))),
        ("Polygon", poly(one, square(20, 20, 2))), ("Polygon", poly(one, square(8, 8, 8))), ("Polygon", poly(one, square(4, 4, 4))), ("Polygon", poly(ring((0, 0), (12, 0), (12, 12), (6, 0), (0, 12), (0, 0)))),
    ]
    pick = lambda i: F.element_at(F.array(*[F.lit(s[0]) if i == 0 else s[1] for s in shapes]), (k % 10 + 1).cast("int"))
    return read("supplier").select(k.alias("zid"), geo.multipolygon(pick(0), pick(1)).alias("geom"))


@query("""select s_suppkey zid, s_suppkey * 7 % 90 + case s_suppkey % 10 when 0 then 6 when 1 then 4 else 9.8 end x, s_suppkey * 13 % 90 + case s_suppkey % 10 when 0 then 6 when 1 then 4 else 9.8 end y from supplier where s_suppkey % 10 < 3""")
def geometry_centroids(spark, read):
    return _shapes(read).where("zid % 10 < 3").withColumn("p", geo.centroid(F.col("geom"))).select("zid", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query("""select s_suppkey zid, ['self_intersection', 'ring_not_closed', 'too_few_points', 'hole_outside_shell', 'rings_cross', null, 'self_intersection'][s_suppkey % 10 - 2] reason from supplier where s_suppkey % 10 >= 3 and s_suppkey % 10 <> 8""")
def geometry_faults(spark, read):
    return derive.invalid_geometry(_shapes(read), "zid", "geom")


@query("""with z as (select s_suppkey zid, (s_suppkey * 7) % 90 + 6.0 cx, (s_suppkey * 13) % 90 + 6.0 cy from supplier where s_suppkey % 10 = 3), p as (select c_custkey pid, (c_custkey * 31) % 1000 / 10.0 + 0.05 x, (c_custkey * 17) % 1000 / 10.0 + 0.05 y from customer)
 select pid, 'self_intersection' reason, list_sort(list(zid)) polygon_ids from p join z on abs(x - cx) < 6 and abs(y - cy) < abs(x - cx) group by 1""")
def points_in_invalid_polygons(spark, read):
    return derive.touched_by_invalid(t.places(read("customer")), _shapes(read).where("zid % 10 in (0, 1, 3)"), "pid", "zid", "geom")


@query("select event_id id, 'condition_cleared' outcome from events where value > 300 and user_id in (select c_custkey from customer where c_nationkey < 5)")
def closed_for_parcels(spark, read):
    return exceptions.close_for(t.exceptions(read("events")), read("customer").where("c_nationkey < 5").selectExpr("c_custkey parcel_id"), F.current_timestamp()).select("id", "outcome")


@query("""with s as (select o_orderkey id, o_orderpriority provider, o_orderstatus m, o_custkey % 3 j from orders), v as (select distinct p, m, j from (values ('1-URGENT', 'F', 0, true), ('1-URGENT', 'F', 0, true), ('2-HIGH', 'O', 1, true), ('3-MEDIUM', 'F', 2, false)) x(p, m, j, ok) where ok)
 select id from s join v on v.p = provider and v.m = s.m and v.j = s.j""")
def approved_selections(spark, read):
    selected = read("orders").selectExpr("o_orderkey id", "o_orderpriority provider", "o_orderstatus method", "o_custkey % 3 jurisdiction_id")
    tested = spark.createDataFrame([("1-URGENT", "F", 0, True), ("1-URGENT", "F", 0, True), ("2-HIGH", "O", 1, True), ("3-MEDIUM", "F", 2, False)], "provider string, method string, jurisdiction_id long, approved boolean")
    return derive.approved_providers(selected, tested).select("id")


@query("""with w as (select unnest(string_split(lower(text), ' ')) w, lang from documents) select w term, bool_or(lang = 'en') en, bool_or(lang = 'de') de, bool_or(lang = 'fr') fr from w group by 1
 having (max(case when lang = 'en' then 1 else 0 end) + max(case when lang = 'de' then 1 else 0 end) + max(case when lang = 'fr' then 1 else 0 end)) between 1 and 2""")
def vocabulary_differences(spark, read):
    words = read("documents").select(F.explode(F.split(F.lower("text"), " ")).alias("term"), "lang")
    return audit.vocabulary_diff(words, "term", en=F.col("lang") == "en", de=F.col("lang") == "de", fr=F.col("lang") == "fr")


@query("""with x as (select event_type, event_id % 4 m from events) select event_type, k "key", kind, count(*) n from (select event_type, 'a' k, case m when 0 then 'number' when 1 then 'string' when 2 then 'missing' else 'boolean' end kind from x union all select event_type, 'b', case when m < 2 then 'array' else 'object' end from x) group by 1, 2, 3""")
def json_type_histogram(spark, read):
    m = F.col("event_id") % 4
    a = F.when(m == 0, "-1.5").when(m == 1, '"word"').when(m == 2, "null").otherwise("true")
    rows = read("events").select("event_type", F.concat(F.lit('{"a":'), a, F.lit(',"b":'), F.when(m < 2, "[1]").otherwise('{"c":1}'), F.lit("}")).alias("props"))
    return audit.type_histogram(rows, "event_type", "props")


@query("""with sup as (select l_orderkey k, count(*) requests, count(*) filter (where l_returnflag = 'R') corrections from lineitem group by 1),
 f as (select cast(date_trunc('week', o_orderdate) as timestamp) wk, case o_orderstatus when 'F' then 'refused' when 'P' then 'partial' else 'composed' end status, o_custkey cost, requests, corrections from orders left join sup on k = o_orderkey)
 select wk, count(*) files, round(cast(coalesce(sum(requests), 0) as double) / count(*), 4) support_rate, round(cast(count(*) filter (where corrections > 0) as double) / count(*), 4) correction_rate,
 round(cast(count(*) filter (where status = 'refused') as double) / count(*), 4) refusal_rate, round(cast(count(*) filter (where status = 'partial') as double) / count(*), 4) partial_rate, round(avg(cost), 4) avg_cost_micros from f group by 1""")
def delivery_rates(spark, read):
    support = read("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    files = measure.with_support(read("orders"), support, "o_orderkey", F.count("*"), F.count_if(F.col("l_returnflag") == "R"))
    files = files.withColumns({"status": F.when(F.col("o_orderstatus") == "F", "refused").when(F.col("o_orderstatus") == "P", "partial").otherwise("composed"), "cost_micros": F.col("o_custkey")})
    return measure.delivery_rates(files, time.week(F.col("o_orderdate")))


@query("""select case o_orderkey % 4 when 0 then 'text/html' when 1 then 'application/json' else 'application/octet-stream' end media, cast(cast(o_orderdate as date) as timestamp) issued, o_orderkey % 3 <> 0 is_id, o_orderkey % 3 = 0 is_hash, count(*) n from orders group by 1, 2, 3, 4""")
def parsed_headers(spark, read):
    k = F.col("o_orderkey")
    header = F.when(k % 4 == 0, " Text/HTML; charset=utf-8").when(k % 4 == 1, "application/json").when(k % 4 == 2, " ; x")
    key = F.when(k % 3 == 0, F.sha2(k.cast("string"), 256)).otherwise(text.derived_id(k))
    issued = time.issue_date(F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a"))
    rows = read("orders").select(text.media_type(header).alias("media"), issued.cast("timestamp_ntz").alias("issued"), text.is_uuid(key).alias("is_id"), text.is_sha256(key).alias("is_hash"))
    return rows.groupBy("media", "issued", "is_id", "is_hash").agg(F.count("*").alias("n"))


@query("""with f as (select o_orderkey id, o_orderkey % 4 m from orders) select code, count(*) files from (select id, 'PARCEL_NO_FACTS' code from f where m in (1, 2) union all select id, 'RIGHTS_BLOCKED' from f where m = 2) group by 1""")
def refusal_totals(spark, read):
    m = F.col("o_orderkey") % 4
    one = lambda *codes: "[" + ",".join(f'{{"code":"{c}"}}' for c in codes) + "]"
    files = read("orders").select(F.when(m == 1, one("PARCEL_NO_FACTS")).when(m == 2, one("RIGHTS_BLOCKED", "PARCEL_NO_FACTS", "RIGHTS_BLOCKED")).otherwise("[]").alias("refusals"))
    return views.refusal_totals(files, "refusals")


@query(f"""with {_LEDGER} select source_id, field_key, count(*) n, count(*) filter (where superseded_at is null) live from ledger where {_VISIBLE} group by 1, 2""")
def current_fact_sql(spark, read):
    """The same visibility as a SQL table function that a reader can call with any time."""
    t.ledger(read("events")).createOrReplaceTempView("ledger_facts")
    current.register_visible_at(spark, "ledger_facts", "visible_at")
    return spark.sql("select source_id, field_key, count(*) n, count_if(superseded_at is null) live from visible_at(timestamp_ntz '2024-01-20') group by all")


_ACTION = "case when l.v is null then 'insert' when n.v is null then 'retire' when l.v = n.v then 'keep' else 'supersede' end"


@query(f"""with c as (select c_custkey k, cast(c_custkey as varchar) f, case when c_custkey % 6 = 0 then ' ' when c_custkey % 9 = 0 then '?' else 'A' || c_custkey end raw, 'p' || c_custkey known, sha256('src' || chr(31) || c_custkey) h from customer),
 x as (select *, case when k % 5 <> 0 then known else substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) end p, case when k % 5 = 0 then 'new' when k % 7 = 0 and k % 11 = 0 then null when k % 7 = 0 then 'disappeared' when k % 11 = 0 then 'reappeared' else 'seen' end e from c where not (k % 5 = 0 and k % 7 = 0)),
 fresh as (select p, 'apn' f, '{{"v":"' || raw || '"}}' v from x where e is not null and e <> 'disappeared' and raw not in (' ', '?') union all select p, 'geometry', 'g' || k from x where e is not null and e <> 'disappeared' union all select p, 'source_parcel_id', '{{"v":"' || f || '"}}' from x where e is not null and e <> 'disappeared'),
 live as (select p, 'apn' f, '{{"v":"A' || (k - k % 2) || '"}}' v, e from x where k % 5 <> 0 union all select p, 'geometry', 'g' || k, e from x where k % 5 <> 0)
 select coalesce(l.p, n.p) parcel_id, coalesce(l.f, n.f) field_key, {_ACTION} "action" from (select * from live where e is distinct from 'disappeared') l full join fresh n on l.p = n.p and l.f = n.f
 union all select p, 'exception', 'unresolvable_' || case raw when ' ' then 'blank' else 'placeholder' end from x where e is not null and e <> 'disappeared' and raw in (' ', '?') union all select p, 'exception', 'feature_disappeared' from x where e = 'disappeared'""")
def parcel_reconciliation(spark, read):
    k, c = F.col("c_custkey"), read("customer")
    apn = F.when(k % 6 == 0, " ").when(k % 9 == 0, "?").otherwise(F.concat(F.lit("A"), k.cast("string")))
    features = c.where(k % 7 != 0).select(k.cast("string").alias("feature_id"), apn.alias("apn"), F.concat(F.lit("g"), k.cast("string")).alias("geometry"))
    known = c.where(k % 5 != 0).withColumn("parcel_id", F.concat(F.lit("p"), k.cast("string")))
    identity = known.select(k.cast("string").alias("source_feature_id"), "parcel_id", F.when(k % 11 == 0, _day("2024-01-01")).alias("retired_at"))
    value = F.array(F.struct(F.lit("apn").alias("field_key"), F.concat(F.lit('{"v":"A'), (k - k % 2).cast("string"), F.lit('"}')).alias("value")), F.struct(F.lit("geometry").alias("field_key"), F.concat(F.lit("g"), k.cast("string")).alias("value")))
    found = pipelines.parcel_changes(features, identity, known.select("parcel_id", k.alias("id"), F.inline(value)), "src")
    told = found["unresolved"].unionByName(found["lost"]).select("parcel_id", F.lit("exception").alias("field_key"), F.col("reason").alias("action"))
    return found["steps"].select("parcel_id", "field_key", "action").unionByName(told)


@query(f"""with z as (select s_suppkey zid, case when s_suppkey % 9 = 0 then null else 'Z' || (s_suppkey % 4) end zoning, (s_suppkey * 7) % 90 * 1.0 x0, (s_suppkey * 13) % 90 * 1.0 y0 from supplier),
 p as (select c_custkey pid, (c_custkey * 31) % 1000 / 10.0 + 0.05 x, (c_custkey * 17) % 1000 / 10.0 + 0.05 y from customer),
 cand as (select p.pid, z.zid, z.zoning from p left join z on p.x > z.x0 and p.x < z.x0 + 12 and p.y > z.y0 and p.y < z.y0 + 12),
 cls as (select pid, count(distinct zoning) n, count(zid) m, min(zoning) zoning from cand group by 1),
 n as (select pid p, '{{"v":"' || zoning || '"}}' v from cls where n = 1), l as (select c_custkey p, '{{"v":"Z1"}}' v from customer where c_custkey % 2 = 0)
 select coalesce(l.p, n.p) parcel_id, {_ACTION} "action" from l full join n on l.p = n.p
 union all select pid, case when n = 0 then 'no_containing_district' when n > 1 then 'multiple_containing_districts' else 'multiple_polygons_agree' end from cls where n <> 1 or m > 1""")
def zoning_reconciliation(spark, read):
    points = t.places(read("customer")).withColumnRenamed("pid", "parcel_id")
    zones = t.squares(read("supplier")).withColumnRenamed("zid", "zone_id").withColumn("abbreviation", F.lit(None).cast("string"))
    live = read("customer").where("c_custkey % 2 = 0").selectExpr("c_custkey parcel_id", "'zoning.district' field_key", "c_custkey id", """'{"v":"Z1"}' value""")
    steps, told = pipelines.zoning_changes(points, zones, live, cell=1.0)
    return steps.select("parcel_id", "action").unionByName(told.select("parcel_id", F.col("reason").alias("action")))


@query(f"""with parcels as ({_APN}), permits as (select {_RAW} raw, o_orderdate d from orders), canon as (select trim(case when substr(trim(raw), 1, 1) = '''' then substr(trim(raw), 2) else trim(raw) end) apn, d from permits),
 one as (select apn, min(pid) pid from parcels group by apn having count(*) = 1), first as (select pid, min(cast(d as date)) d from canon join one using (apn) where apn <> '' group by 1),
 l as (select c_custkey p, 'permits.active' f, 'true' v from customer where c_custkey % 3 = 0 union all select c_custkey, 'permits.series_earliest', '{{"v":"1995-01-01"}}' from customer where c_custkey % 3 = 0),
 n as (select coalesce(pid, c_custkey) p, 'permits.active' f, case when pid is null then 'false' else 'true' end v from first full join (select * from customer where c_custkey % 3 = 0) on c_custkey = pid union all select pid, 'permits.series_earliest', '{{"v":"' || cast(d as varchar) || '"}}' from first)
 select coalesce(l.p, n.p) parcel_id, coalesce(l.f, n.f) field_key, n.v as value, {_ACTION} "action" from l full join n on l.p = n.p and l.f = n.f""")
def permit_reconciliation(spark, read):
    permits = _permits(read).select("raw", F.col("d").cast("date").alias("issued"))
    held = F.array(*[F.struct(F.lit(k).alias("field_key"), F.lit(v).alias("value")) for k, v in (("permits.active", "true"), ("permits.series_earliest", '{"v":"1995-01-01"}'))])
    live = read("customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("parcel_id"), F.col("c_custkey").alias("id"), F.inline(held))
    steps, _ = pipelines.permit_changes(permits, _parcels(read).withColumnRenamed("pid", "parcel_id"), live)
    return steps.select("parcel_id", "field_key", "value", "action")
