"""The catalogue: every query of the engine by name, and the same as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from factspan.functions import json, text, time
from factspan.operators import audit, compose, current, exceptions, golden, lineage, match, measure, reconcile, rights, rules, spatial, validate, views
from factspan.plans import registry
from factspan.plans import testdata as t
from factspan.plans.registry import query
from factspan.sources import snapshot


def _register():
    from factspan.plans import ledger_queries, source_queries, state_queries  # noqa: F401  each registers its queries


def queries():
    _register()
    return dict(registry.QUERIES)


def oracle_sql():
    _register()
    return dict(registry.SQL)


_LEDGER = """ledger as (
 select event_id as fact_id, user_id as entity_id, event_type as field_key, 's'||cast(event_id%3 as varchar) as source_id, value,
  cast(event_id%2+1 as int) as conf_ord, case when event_id%4=0 then null else ts end as retrieved_at,
  case when event_id%7=0 then ts + interval '10' day else ts - interval '1' day end as effective_from,
  case when event_id%7=0 then ts + interval '16' day when event_id%9=0 then ts + interval '5' day end as effective_to,
  ts as recorded_at, lead(ts) over (partition by user_id,event_type,event_id%3 order by ts,event_id) as superseded_at from events)"""
_VISIBLE = """recorded_at <= timestamp '2024-01-20' and (superseded_at is null or superseded_at > timestamp '2024-01-20')
 and effective_from <= timestamp '2024-01-20' and (effective_to is null or effective_to > timestamp '2024-01-20')"""


current_fact_at_sql = f"""with {_LEDGER},
 srank as (select 's0' source_id, 'click' field_key, 2 rnk union all select 's1','click',1 union all select 's2','view',1),
 r as (select l.*, row_number() over (partition by l.entity_id,l.field_key order by coalesce(s.rnk,999), l.conf_ord, l.retrieved_at desc nulls last, l.fact_id) rn
 from ledger l left join srank s on s.source_id=l.source_id and s.field_key=l.field_key where {_VISIBLE})
 select entity_id,field_key,fact_id,value from r where rn=1"""


@query(current_fact_at_sql)
def current_fact_at(spark, read):
    at = F.lit("2024-01-20").cast("timestamp_ntz")
    found = current.current_fact_at(t.ledger(read("events")), t.source_ranks(spark), at, entity="entity_id", fact="fact_id", confidence="conf_ord")
    return found.select("entity_id", "field_key", "fact_id", "value")


@query(f"""with {_LEDGER} select entity_id, field_key, count(distinct round(value / 100)) n_values,
 case when count(distinct round(value / 100)) > 1 then 'conflicts' when count(distinct round(value / 100)) = 0 then 'missing'
 when bool_and(coalesce(date_diff('day', cast(retrieved_at as date), date '2024-01-20') > 9, false)) then 'stale' else 'agree' end conflict
 from ledger where {_VISIBLE} group by 1, 2""")
def conflict_states(spark, read):
    at = F.lit("2024-01-20").cast("timestamp_ntz")
    seen = t.ledger(read("events")).where(time.visible(at)).withColumn("value", F.round(F.col("value") / 100))
    return current.conflict_state(seen, "entity_id", "field_key", "value", time.stale(at, F.col("retrieved_at"), F.lit(9)))


@query("""with live as (select o_orderkey k, o_totalprice v from orders where o_orderkey%10<>0),
 incoming as (select o_orderkey k, case when o_orderkey%5=0 then o_totalprice+1 else o_totalprice end v from orders where o_orderkey%7<>0)
 select coalesce(l.k,i.k) k, case when l.k is null then 'new' when i.k is null then 'disappeared' when l.v is distinct from i.v then 'changed' else 'same' end cls
 from live l full outer join incoming i on l.k=i.k""")
def reconcile_diff(spark, read):
    k, v = F.col("o_orderkey"), F.col("o_totalprice")
    live = read("orders").where(k % 10 != 0).select(k.alias("k"), v.alias("v"))
    incoming = read("orders").where(k % 7 != 0).select(k.alias("k"), F.when(k % 5 == 0, v + 1).otherwise(v).alias("v"))
    return reconcile.diff(live, incoming, ["k"], "v").select("k", "cls")


@query("""with live as (select o_custkey p, o_orderpriority f, min(o_orderkey) id, min(o_orderstatus) v from orders where o_orderdate < timestamp '1998-01-01' group by 1, 2),
 fresh as (select o_custkey p, o_orderpriority f, min(o_orderstatus) v from orders where o_orderdate >= timestamp '1997-01-01' group by 1, 2),
 j as (select coalesce(l.f, n.f) f, case when l.id is null then 'insert' when n.p is null then 'retire' when l.v is not distinct from n.v then 'keep' else 'supersede' end action
 from live l full outer join fresh n on l.p = n.p and l.f = n.f)
 select f field_key, action, count(*) "count" from j group by 1, 2""")
def reconcile_counters(spark, read):
    o = read("orders").select(F.col("o_custkey").alias("parcel_id"), F.col("o_orderpriority").alias("field_key"), "o_orderkey", "o_orderstatus", "o_orderdate")
    key, day = ["parcel_id", "field_key"], lambda d: F.lit(d).cast("timestamp_ntz")
    live = o.where(F.col("o_orderdate") < day("1998-01-01")).groupBy(*key).agg(F.min("o_orderkey").alias("id"), F.min("o_orderstatus").alias("value"))
    fresh = o.where(F.col("o_orderdate") >= day("1997-01-01")).groupBy(*key).agg(F.min("o_orderstatus").alias("value"))
    return reconcile.counters(reconcile.successors(live, fresh, key, F.lit("unknown")))


@query("""with idn as (select c_custkey k, c_custkey%4=0 retired from customer where c_custkey%3<>0), inc as (select c_custkey k from customer where c_custkey%5<>0)
 select coalesce(d.k, i.k) feature, case when d.k is null then 'new' when i.k is null then 'disappeared' when d.retired then 'reappeared' else 'seen' end "event"
 from idn d full outer join inc i on d.k = i.k where not (i.k is null and d.retired)""")
def identity_events(spark, read):
    k = F.col("c_custkey")
    identity = read("customer").where(k % 3 != 0).select(k.alias("feature"), k.alias("parcel_id"), F.when(k % 4 == 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("retired_at"))
    return reconcile.identity_events(identity, read("customer").where(k % 5 != 0).select(k.alias("feature")), ["feature"]).select("feature", "event")


_APN = "select cast(c_custkey - c_custkey%20*(case when c_custkey%20<2 then 1 else 0 end) as varchar) apn, c_custkey pid from customer"
_RAW = "case when o_orderkey%13=0 then '  ' when o_orderkey%11=0 then ''''||cast(o_custkey as varchar) when o_orderkey%17=0 then cast(o_custkey+1000000 as varchar) else cast(o_custkey as varchar)||' ' end"


def _parcels(read):
    k = F.col("c_custkey")
    return read("customer").select((k - k % 20 * F.when(k % 20 < 2, 1).otherwise(0)).cast("string").alias("apn"), k.alias("pid"))


def _permits(read):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    raw = F.when(k % 13 == 0, "  ").when(k % 11 == 0, F.concat(F.lit("'"), c.cast("string"))).when(k % 17 == 0, (c + 1000000).cast("string")).otherwise(F.concat(c.cast("string"), F.lit(" ")))
    return read("orders").select(raw.alias("raw"), F.col("o_orderdate").alias("d"), k.alias("permit"))


@query(f"""with parcels as ({_APN}), permits as (select {_RAW} raw, o_orderdate d from orders),
 canon as (select trim(case when substr(trim(raw),1,1)='''' then substr(trim(raw),2) else trim(raw) end) apn, d from permits),
 p1 as (select apn, count(*) n, min(pid) pid from parcels group by apn)
 select case when c.apn='' then 'blank' when p.apn is null then 'not_found' when p.n>1 then 'ambiguous' else 'matched' end cls, count(*) row_cnt, count(distinct c.apn) key_cnt, min(d) earliest
 from canon c left join p1 p on p.apn=c.apn group by 1""")
def key_match_breakdown(spark, read):
    return match.breakdown(match.match(_permits(read), "raw", _parcels(read), "apn", "pid"), "d")


@query(f"""with parcels as ({_APN}) select apn, list_sort(list(distinct pid)) candidates, case when count(distinct pid) = 1 then 'resolved' else 'ambiguous' end status from parcels group by 1""")
def key_candidates(spark, read):
    return match.entity_for_key(_parcels(read), "apn", "pid")


@query(f"""with p as (select {_RAW} raw, o_orderkey permit, trim(case when substr(trim({_RAW}),1,1)='''' then substr(trim({_RAW}),2) else trim({_RAW}) end) k from orders),
 f as (select min(permit) permit from p where k <> '' group by k) select permit, raw from p where permit in (select permit from f) order by permit limit 100""")
def first_unique_keys(spark, read):
    return match.first_unique(_permits(read).select("raw", "permit"), "raw", "permit", 100).select("permit", "raw")


@query("""with z as (select s_suppkey zid, case when s_suppkey%9=0 then null else 'Z'||cast(s_suppkey%4 as varchar) end zoning, (s_suppkey*7)%90*1.0 x0, (s_suppkey*13)%90*1.0 y0 from supplier),
 p as (select c_custkey pid, (c_custkey*31)%1000/10.0+0.05 x, (c_custkey*17)%1000/10.0+0.05 y from customer),
 cand as (select p.pid, z.zid, z.zoning from p left join z on p.x>z.x0 and p.x<z.x0+12 and p.y>z.y0 and p.y<z.y0+12)
 select pid, count(distinct zoning) n_distinct, count(zid) n_cand, case when count(distinct zoning)=0 then 'zero_match' when count(distinct zoning)>1 then 'ambiguous' else 'matched' end kind, case when count(distinct zoning)=1 then min(zoning) end zoning from cand group by pid""")
def point_in_polygon_classify(spark, read):
    found = spatial.classified(t.places(read("customer")), t.squares(read("supplier")), "geom", "x", "y", "pid", "zid", "zoning")
    return found.select("pid", "n_distinct", "n_cand", "kind", "zoning")


@query("""with chan as (select p_brand lic, 'api' channel, (p_size%2=0) allowed from (select p_brand, min(p_size) p_size from part group by p_brand) t where p_brand<>'Brand#11')
 select l.l_orderkey k, p.p_brand lic, count(*) n_blocked from lineitem l join part p on p.p_partkey=l.l_partkey left join chan c on c.lic=p.p_brand and c.channel='api' where not coalesce(c.allowed,false) group by 1,2""")
def rights_gate_blocked(spark, read):
    part = read("part")
    channels = part.where("p_brand <> 'Brand#11'").groupBy(F.col("p_brand").alias("licence_id")).agg((F.min("p_size") % 2 == 0).alias("allowed")).withColumn("channel", F.lit("api"))
    touched = read("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("k"), F.col("p_brand").alias("lic"))
    return rights.permitted(touched, channels, "lic", "api").where("not allowed").groupBy("k", "lic").agg(F.count("*").alias("n_blocked"))


@query("""with chan as (select p_partkey pk, m ch from part cross join (select 0 m union all select 1 union all select 2) t where (p_partkey+m)%5<>0),
 claimed as (select o_orderkey k, m ch from orders cross join (select 0 m union all select 1 union all select 2) t)
 select c.k, min(c.ch) over_permitted from claimed c where exists (select 1 from lineitem l where l.l_orderkey=c.k and not exists (select 1 from chan x where x.pk=l.l_partkey and x.ch=c.ch)) group by c.k""")
def licence_intersection_violation(spark, read):
    three = lambda df: df.withColumn("ch", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    allowed = three(read("part").select(F.col("p_partkey").alias("pk"))).where((F.col("pk") + F.col("ch")) % 5 != 0)
    claimed = three(read("orders").select(F.col("o_orderkey").alias("k")))
    inputs = read("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("pk"))
    return rights.over_permitted(claimed, inputs, allowed, "k", "ch", "pk")


@query("""with rule as (select o_custkey rk, o_orderkey id, row_number() over (partition by o_custkey order by o_orderdate,o_orderkey) ver, o_orderdate ef, lead(o_orderdate) over (partition by o_custkey order by o_orderdate,o_orderkey) et from orders)
 select rk,id,cast(ver as bigint) ver from (select *, row_number() over (partition by rk order by ver desc) rn from rule where ef <= timestamp '1998-06-01' and (et is null or et > timestamp '1998-06-01')) t where rn=1""")
def effective_rule(spark, read):
    found = rules.effective_rules(t.rules(read("orders")), F.lit("1998-06-01").cast("timestamp_ntz"), ["rk"])
    return found.select("rk", "id", F.col("version").alias("ver"))


@query("""select event_type det, count(*) detected, count(*) filter (where value>400) confirmed, count(*) filter (where value<100) false_positive, cast(round(cast(count(*) filter (where value<100) as double)/nullif(count(*) filter (where value<300),0),4) as double) fpr from events group by 1""")
def exception_track_a(spark, read):
    v = F.col("value")
    return measure.outcomes(read("events"), [F.col("event_type").alias("det")], v > 400, v < 100, v < 300)


@query("""with examined as (select distinct c_nationkey j, o_custkey p from orders join customer on c_custkey=o_custkey where o_orderstatus<>'P'), hit as (select distinct c_nationkey j, o_custkey p from orders join customer on c_custkey=o_custkey where o_orderpriority='1-URGENT')
 select e.j, count(*) examined, count(h.p) hits, round(cast(count(h.p) as double)/nullif(count(*),0),4) hit_rate from examined e left join hit h on h.j=e.j and h.p=e.p group by 1""")
def exception_hitrate(spark, read):
    pairs = read("orders").join(read("customer"), F.col("c_custkey") == F.col("o_custkey")).withColumnsRenamed({"c_nationkey": "j", "o_custkey": "p"})
    of = lambda cond: pairs.where(cond).select("j", "p").distinct()
    return measure.hit_rate(of("o_orderstatus <> 'P'"), of("o_orderpriority = '1-URGENT'"), "j", "p")


@query("""with sup as (select l_orderkey k, count(*) requests, count(*) filter (where l_returnflag='R') corrections from lineitem group by 1)
 select cast(date_trunc('week',o_orderdate) as timestamp) wk, count(*) files, count(*) filter (where o_orderstatus='F') full_files, cast(coalesce(sum(requests),0) as bigint) requests, cast(coalesce(sum(corrections),0) as bigint) corrections from orders left join sup on k=o_orderkey group by 1""")
def delivery_economics(spark, read):
    support = read("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    files = measure.with_support(read("orders"), support, "o_orderkey", F.count("*"), F.count_if(F.col("l_returnflag") == "R"))
    return measure.deliveries(files, time.week(F.col("o_orderdate")), F.col("o_orderstatus") == "F")


@query("select doc_id, case when row_number() over (partition by sha256(text) order by doc_id)=1 then 'succeeded' else 'skipped_unchanged' end st from documents")
def job_status_dedup(spark, read):
    narrow = read("documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return audit.run_status(narrow, "h", "doc_id").select("doc_id", "st")


@query("select sha256(text) h, min(doc_id) first_doc, count(*) fetches, max(cast(strlen(text) as bigint)) byte_size from documents group by 1")
def snapshot_dedup(spark, read):
    return snapshot.first_fetches(read("documents"), "text", "doc_id")


@query("""select 's'||cast(doc_id%5 as varchar)||':sha256:'||sha256(text) id, 'sha256/'||substr(sha256(text),1,2)||'/'||sha256(text) object_uri, count(*) n from documents group by 1, 2""")
def snapshot_keys(spark, read):
    rows = read("documents").select(F.concat(F.lit("s"), (F.col("doc_id") % 5).cast("string")).alias("source_id"), F.sha2("text", 256).alias("content_hash"))
    return snapshot.snapshots(rows).groupBy("id", "object_uri").agg(F.count("*").alias("n"))


@query("""with x as (select event_id id, user_id p, event_type reason, ts, value, (value>300) as is_open from events) select o.id, c.id prior_id from (select * from x where is_open) o join (select * from (select *, row_number() over (partition by p,reason order by ts desc, id) rn from x where not is_open) t where rn=1) c on c.p=o.p and c.reason=o.reason""")
def relink_reopened(spark, read):
    x = t.exceptions(read("events"))
    found = exceptions.relink_reopened(x.where("outcome = 'open'"), x.where("outcome <> 'open'"), [F.col("ts").desc(), F.col("id")])
    return found.select("id", F.col("prior").alias("prior_id"))


@query("""with still as (select distinct user_id p, event_type reason from events where value>480) select e.event_id id, case when s.p is null then 'condition_cleared' else 'open' end outcome from events e left join still s on s.p=e.user_id and s.reason=e.event_type""")
def close_resolved(spark, read):
    x = t.exceptions(read("events")).withColumn("outcome", F.lit("open"))
    closed = exceptions.close_resolved(x, x.where("value > 480"), F.current_timestamp()).select("id", F.col("outcome").alias("now"))
    return x.join(closed, "id", "left").select("id", F.coalesce("now", "outcome").alias("outcome"))


@query("""with f as (select user_id parcel_id, event_type reason, min(event_id) id from events where value > 100 group by 1, 2)
 select f.parcel_id, f.reason from f where not exists (select 1 from events e where e.value > 300 and e.event_id % 2 = 0 and e.user_id = f.parcel_id and e.event_type = f.reason)""")
def findings_not_open(spark, read):
    x = t.exceptions(read("events"))
    return exceptions.not_yet_open(x.where("value > 100"), x.where("id % 2 = 0")).select("parcel_id", "reason")


@query("""with x as (select event_id id, event_type detector_key, 'v'||cast(event_id%3 as varchar) detector_version, case when value>300 then 'open' else 'confirmed' end outcome from events)
 select id, detector_key, detector_version, 'version_retired' outcome from x where outcome='open' and detector_key='click' and detector_version<>'v2'""")
def stranded_exceptions(spark, read):
    x = t.exceptions(read("events")).withColumnRenamed("reason", "detector_key").withColumn("detector_version", F.concat(F.lit("v"), (F.col("id") % 3).cast("string")))
    return exceptions.retire_stranded(x, "click", "v2", F.current_timestamp()).select("id", "detector_key", "detector_version", "outcome")


@query("select page_id, contains(substr(html,1,400),'charset') has_charset, contains(substr(html,1,40),'es') is_es, contains(substr(html,1,250),'<nav>') has_nav from pages")
def prefix_field_probe(spark, read):
    return audit.prefix_fields(read("pages"), "html", {"has_charset": ("charset", 400), "is_es": ("es", 40), "has_nav": ("<nav>", 250)}).select("page_id", "has_charset", "is_es", "has_nav")


@query("""with p as (select page_id, substr(html,1,300) px from pages), m as (select page_id, list_filter(['<nav>','lang="en"','charset'], lambda x: not contains(px, x)) missing_fields from p) select page_id, missing_fields from m where len(missing_fields) > 0""")
def missing_declared_fields(spark, read):
    rows = read("pages").select("page_id", F.substring("html", 1, 300).alias("prefix"), F.array(F.lit("<nav>"), F.lit('lang="en"'), F.lit("charset")).alias("declared"))
    return audit.missing_fields(rows, "declared", "prefix").select("page_id", "missing_fields")


@query("select k, count(*) present from (select unnest(json_keys(props)) k from events) t group by 1")
def json_key_coverage(spark, read):
    return audit.key_coverage(read("events"), "props")


@query("select o_orderkey, o_orderdate from orders order by o_orderdate desc, o_orderkey limit 500")
def recent_topn(spark, read):
    return views.newest(read("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", 500)


@query("select user_id, event_type, coalesce(props->>'zz','') reason, count(*) n from events group by 1,2,3 having count(*)>1")
def one_open_violation(spark, read):
    return validate.one_open_exception(read("events"), ["user_id", "event_type"], json.field(F.col("props"), "zz"))


@query("select l_orderkey,l_linenumber,count(*) n from lineitem group by 1,2 having count(*)>1")
def duplicate_keys(spark, read):
    return validate.unique(read("lineitem"), ["l_orderkey", "l_linenumber"])


@query("""select l_orderkey, l_linenumber, l_partkey from lineitem l where nullif(l_partkey%11,0) is not null and not exists (select 1 from part p where p.p_partkey = l.l_partkey and p.p_size > 5)""")
def broken_references(spark, read):
    rows = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.nullif(F.col("l_partkey") % 11, F.lit(0)).alias("k"))
    return validate.references(rows, ["l_partkey", "k"], read("part").where("p_size > 5").withColumn("m", F.col("p_partkey") % 11), ["p_partkey", "m"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""select event_id id, 'valid_time' violates from events where value < 250 and not (case when event_id%5=0 then null else value end > 100)""")
def check_violations(spark, read):
    rows = read("events").where("value < 250").select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("v"))
    return validate.check(rows, F.col("v") > 100, "valid_time").select("id", "violates")


@query(f"""with {_LEDGER} select entity_id parcel_id, field_key, coalesce(case when event_id % 10 <> 0 then source_id end, '~derived') source_id, 'm' || cast(event_id % 2 as varchar) method_version, count(*) n
 from (select *, fact_id event_id from ledger) where superseded_at is null or superseded_at > timestamp '2024-01-25' group by 1, 2, 3, 4 having count(*) > 1""")
def one_current_violations(spark, read):
    live = t.ledger(read("events")).withColumn("superseded_at", F.when(F.col("superseded_at") <= F.lit("2024-01-25").cast("timestamp_ntz"), F.col("superseded_at")))
    k = F.col("fact_id")
    rows = live.select(F.col("entity_id").alias("parcel_id"), "field_key", F.when(k % 10 != 0, F.col("source_id")).alias("source_id"), F.concat(F.lit("m"), (k % 2).cast("string")).alias("method_version"), "superseded_at")
    return validate.one_current_per_source(rows)


@query("""with req as (select event_id, user_id, ts from events where event_type='view'), per as (select event_id pid, user_id, ts from events where event_type='purchase') select event_id, pid from (select r.event_id, p.pid, row_number() over (partition by r.event_id order by p.ts, p.pid) rn from req r left join per p on p.user_id=r.user_id and p.ts>=r.ts and p.ts<r.ts+interval '3' day) t where rn=1""")
def outcome_window_match(spark, read):
    e = read("events")
    later = e.where("event_type = 'purchase'").withColumnRenamed("event_id", "pid")
    return measure.first_within(e.where("event_type = 'view'"), later, "user_id", "ts", "event_id", "pid", F.expr("interval '3' day"))


@query("select o_orderpriority plan, count(distinct o_custkey) cust, cast(sum(cast(round(o_totalprice*100) as bigint)) as bigint) minor from orders where o_orderstatus='F' group by 1")
def captured_subscription(spark, read):
    return measure.captured(read("orders").where("o_orderstatus = 'F'"), "o_orderpriority", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long"))


@query("""select 'a' side, k from (select o_orderkey k from orders where o_orderkey%3=0 except select l_orderkey from lineitem) t union all select 'b', k from (select l_orderkey k from lineitem except select o_orderkey from orders where o_orderkey%3=0) t""")
def symmetric_except(spark, read):
    a = read("orders").where(F.col("o_orderkey") % 3 == 0).select(F.col("o_orderkey").alias("k"))
    return reconcile.symmetric_difference(a, read("lineitem").select(F.col("l_orderkey").alias("k")))


@query("""select o_orderkey k from orders where o_orderkey%4=1 and not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linenumber = 1)""")
def insert_if_absent(spark, read):
    rows = read("orders").where(F.col("o_orderkey") % 4 == 1).select(F.col("o_orderkey").alias("k"))
    return reconcile.insert_if_absent(read("lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("k")), rows, ["k"])


@query(r"select doc_id, trim(regexp_replace(text,'\s+',' ','g')) t from documents")
def whitespace_normalise(spark, read):
    return read("documents").select("doc_id", text.normalise_space(F.col("text")).alias("t"))


@query("""select doc_id, list_aggregate(string_split(trim(regexp_replace(text,'\\s+',' ','g')),' ')[1:8], 'string_agg', ' ') head, trim(regexp_replace(regexp_replace(lower(source),'[^a-z0-9]+','-','g'),'^-|-$','','g')) slug from documents""")
def text_heads(spark, read):
    return read("documents").select("doc_id", text.first_words(F.col("text"), 8).alias("head"), text.slug(F.col("source")).alias("slug"))


@query("""with x as (select c_custkey k, case c_custkey%6 when 0 then ' ' when 1 then '12??3' when 2 then '''?9' when 3 then null else '0'||c_custkey end v from customer)
 select k, case when v is null or trim(v)='' then 'blank' when contains(v,'?') then 'placeholder' end reason from x""")
def unresolvable_identifiers(spark, read):
    k = F.col("c_custkey")
    v = F.when(k % 6 == 0, " ").when(k % 6 == 1, "12??3").when(k % 6 == 2, "'?9").when(k % 6 != 3, F.concat(F.lit("0"), k.cast("string")))
    return read("customer").select(k.alias("k"), text.unresolvable_reason(v).alias("reason"))


@query("select event_id, cast(props->>'k' as bigint) k from events")
def json_field_get(spark, read):
    return read("events").select("event_id", json.field(F.col("props"), "k").cast("long").alias("k"))


@query("select event_id, '<UUID:'||cast(dense_rank() over (order by fo) as varchar)||'>' tok from (select event_id, min(event_id) over (partition by user_id) fo from events) t")
def positional_token(spark, read):
    return golden.positional_tokens(read("events"), "user_id", "event_id").select("event_id", "tok")


@query("select user_id, list_sort(list(distinct event_type)) l from events group by 1")
def sorted_list_normalise(spark, read):
    return golden.sorted_set(read("events"), "user_id", "event_type", "l")


@query("""with recursive nx as (select event_id id, lead(event_id) over (partition by user_id,event_type order by ts,event_id) nxt from events), r as (select id, nxt, 1 as depth from nx where id in (select first_value(event_id) over (partition by user_id,event_type order by ts,event_id) from events) union all select n.id, n.nxt, r.depth+1 from r join nx n on n.id=r.nxt) select id, depth from r""")
def lineage_chain(spark, read):
    return lineage.chain(read("events"), ["user_id", "event_type"], ["ts", "event_id"], "event_id").select(F.col("event_id").alias("id"), "depth")


@query("""with recursive e as (select p_partkey c, p_partkey // 2 p from part where p_partkey > 1), r as (select c seed, p ancestor, 1 depth from e union all select r.seed, e.p, r.depth + 1 from r join e on e.c = r.ancestor) select seed, ancestor, depth from r""")
def lineage_closure(spark, read):
    k = F.col("p_partkey")
    edges = read("part").where(k > 1).select(k.alias("fact_id"), F.floor(k / 2).alias("input_fact_id"))
    return lineage.closure(edges, edges.select("fact_id"))


@query("""with o as (select o_orderkey fact_id, o_custkey parcel_id, o_orderpriority licence_id, o_orderstatus field_key from orders), ch as (select * from (values ('1-URGENT', true), ('2-HIGH', true), ('3-MEDIUM', false)) t(licence_id, allowed))
 select parcel_id, count(*) filter (where coalesce(allowed, false)) shown, count(*) filter (where not coalesce(allowed, false)) omitted from o left join ch using (licence_id) group by 1""")
def facts_by_permission(spark, read):
    facts = read("orders").select(F.col("o_custkey").alias("parcel_id"), F.col("o_orderpriority").alias("licence_id"))
    channels = spark.createDataFrame([("1-URGENT", "api", True), ("2-HIGH", "api", True), ("3-MEDIUM", "api", False)], "licence_id string, channel string, allowed boolean")
    told = rights.permitted(facts, channels, "licence_id", "api")
    return told.groupBy("parcel_id").agg(F.count_if("allowed").alias("shown"), F.count_if(~F.col("allowed")).alias("omitted"))


@query("""with e as (select l_orderkey fact_id, p_size%3 kind, p_partkey from lineitem join part on p_partkey = l_partkey),
 b as (select fact_id, bool_and(kind <> 0) commercial_use, bool_and(kind <> 1) redistribution, bool_or(kind = 2) attribution from e group by 1),
 n as (select fact_id, count(distinct kind) n from e group by 1), ch as (select fact_id, c, count(distinct kind) k from e, (select 0 c union all select 1 union all select 2) where (kind + c) % 3 <> 0 group by 1, 2)
 select b.*, coalesce((select list_sort(list('c'||ch.c)) from ch where ch.fact_id = b.fact_id and ch.k = n.n), []) channels from b join n using (fact_id)""")
def inherited_licences(spark, read):
    parts = read("part").select("p_partkey", F.concat(F.lit("k"), (F.col("p_size") % 3).cast("string")).alias("licence_id"))
    inputs = read("lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("fact_id"), F.col("l_partkey").cast("string").alias("input_fact_id"))
    fact = parts.select(F.col("p_partkey").cast("string").alias("id"), "licence_id")
    licence = spark.createDataFrame([("k0", "prohibited", "allowed", "open"), ("k1", "allowed", "prohibited", "open"), ("k2", "allowed", "allowed", "attribution")], "id string, commercial_use string, redistribution string, restriction string")
    channels = spark.createDataFrame([(f"k{k}", f"c{c}", (k + c) % 3 != 0) for k in range(3) for c in range(3)], "licence_id string, channel string, allowed boolean")
    return rights.inherited_licence(inputs, fact, licence, channels)


@query("""with cur as (select distinct user_id parcel_id, event_type field_key from events where value > 60), need as (select * from (values ('click', false), ('view', false), ('purchase', true)) t(field_key, deferred)),
 owed as (select c_custkey parcel_id, field_key, deferred from customer, need), lack as (select o.* from owed o left join cur c on c.parcel_id = o.parcel_id and c.field_key = o.field_key where c.parcel_id is null)
 select parcel_id, coalesce(list_sort(list(field_key) filter (where not deferred)), []) unmet_fields, coalesce(list_sort(list(field_key) filter (where deferred)), []) deferred_fields from lack group by 1""")
def unmet_fields(spark, read):
    need = spark.createDataFrame([("click", True, False), ("view", True, False), ("purchase", True, True), ("other", False, False)], "field_key string, required_for_file boolean, phase1_deferred boolean")
    held = read("events").where("value > 60").select(F.col("user_id").alias("parcel_id"), F.col("event_type").alias("field_key"))
    return compose.unmet_fields(need, held, read("customer").select(F.col("c_custkey").alias("id")))


@query(f"""with {_LEDGER} select field_key, count(*) filter (where coalesce(date_diff('day', cast(retrieved_at as date), date '2024-02-10') > case field_key when 'click' then 20 when 'view' then 30 end, false)) n_stale, count(*) n from ledger group by 1""")
def stale_facts(spark, read):
    limit = F.when(F.col("field_key") == "click", 20).when(F.col("field_key") == "view", 30)
    return t.ledger(read("events")).groupBy("field_key").agg(F.count_if(time.stale(F.lit("2024-02-10").cast("date"), F.col("retrieved_at"), limit)).alias("n_stale"), F.count("*").alias("n"))


@query("""select coalesce(e.v, r.v) version, case when r.v is null then 'missing' when e.v is null then 'unexpected' when e.h <> r.h then 'changed' else 'recorded' end state
 from (select cast(c_custkey as varchar) v, c_nationkey % 3 h from customer where c_custkey % 7 <> 0) e full outer join (select cast(c_custkey as varchar) v, (c_nationkey + case when c_custkey % 11 = 0 then 1 else 0 end) % 3 h from customer where c_custkey % 5 <> 0) r on e.v = r.v""")
def migration_states(spark, read):
    c, n = F.col("c_custkey"), F.col("c_nationkey")
    expected = read("customer").where(c % 7 != 0).select(c.cast("string").alias("version"), (n % 3).cast("string").alias("file_sha256"))
    recorded = read("customer").where(c % 5 != 0).select(c.cast("string").alias("version"), ((n + F.when(c % 11 == 0, 1).otherwise(0)) % 3).cast("string").alias("file_sha256"))
    return views.migrations(expected, recorded)


@query("""with x as (select user_id * 10 + event_id % 10 id, ts, event_id, case when value > 300 then 'open' when value > 100 then 'condition_cleared' else 'confirmed' end outcome from events)
 select id, outcome from (select *, row_number() over (partition by id order by ts desc, outcome) rn from x) where rn = 1""")
def exception_states(spark, read):
    e, v = read("events"), F.col("value")
    rows = e.select((F.col("user_id") * 10 + F.col("event_id") % 10).alias("id"), F.col("ts").alias("event_at"), F.when(v > 300, "open").when(v > 100, "condition_cleared").otherwise("confirmed").alias("outcome"))
    return exceptions.fold(rows).select("id", "outcome")


@query("""select l_orderkey k, sum(l_quantity) filter (where l_linenumber < 4) was, sum(l_quantity) filter (where l_linenumber > 2) now,
 case when count(*) filter (where l_linenumber < 4) = 0 then 'new' when count(*) filter (where l_linenumber > 2) = 0 then 'disappeared' when sum(l_quantity) filter (where l_linenumber < 4) = sum(l_quantity) filter (where l_linenumber > 2) then 'same' else 'changed' end cls
 from lineitem group by 1 having count(*) filter (where l_linenumber < 4 or l_linenumber > 2) > 0""")
def reconcile_totals(spark, read):
    sums = lambda cond: read("lineitem").where(cond).groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_quantity").alias("q"))
    return reconcile.diff(sums("l_linenumber < 4"), sums("l_linenumber > 2"), ["k"], "q")
