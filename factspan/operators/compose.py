"""Composing a file: every stage may refuse, refusals add up, and what was touched is linked."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from factspan.functions.json import payload_hash, payload_text
from factspan.operators.rights import permitted
from factspan.operators.rules import effective_rules, ruleset_version
from factspan.plans.vocabulary import CHANNELS

#: Conclusions that need a jurisdiction's geometry tier.
GEOMETRY_CONCLUSIONS = ("placement", "cost_scenario")
_REFUSAL = "struct<code:string,stage:string,message:string,detail:map<string,string>>"


def geometry_gate(conclusion: str, enabled: Column) -> Column:
    """The refusal GEOMETRY_TIER_DISABLED where the tier is off; null where it is on."""
    if conclusion not in GEOMETRY_CONCLUSIONS:
        raise ValueError(f"{conclusion} does not depend on geometry")
    return F.when(~enabled, _refusal("GEOMETRY_TIER_DISABLED", "L7", F.lit(f"{conclusion} needs the geometry tier"), conclusion=F.lit(conclusion)))


def _refusal(code: str, stage: str, message: Column, **detail: Column) -> Column:
    pairs = [x for k, v in detail.items() for x in (F.lit(k), v.cast("string"))]
    return F.struct(F.lit(code).alias("code"), F.lit(stage).alias("stage"), message.alias("message"), F.create_map(*pairs).cast("map<string,string>").alias("detail"))


@F.pandas_udf(StructType([StructField("payload", StringType()), StructField("payload_hash", StringType())]))
def _payload(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for s in batches:
        payloads = []
        for file in s.to_dict("records"):
            refusals = [r.asDict() if hasattr(r, "asDict") else dict(r) for r in file["refusals"]]
            payloads.append({"status": file["status"], "refusals": [r | {"detail": dict(r["detail"])} for r in refusals], "attribution": list(file["attribution"]), "omitted_for_rights": []})
            if file["status"] != "refused":
                payloads[-1] |= {"facts": dict(file["facts"]), "unmet_fields": list(file["unmet_fields"])}
        yield pd.DataFrame({"payload": [payload_text(p) for p in payloads], "payload_hash": [payload_hash(p) for p in payloads]})


def compose(requests: DataFrame, parcels: DataFrame, current: DataFrame, channels: DataFrame, jurisdictions: DataFrame, rules: DataFrame, as_of: Column, elections: dict[str, str], channel: str, definitions: DataFrame | None = None, licences: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(files, links) for ``requests(request_id, parcel_id, election)``.

    Refusals accumulate in a fixed order: unknown parcel (alone, and without a file), geometry
    tier, no facts, election or rule, then one per blocked licence in order. Every fact of the
    parcel is touched and linked. A request without any refusal composes nothing (status null)
    unless field ``definitions`` are given: then it is composed, or partial if a required field
    has no current fact, and its payload holds the facts and what ``licences`` ask to attribute.
    elections: election -> rule key.
    """
    if channel not in CHANNELS:
        raise ValueError(f"{channel} is no output channel")
    place = parcels.select(F.col("id").alias("parcel_id"), "jurisdiction_id").join(jurisdictions.select(F.col("id").alias("jurisdiction_id"), "geometry_tier_enabled"), "jurisdiction_id")
    asked = requests.join(place, "parcel_id", "left")
    touched = asked.select("request_id", "parcel_id").join(current.select("parcel_id", F.col("id").alias("fact_id"), "field_key", "licence_id", "snapshot_id"), "parcel_id")
    gate = permitted(touched, channels, "licence_id", channel)
    blocked = gate.where(~F.col("allowed")).groupBy("request_id", "licence_id").agg(F.array_sort(F.collect_set("field_key")).alias("f"))
    rights = blocked.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("licence_id", "f"))).alias("b"))
    counts = touched.groupBy("request_id").agg(F.count("*").alias("n_facts"))
    wanted = F.create_map(*[F.lit(x) for pair in elections.items() for x in pair])[F.col("election")] if elections else F.lit(None).cast("string")
    rule = effective_rules(rules, as_of, ["jurisdiction_id", "rule_key"]).select("jurisdiction_id", "rule_key", F.col("version").alias("rule_version"))
    rows = asked.withColumn("rule_key", wanted).join(rule, ["jurisdiction_id", "rule_key"], "left").join(rights, "request_id", "left").join(counts, "request_id", "left")
    election = (
        F.when(F.col("election").isNull(), _refusal("ELECTION_REQUIRED", "L5", F.lit("an election is required"), election=F.lit("")))
        .when(F.col("rule_key").isNull(), _refusal("ELECTION_NOT_SUPPORTED", "L5", F.lit("the election is not supported"), election=F.col("election")))
        .when(F.col("rule_version").isNull(), _refusal("RULE_UNAVAILABLE", "L5", F.lit("no rule is effective"), rule_key=F.col("rule_key")))
    )
    stages = F.array(
        geometry_gate("placement", F.coalesce("geometry_tier_enabled", F.lit(False))),
        F.when(F.coalesce("n_facts", F.lit(0)) == 0, _refusal("PARCEL_NO_FACTS", "L4", F.lit("no fact is current"), parcel_id=F.col("parcel_id"))),
        election,
    )
    fields = lambda x: F.array_join(x["f"], ", ")
    told = lambda x: _refusal("RIGHTS_BLOCKED", "L8", F.concat(F.lit("licence "), x["licence_id"], F.lit(f" forbids {channel} for "), fields(x)), licence_id=x["licence_id"], channel=F.lit(channel), field_keys=fields(x))
    by_licence = F.coalesce(F.transform("b", told), F.array().cast(f"array<{_REFUSAL}>"))
    unknown = F.array(_refusal("PARCEL_REFERENCE_UNKNOWN", "L0", F.lit("no such parcel"), parcel_id=F.col("parcel_id")))
    known = F.col("jurisdiction_id").isNotNull()
    refusals = F.when(~known, unknown).otherwise(F.concat(F.filter(stages, lambda r: r.isNotNull()), by_licence))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("refusals", refusals)
    status = F.when(known & (F.size("refusals") > 0), "refused")
    if definitions is None:
        rows = rows.withColumns({"unmet_fields": none, "facts": F.create_map().cast("map<string,string>"), "attribution": none})
    else:
        lacking = unmet_fields(definitions, current, parcels).select("parcel_id", "unmet_fields")
        credit = (licences if licences is not None else rows.sparkSession.createDataFrame([], "id string, restriction string, attribution_text string")).where("restriction = 'attribution'").select(F.col("id").alias("licence_id"), "attribution_text")
        told = current.join(credit, "licence_id", "left").groupBy("parcel_id").agg(
            F.map_from_entries(F.array_sort(F.collect_set(F.struct("field_key", F.col("value").cast("string"))))).alias("facts"), F.array_sort(F.collect_set("attribution_text")).alias("attribution"))
        rows = rows.join(lacking, "parcel_id", "left").join(told, "parcel_id", "left").withColumns({"unmet_fields": F.coalesce("unmet_fields", none), "attribution": F.coalesce("attribution", none), "facts": F.coalesce("facts", F.create_map().cast("map<string,string>"))})
        status = F.when(F.size("refusals") > 0, status).when(F.size("unmet_fields") > 0, "partial").otherwise("composed")
    rows = rows.withColumn("status", status)
    version = ruleset_version(F.col("rule_key"), F.col("rule_version"), F.when(F.col("rule_key").isNull(), election["code"]), F.col("jurisdiction_id"), as_of)
    rows = rows.withColumn("_p", F.when(F.col("status").isNotNull(), _payload(F.struct("status", "refusals", "attribution", "unmet_fields", "facts"))))
    files = rows.select("request_id", "parcel_id", "jurisdiction_id", F.lit(channel).alias("channel"), "election", "status", "refusals", F.col("geometry_tier_enabled").alias("geometry_tier_used"), version.alias("ruleset_version"), "unmet_fields", F.col("_p.payload").alias("payload"), F.col("_p.payload_hash").alias("payload_hash"))
    made = files.where("status is not null").select("request_id", F.when(F.col("status") == "refused", "input").otherwise("rendered").alias("use"))
    links = touched.join(made, "request_id").select("request_id", "fact_id", "snapshot_id", "use")
    return files, links


def visible_facts(current: DataFrame, channels: DataFrame, channel: str, parcel: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(permitted, omitted for rights) current facts, marked whether derived."""
    rows = permitted(current if parcel is None else current.where(F.col("parcel_id") == parcel), channels, "licence_id", channel).withColumn("is_derived", F.col("method") == "derived")
    return rows.where("allowed").drop("allowed"), rows.where("not allowed").drop("allowed")


def unmet_fields(definitions: DataFrame, current: DataFrame, parcels: DataFrame) -> DataFrame:
    """(parcel_id, unmet_fields): required fields without a current fact, deferred ones apart."""
    need = definitions.where("required_for_file").select("field_key", "phase1_deferred")
    # the required fields are a short list of the registry: each parcel gets it and takes it apart
    needed = need.agg(F.collect_list(F.struct("field_key", "phase1_deferred")).alias("_need")).withColumn("_all", F.lit(1))
    owed = parcels.select(F.col("id").alias("parcel_id"), F.lit(1).alias("_all")).join(F.broadcast(needed), "_all").select("parcel_id", F.inline("_need"))
    lacking = owed.join(current.select("parcel_id", "field_key").distinct(), ["parcel_id", "field_key"], "left_anti")
    return lacking.groupBy("parcel_id").agg(F.array_sort(F.collect_list(F.when(~F.col("phase1_deferred"), F.col("field_key")))).alias("unmet_fields"), F.array_sort(F.collect_list(F.when(F.col("phase1_deferred"), F.col("field_key")))).alias("deferred_fields"))
