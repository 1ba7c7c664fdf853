"""Integrity as queries: each validator returns the rows that break a rule, none if all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(rows: DataFrame, condition: Column, name: str) -> DataFrame:
    """Rows for which the condition is false. Unknown (null) passes, as in SQL."""
    return rows.where(~condition).withColumn("violates", F.lit(name))


def unique(rows: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def references(rows: DataFrame, keys: list[str], target: DataFrame, target_keys: list[str]) -> DataFrame:
    """Rows whose key the target lacks; a key with a null in it refers to nothing and passes."""
    full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    there = target.select(*[F.col(t).alias(f"_t{i}") for i, t in enumerate(target_keys)])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_t{i}") for i, k in enumerate(keys)])
    return rows.where(full).join(there, on, "left_anti")


def one_current_per_source(fact: DataFrame) -> DataFrame:
    """At most one live fact per entity, field, source and method version; missing ones count as equal."""
    live = fact.where("superseded_at is null")
    return unique(live, ["parcel_id", "field_key", F.coalesce("source_id", F.lit("~derived")).alias("source_id"), F.coalesce("method_version", F.lit("~")).alias("method_version")])


def one_open_exception(exceptions: DataFrame, subject: list[str], reason: Column) -> DataFrame:
    return unique(exceptions, [*subject, F.coalesce(reason, F.lit("")).alias("reason")])


def fact_checks(fact: DataFrame) -> DataFrame:
    """All row rules of the fact table, one row per breach."""
    c = F.col
    derived = (c("method") == "derived") & c("source_id").isNull() & c("snapshot_id").isNull() & c("method_version").isNotNull()
    fetched = (c("method") != "derived") & c("source_id").isNotNull() & c("snapshot_id").isNotNull() & c("retrieved_at").isNotNull() & c("source_url").isNotNull()
    rules = {
        "provenance_complete": derived | fetched,
        "method_automated": c("method").isin("direct", "bulk", "derived"),
        "supersedes_not_self": c("supersedes_fact_id") != c("id"),
        "supersession_reason": c("supersedes_fact_id").isNull() == c("supersession_reason").isNull(),
        "transaction_time": c("superseded_at").isNull() | (c("superseded_at") >= c("recorded_at")),
        "valid_time": c("effective_to").isNull() | (c("effective_to") > c("effective_from")),
    }
    broken = F.filter(F.array(*[F.when(~cond, F.lit(name)) for name, cond in rules.items()]), lambda x: x.isNotNull())
    return fact.select("id", F.explode(broken).alias("violates"))


#: Row rules by table and name; a rule that is null holds. The model's constraints.
TABLE_CHECKS = {
    "fact_input": {"not_self": "fact_id <> input_fact_id"},
    "field_definition": {
        "deferral_reason": "not phase1_deferred or deferral_reason is not null", "deferred_not_required": "not phase1_deferred or not required_for_file",
        "value_type": "value_type in ('string', 'number', 'boolean', 'date', 'geometry', 'enum', 'object')", "enum_values": "value_type <> 'enum' or enum_values is not null", "unit_for_number": "value_type <> 'number' or unit is not null",
    },
    "job_run": {
        "finished_after_started": "finished_at >= started_at", "metrics_object": "ltrim(metrics) like '{%'", "rows_in": "rows_in >= 0", "rows_out": "rows_out >= 0",
        "finished_unless_running": "(status = 'running') = (finished_at is null)",
    },
    "jurisdiction": {"kind": "kind in ('city', 'county', 'state')"},
    "licence": {"attribution_text": "restriction <> 'attribution' or attribution_text is not null"},
    "parcel_exception": {
        "resolution": "case when outcome = 'open' then resolved_at is null and resolved_by is null else resolved_at is not null and resolved_by is not null end", "resolved_after_detected": "resolved_at >= detected_at",
    },
    "property_file": {
        "partial_declares_gap": "status <> 'partial' or n_unmet > 0 or n_refusals > 0", "refusal_reason": "status <> 'refused' or n_refusals > 0", "refused_not_delivered": "status <> 'refused' or delivered_at is null",
        "compose_ms": "compose_ms >= 0", "election": "election in ('city', 'state')",
    },
    "property_file_fact": {"use": "use in ('rendered', 'gate', 'input')"},
    "rule": {"effective": "effective_to > effective_from", "version": "version > 0", "review": "case when review_mode = 'independent' then reviewed_by <> authored_by and attestation_uri is null else reviewed_by = authored_by and attestation_uri is not null end"},
    "schema_migrations": {"sha256": "file_sha256 rlike '^[0-9a-f]{64}$'", "version": "version rlike '^[0-9]{4}$'"},
    "snapshot": {
        "byte_size": "byte_size >= 0", "content_hash": "content_hash rlike '^[0-9a-f]{64}$'", "id": "id = source_id || ':sha256:' || content_hash", "media_type": "trim(media_type) <> ''", "object_uri": "trim(object_uri) <> ''",
    },
    "source": {
        "active_phase": "not active or phase_status = 'active'", "active_method": "not active or method in ('direct', 'bulk')", "active_verified": "not active or url_verified_at is not null", "endpoint": "method = 'manual' or endpoint_url is not null",
    },
    "source_feature_identity": {
        "retired_after_seen": "retired_at >= last_seen_at", "seen_order": "last_seen_at >= first_seen_at",
        "retirement": "(retired_snapshot_id is null) = (retired_at is null) and (retired_at is null) = (retirement_reason is null)",
    },
    "source_rank": {"rank": "rank > 0"},
    "support_request": {"correction": "caused_correction = (correcting_fact_id is not null)"},
}


def table_checks(table: str, rows: DataFrame, key: str) -> DataFrame:
    """(key, violates): all row rules of a table, one row per breach."""
    broken = F.filter(F.array(*[F.when(~F.expr(rule), F.lit(name)) for name, rule in TABLE_CHECKS[table].items()]), lambda x: x.isNotNull())
    return rows.select(key, F.explode(broken).alias("violates"))


#: Which columns of a table refer to which of another.
REFERENCES = {
    "exception_evidence": [(("exception_id", "parcel_id"), "parcel_exception", ("id", "parcel_id")), (("fact_id", "parcel_id"), "fact", ("id", "parcel_id"))],
    "fact": [(("parcel_id", "jurisdiction_id"), "parcel", ("id", "jurisdiction_id")), (("snapshot_id", "source_id"), "snapshot", ("id", "source_id")), (("supersedes_fact_id", "parcel_id"), "fact", ("id", "parcel_id")), (("licence_id",), "licence", ("id",)), (("field_key",), "field_definition", ("field_key",))],
    "fact_input": [(("fact_id",), "fact", ("id",)), (("input_fact_id",), "fact", ("id",))],
    "licence_channel": [(("licence_id",), "licence", ("id",))],
    "parcel_exception": [(("parcel_id", "jurisdiction_id"), "parcel", ("id", "jurisdiction_id")), (("reopened_from_id",), "parcel_exception", ("id",))],
    "property_file": [(("parcel_id", "jurisdiction_id"), "parcel", ("id", "jurisdiction_id"))],
    "property_file_fact": [(("property_file_id", "parcel_id"), "property_file", ("id", "parcel_id")), (("fact_id", "parcel_id"), "fact", ("id", "parcel_id"))],
    "snapshot": [(("source_id",), "source", ("id",))],
    "source_rank": [(("source_id",), "source", ("id",)), (("field_key",), "field_definition", ("field_key",))],
    "support_request": [(("property_file_id",), "property_file", ("id",)), (("correcting_fact_id",), "fact", ("id",))],
}


def broken_references(tables: dict[str, DataFrame], table: str, key: str) -> DataFrame:
    """(key, refers_to): rows of a table that refer to what isn't there, for the references to tables at hand."""
    found = [references(tables[table], list(cols), tables[target], list(to)).select(key, F.lit(target).alias("refers_to")) for cols, target, to in REFERENCES.get(table, []) if target in tables]
    return reduce(DataFrame.unionByName, found) if found else tables[table].select(key, F.lit(None).cast("string").alias("refers_to")).limit(0)


def supersession_targets(fact: DataFrame) -> DataFrame:
    """Facts that supersede one of another entity, field or source, or one that is still live."""
    old = fact.select(F.col("id").alias("supersedes_fact_id"), F.col("parcel_id").alias("_p"), F.col("field_key").alias("_f"), F.col("source_id").alias("_s"), F.col("superseded_at").alias("_end"))
    pairs = fact.where("supersedes_fact_id is not null").join(old, "supersedes_fact_id", "left")
    ok = (F.col("_p") == F.col("parcel_id")) & (F.col("_f") == F.col("field_key")) & F.col("_end").isNotNull() & ((F.col("method") == "derived") | F.col("_s").eqNullSafe(F.col("source_id")))
    return pairs.where(~F.coalesce(ok, F.lit(False))).select("id", "supersedes_fact_id")


def changed_rows(before: DataFrame, after: DataFrame, key: list[str], may_change: tuple[str, ...] = ()) -> DataFrame:
    """Keys whose row was altered or removed between two versions of an append-only table.

    A column of ``may_change`` may go from null to a value, once.
    """
    fixed = [x for x in before.columns if x not in (*key, *may_change)]
    a = before.select(*key, F.struct(*fixed).alias("_a"), *[F.col(m).alias(f"_a_{m}") for m in may_change])
    b = after.select(*key, F.struct(*fixed).alias("_b"), *[F.col(m).alias(f"_b_{m}") for m in may_change], F.lit(True).alias("_there"))
    broken = F.col("_there").isNull() | ~F.col("_a").eqNullSafe(F.col("_b"))
    for m in may_change:
        broken = broken | (F.col(f"_a_{m}").isNotNull() & ~F.col(f"_a_{m}").eqNullSafe(F.col(f"_b_{m}")))
    return a.join(b, key, "left").where(broken).select(*key)
