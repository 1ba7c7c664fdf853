"""What was believed at a moment: one fact per entity and field, out of all sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factspan.functions.time import visible
from factspan.plans.vocabulary import UNRANKED


def top_per_group(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group. Spark keeps one row per group and task before it shuffles."""
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_nth = 1").drop("_nth")


def ranked(facts: DataFrame, source_rank: DataFrame, on: list[str], rank: str = "rank") -> DataFrame:
    """``facts`` with their source's rank. Ranks are a registry: a row per source and field."""
    return facts.join(source_rank, on, "left").withColumn(rank, F.coalesce(rank, F.lit(UNRANKED)))


def current_fact_at(
    facts: DataFrame, source_rank: DataFrame, at: Column, entity: str = "parcel_id", field: str = "field_key", fact: str = "id",
    confidence: Column | str = "confidence_ord", retrieved: str = "retrieved_at", on: tuple[str, ...] = ("field_key", "source_id"), rank: str = "rank",
) -> DataFrame:
    """The fact that holds at ``at`` for each entity and field.

    Of the facts visible then: the best-ranked source, the higher confidence (in the
    enumeration's order), the latest retrieved, the smallest id.
    """
    seen = ranked(facts.where(visible(at)), source_rank, list(on), rank)
    confidence = F.col(confidence) if isinstance(confidence, str) else confidence
    return top_per_group(seen, [entity, field], [F.col(rank), confidence, F.col(retrieved).desc_nulls_last(), F.col(fact)])


def live(facts: DataFrame, source: str, *fields: str) -> DataFrame:
    """What is believed now of these fields, from this source."""
    return facts.where(F.col("superseded_at").isNull() & (F.col("source_id") == source) & F.col("field_key").isin(*fields))


def register_visible_at(spark: SparkSession, view: str, name: str) -> None:
    """A temporary SQL table function ``name(at)``: the rows of a view of facts that are visible at a time."""
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(view).schema)
    condition = "{start} <= at and ({end} is null or {end} > at)"
    seen = " and ".join(condition.format(start=f"v.{a}", end=f"v.{b}") for a, b in (("recorded_at", "superseded_at"), ("effective_from", "effective_to")))
    spark.sql(f"create or replace temporary function {name}(at timestamp_ntz) returns table ({shape}) return select v.* from {view} v where {seen}")


def register_current_at(spark: SparkSession, view: str, ranks: str, name: str, entity: str = "parcel_id", field: str = "field_key", fact: str = "id", confidence: str = "confidence_ord") -> None:
    """A temporary SQL table function ``name(at)``: of a view of facts, the one that holds for each entity and field, as ``current_fact_at`` ranks them.

    ``ranks`` is a view of (field_key, source_id, rank).
    """
    register_visible_at(spark, view, f"{name}_visible")
    columns = spark.table(view).columns
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(view).schema)
    order = f"coalesce(r.rank, {UNRANKED}), v.`{confidence}`, v.retrieved_at desc nulls last, v.`{fact}`"
    ranked = f"select v.*, row_number() over (partition by v.`{entity}`, v.`{field}` order by {order}) _nth from {name}_visible(at) v left join {ranks} r on r.source_id = v.source_id and r.field_key = v.`{field}`"
    spark.sql(f"create or replace temporary function {name}(at timestamp_ntz) returns table ({shape}) return select {', '.join(f'`{c}`' for c in columns)} from ({ranked}) where _nth = 1")


def with_context(current: DataFrame, parcels: DataFrame, snapshots: DataFrame, entity: str = "parcel_id") -> DataFrame:
    """Current facts with their parcel, and with their snapshot where they have one (derived facts don't)."""
    where = parcels.select(F.col("id").alias(entity), *[F.col(c).alias(f"parcel_{c}") for c in parcels.columns if c != "id"])
    what = snapshots.select(F.col("id").alias("snapshot_id"), *[F.col(c).alias(f"snapshot_{c}") for c in snapshots.columns if c != "id"])
    return current.join(where, entity).join(what, "snapshot_id", "left")


def conflict_state(current: DataFrame, entity: str = "parcel_id", field: str = "field_key", value: str = "value", stale: Column | None = None) -> DataFrame:
    """Per entity and field over its visible facts: conflicts, stale, missing or agree."""
    seen = current.groupBy(entity, field).agg(F.count_distinct(value).alias("n_values"), F.min(F.coalesce(stale, F.lit(False)) if stale is not None else F.lit(False)).alias("all_stale"))
    state = F.when(F.col("n_values") > 1, "conflicts").when(F.col("n_values") == 0, "missing").when(F.col("all_stale"), "stale").otherwise("agree")
    return seen.select(entity, field, "n_values", state.alias("conflict"))
