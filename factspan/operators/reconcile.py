"""Comparing what a source says now with what is believed: new, changed, same, gone, back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def diff(live: DataFrame, incoming: DataFrame, key: list[str], value: str) -> DataFrame:
    """Full outer comparison on one shuffle key: key, was, now, cls (new, disappeared, changed, same)."""
    a = live.select(*key, F.col(value).alias("was"), F.lit(True).alias("_a"))
    b = incoming.select(*key, F.col(value).alias("now"), F.lit(True).alias("_b"))
    cls = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "disappeared").when(F.col("was").eqNullSafe(F.col("now")), "same").otherwise("changed")
    return a.join(b, key, "full").select(*key, "was", "now", cls.alias("cls"))


def identity_events(identity: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Each source feature with its event: new, seen, reappeared or disappeared.

    A retired identity that stays away has no event; one that comes back is the same identity.
    """
    known = identity.select(*key, "parcel_id", F.col("retired_at").isNotNull().alias("_retired"), F.lit(True).alias("_known"))
    here = incoming.select(*key, F.lit(True).alias("_here"))
    event = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("_here").isNull() & ~F.col("_retired"), "disappeared")
        .when(F.col("_here") & F.col("_retired"), "reappeared")
        .when(F.col("_here"), "seen")
    )
    return known.join(here, key, "full").select(*key, "parcel_id", event.alias("event")).where("event is not null")


def identifier_change(was: Column, now: Column, reason: Column) -> Column:
    """What happens to an identifier that may be unresolvable now or before.

    was: the live value, null if there is none; now: the canonical incoming value; reason: why
    that is unresolvable, null if it is not.
    """
    return (
        F.when(reason.isNotNull() & was.isNotNull(), "degrade")
        .when(reason.isNotNull(), "still_unresolvable")
        .when(was.isNull(), "resolve")
        .when(was.eqNullSafe(now), "same")
        .otherwise("change")
    )


def successors(live: DataFrame, fresh: DataFrame, key: list[str], reason: Column) -> DataFrame:
    """Live facts against fresh values, as instructions.

    live: key, id, value; fresh: key, value. Out: key, value, supersedes_fact_id, reason,
    action: insert (no live fact), supersede (another value), retire (no fresh value), keep.
    """
    a = live.select(*key, F.col("id").alias("_id"), F.col("value").alias("_was"))
    b = fresh.select(*key, F.col("value").alias("_now"), F.lit(True).alias("_b"))
    action = F.when(F.col("_id").isNull(), "insert").when(F.col("_b").isNull(), "retire").when(F.col("_was").eqNullSafe(F.col("_now")), "keep").otherwise("supersede")
    out = a.join(b, key, "full").withColumn("action", action)
    return out.select(*key, F.col("_now").alias("value"), F.col("_id").alias("live_id"), F.when(F.col("action") == "supersede", F.col("_id")).alias("supersedes_fact_id"), F.when(F.col("action") == "supersede", reason).alias("supersession_reason"), "action")


def counters(instructions: DataFrame, field: str = "field_key") -> DataFrame:
    """How many of each field were inserted, superseded, retired, kept."""
    return instructions.groupBy(field, "action").count()


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, with ``side``; empty if they hold the same set."""
    return a.subtract(b).withColumn("side", F.lit("a")).unionByName(b.subtract(a).withColumn("side", F.lit("b")))


def insert_if_absent(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key the table doesn't have yet; of several, one."""
    return rows.dropDuplicates(key).join(table.select(*key), key, "left_anti")


def upsert(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """The table with the rows put in, replacing those with their key."""
    return table.join(rows.select(*key), key, "left_anti").unionByName(rows)
