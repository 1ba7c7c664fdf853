"""The current fact as a stored table that is kept up to date by what happened, not by ranking all facts anew.

Which fact holds for an entity and field can only change when one of its facts is recorded or
superseded, or when a date passes on which one begins or ceases to be in effect. The former are
the rows that runs have written since the last refresh; the latter stand in a calendar that is
written along with the facts. A refresh ranks the facts of those entities and fields only: they
are found by a semi join, so other facts are read (their key columns) but never shuffled.

The stored table is a log: a row says which fact holds from ``event_at`` on, or that none does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspan.operators.current import current_fact_at, top_per_group


def calendar(facts: DataFrame, after: Column, entity: str = "parcel_id", field: str = "field_key") -> DataFrame:
    """(entity, field, at): the moments after ``after`` at which these facts begin or cease to hold by their own dates."""
    dates = F.array(*[F.col(c) for c in ("effective_from", "effective_to", "recorded_at", "superseded_at")])
    return facts.select(entity, field, F.explode(F.array_distinct(dates)).alias("at")).where(F.col("at") > after).distinct()


def due(moments: DataFrame, since: Column, now: Column, entity: str = "parcel_id", field: str = "field_key") -> DataFrame:
    """(entity, field) with a moment in (since, now]."""
    return moments.where((F.col("at") > since) & (F.col("at") <= now)).select(entity, field).distinct()


def refresh(facts: DataFrame, source_rank: DataFrame, keys: DataFrame, now: Column, entity: str = "parcel_id", field: str = "field_key", **ranking) -> DataFrame:
    """What holds at ``now`` for the entities and fields in ``keys``: the fact's columns, ``held`` and ``event_at``.

    Where no fact holds there is a row too, with ``held`` false. ``ranking`` goes to ``current_fact_at``.
    """
    keys = keys.where(F.col(entity).isNotNull() & F.col(field).isNotNull()).select(entity, field).distinct()
    found = current_fact_at(facts.join(keys, [entity, field], "left_semi"), source_rank, now, entity=entity, field=field, **ranking)
    found = found.select(*facts.columns).withColumn("held", F.lit(True))
    return keys.join(found, [entity, field], "left").select(*facts.columns, F.coalesce("held", F.lit(False)).alias("held"), now.alias("event_at"))


def latest(log: DataFrame, entity: str = "parcel_id", field: str = "field_key") -> DataFrame:
    """The log's last word on each entity and field: the current facts."""
    return top_per_group(log, [entity, field], [F.col("event_at").desc()]).where("held").drop("held", "event_at")
