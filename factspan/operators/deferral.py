"""Fields that can't be had, and the conclusions that fall with them.

A field whose source is deferred is told by name, with the conclusions that depend on it, directly
or through other conclusions; such a conclusion is refused with the inputs that it lacks. Nothing
is left out silently. Which conclusion needs which inputs is a manifest, a registry of edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspan.operators.lineage import ancestors


def dependents(manifest: DataFrame, conclusion: str = "conclusion", needs: str = "input") -> DataFrame:
    """(conclusion, input): every input that a conclusion rests on, through other conclusions too."""
    return ancestors(manifest.select(conclusion, needs), conclusion, needs).select(F.col(conclusion).alias("conclusion"), F.col("ancestor").alias("input"))


def lacking_fields(entities: DataFrame, definitions: DataFrame, current: DataFrame, entity: str = "parcel_id") -> DataFrame:
    """(entity, field_key, deferred, source_id): the fields of definitions(field_key, deferred, source_id) that an entity has no current fact of.

    Definitions are a registry, so that each entity can take the list along.
    """
    listed = definitions.select("field_key", "deferred", "source_id").collect()
    if not listed:
        return entities.select(entity).limit(0).selectExpr(entity, "'' field_key", "false deferred", "'' source_id")
    need = F.array(*[F.struct(F.lit(r.field_key).alias("field_key"), F.lit(r.deferred).alias("deferred"), F.lit(r.source_id).cast("string").alias("source_id")) for r in listed])
    owed = entities.select(entity, F.inline(need))
    return owed.join(current.select(entity, "field_key").distinct(), [entity, "field_key"], "left_anti")


def source_deferred(lacking: DataFrame, manifest: DataFrame, entity: str = "parcel_id") -> DataFrame:
    """(entity, code, field_key, source_id, cascades_to): a refusal for each deferred field that an entity lacks."""
    falls = dependents(manifest).groupBy(F.col("input").alias("field_key")).agg(F.sort_array(F.collect_set("conclusion")).alias("cascades_to"))
    told = lacking.where("deferred").join(falls, "field_key", "left")
    return told.select(entity, F.lit("SOURCE_DEFERRED").alias("code"), "field_key", "source_id", F.coalesce("cascades_to", F.array().cast("array<string>")).alias("cascades_to"))


def refused_conclusions(lacking: DataFrame, manifest: DataFrame, entity: str = "parcel_id") -> DataFrame:
    """(entity, conclusion, missing): every conclusion that an entity can't have, with the fields that it lacks for it."""
    rest = dependents(manifest).withColumnRenamed("input", "field_key")
    return lacking.join(rest, "field_key").groupBy(entity, "conclusion").agg(F.sort_array(F.collect_set("field_key")).alias("missing"))
