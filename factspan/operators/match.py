"""Matching rows to entities by a canonicalised key, with an account of every loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspan.functions.text import canonical_identifier


def entity_keys(entities: DataFrame, key: str, entity: str) -> DataFrame:
    """(key, n, entity): keys of more than one entity are ambiguous and match nothing."""
    return entities.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n"), F.min(entity).alias("entity"))


def match(rows: DataFrame, raw: str, entities: DataFrame, key: str, entity: str) -> DataFrame:
    """``rows`` with key, cls (blank, not_found, ambiguous, matched) and the entity if matched."""
    keyed = rows.withColumn("key", canonical_identifier(F.col(raw)))
    joined = keyed.join(entity_keys(entities, key, entity), F.col("key") == F.col("_key"), "left")
    cls = F.when(F.coalesce(F.col("key"), F.lit("")) == "", "blank").when(F.col("n").isNull(), "not_found").when(F.col("n") > 1, "ambiguous").otherwise("matched")
    return joined.select(*rows.columns, "key", cls.alias("cls"), F.when(cls == "matched", F.col("entity")).alias("entity"))


def breakdown(matched: DataFrame, earliest: str) -> DataFrame:
    """Rows, distinct keys and the earliest date by outcome."""
    return matched.groupBy("cls").agg(F.count("*").alias("row_cnt"), F.count_distinct("key").alias("key_cnt"), F.min(earliest).alias("earliest"))


def entity_for_key(entities: DataFrame, key: str, entity: str) -> DataFrame:
    """All candidates of each key, sorted: one is an answer, several are never guessed between."""
    return entities.groupBy(key).agg(F.sort_array(F.collect_set(entity)).alias("candidates")).withColumn("status", F.when(F.size("candidates") == 1, "resolved").otherwise("ambiguous"))


def first_unique(rows: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows, in ``order``, that bring a key not seen before; blank keys never do."""
    plain = canonical_identifier(F.col(key))
    fresh = rows.where(F.coalesce(plain, F.lit("")) != "").groupBy(plain.alias("_key")).agg(F.min(F.struct(F.col(order), F.struct(*rows.columns).alias("row"))).alias("_first"))
    return fresh.select(F.col(f"_first.{order}").alias("_order"), "_first.row.*").orderBy("_order").limit(n).drop("_order")
