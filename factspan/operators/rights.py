"""Rights: what may be shown where. A missing permission is a refusal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def permitted(rows: DataFrame, channels: DataFrame, licence: str, channel: str) -> DataFrame:
    """``rows`` with ``allowed``: whether the licence permits the channel; no row means no."""
    rights = channels.where(F.col("channel") == F.lit(channel))
    rights = rights.groupBy(F.col("licence_id").alias("_lic")).agg(F.bool_and("allowed").alias("_ok"))
    return rows.join(rights, F.col(licence) == F.col("_lic"), "left").withColumn("allowed", F.coalesce("_ok", F.lit(False))).drop("_lic", "_ok")


def rights_gate(touched: DataFrame, channels: DataFrame, channel: str, by: str = "property_file_id") -> DataFrame:
    """Per output and licence over *every* touched fact: allowed or not, and the fields behind it."""
    told = permitted(touched, channels, "licence_id", channel)
    return told.groupBy(by, "licence_id", "allowed").agg(F.array_sort(F.collect_set("field_key")).alias("field_keys"))


def with_new_channels(licence: DataFrame, channels: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """(licence_id, channel, allowed): what is there, and every licence's new channels, denied until someone allows them."""
    new = licence.select(F.col("id").alias("licence_id"), F.explode(F.array(*[F.lit(n) for n in names])).alias("channel"), F.lit(False).alias("allowed"))
    held = channels.select("licence_id", "channel", "allowed")
    return held.unionByName(new.join(held.select("licence_id", "channel"), ["licence_id", "channel"], "left_anti"))


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """By key over all partitions of a shuffle: these rows shrink so much when written that merging them by size makes large sorts."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def over_permitted(derived: DataFrame, inputs: DataFrame, input_channels: DataFrame, key: str, channel: str = "channel", licence: str = "licence_id") -> DataFrame:
    """(key, over_permitted): derived things that claim a channel which some input's licence lacks.

    derived: key, channel claimed; inputs: key, licence of each input; input_channels: licence,
    channel allowed. An input looks up its licence's channels once and meets the claims by key, so
    claims are never multiplied by inputs before a shuffle.
    """
    may = input_channels.where(F.col(channel).isNotNull()).groupBy(licence).agg(F.collect_set(channel).alias("_may"))
    need = inputs.join(may, licence, "left").select(key, "_may")
    lacking = derived.join(_dealt(need, key), key).where(~F.coalesce(F.array_contains("_may", F.col(channel)), F.lit(False)))
    return lacking.groupBy(key).agg(F.min(channel).alias("over_permitted"))


def _profiles(licence: DataFrame, channels: DataFrame) -> tuple[list[str], int, DataFrame]:
    """(channel names in order, n, profiles): one row a licence with its terms and its allowed channels as bits of n numbers.

    Licences and channels are registries. Facts are many and share few licences, so they are
    never shuffled by licence: profiles are broadcast.
    """
    allowed = channels.where(F.col("allowed") & F.col("channel").isNotNull())
    names = allowed.agg(F.array_sort(F.collect_set("channel"))).first()[0]
    n = -(-len(names) // 63)
    rows = licence.select(F.col("id").alias("licence_id"), "commercial_use", "redistribution", "restriction", F.lit(True).alias("_known"))
    if n:
        at = (F.array_position(F.lit(names), F.col("channel")) - 1).cast("int")
        bit = lambda k: F.when(F.floor(at / 63) == k, F.call_function("shiftleft", F.lit(1).cast("long"), at % 63)).otherwise(F.lit(0).cast("long"))
        rows = rows.join(allowed.groupBy("licence_id").agg(*[F.bit_or(bit(k)).alias(f"_c{k}") for k in range(n)]), "licence_id", "full")
    return names, n, rows


def _has(mask: str, i: int):
    return F.call_function("getbit", F.coalesce(F.col(f"{mask}{i // 63}"), F.lit(0).cast("long")), F.lit(i % 63)) == 1


def inheritance_violations(fact_input: DataFrame, fact: DataFrame, licence: DataFrame, channels: DataFrame) -> DataFrame:
    """(fact_id, dimension, detail): derived facts whose licence grants more than their inputs' do.

    Channels, commercial use and redistribution may be granted only if every input grants them;
    attribution is required if any input requires it. Facts without inputs are not looked at.
    """
    own = fact.select(F.col("id").alias("fact_id"), F.col("licence_id").alias("own"))
    theirs = fact.select(F.col("id").alias("input_fact_id"), "licence_id")
    edges = _dealt(_dealt(fact_input, "input_fact_id").join(theirs, "input_fact_id").select("fact_id", "licence_id"), "fact_id").join(own, "fact_id")
    names, n, profiles = _profiles(licence, channels)
    mine, its = (profiles.select(*[F.col(c).alias(p + c) for c in profiles.columns]) for p in ("m_", "i_"))
    pairs = edges.join(F.broadcast(mine), F.col("own") == F.col("m_licence_id"), "left").join(F.broadcast(its), F.col("licence_id") == F.col("i_licence_id"), "left")
    lacks = lambda k: F.coalesce(F.col(f"m__c{k}"), F.lit(0).cast("long")).bitwiseAND(F.bitwise_not(F.coalesce(F.col(f"i__c{k}"), F.lit(0).cast("long"))))
    checks = pairs.groupBy("fact_id").agg(
        F.bool_or((F.col("m_commercial_use") == "allowed") & (F.col("i_commercial_use") != "allowed")).alias("commercial_use"),
        F.bool_or((F.col("m_redistribution") == "allowed") & (F.col("i_redistribution") != "allowed")).alias("redistribution"),
        F.bool_or((F.col("m_restriction") != "attribution") & (F.col("i_restriction") == "attribution")).alias("attribution"),
        *[F.bit_or(lacks(k)).alias(f"_l{k}") for k in range(n)],
    )
    breach = lambda d, detail: F.struct(F.lit(d).alias("dimension"), detail.cast("string").alias("detail"))
    first = F.coalesce(*[F.when(_has("_l", i), F.lit(c)) for i, c in enumerate(names)]) if names else F.lit(None)
    found = [F.when(F.col(d), breach(d, F.lit(None))) for d in ("commercial_use", "redistribution", "attribution")] + [F.when(first.isNotNull(), breach("channel", first))]
    return checks.select("fact_id", F.inline(F.array_compact(F.array(*found))))


def inherited_licence(fact_input: DataFrame, fact: DataFrame, licence: DataFrame, channels: DataFrame) -> DataFrame:
    """What a derived fact may grant: the intersection of its inputs' grants, attribution if any asks for it."""
    theirs = fact.select(F.col("id").alias("input_fact_id"), "licence_id")
    names, n, profiles = _profiles(licence, channels)
    inputs = _dealt(_dealt(fact_input, "input_fact_id").join(theirs, "input_fact_id").select("fact_id", "licence_id"), "fact_id").join(F.broadcast(profiles), "licence_id", "left")
    grants = inputs.groupBy("fact_id").agg(
        F.bool_and(F.col("commercial_use") == "allowed").alias("commercial_use"), F.bool_and(F.col("redistribution") == "allowed").alias("redistribution"), F.bool_or(F.col("restriction") == "attribution").alias("attribution"),
        F.bool_or("_known").alias("_known"), *[F.bit_and(F.coalesce(F.col(f"_c{k}"), F.lit(0).cast("long"))).alias(f"_c{k}") for k in range(n)])
    shared = F.array_compact(F.array(*[F.when(_has("_c", i), F.lit(c)) for i, c in enumerate(names)])) if names else F.array()
    return grants.where("_known").select("fact_id", "commercial_use", "redistribution", "attribution", shared.cast("array<string>").alias("channels"))
