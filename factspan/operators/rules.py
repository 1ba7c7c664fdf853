"""Effective-dated, versioned rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspan.functions.time import during
from factspan.operators.current import top_per_group


def effective_rules(rules: DataFrame, as_of: Column, by: list[str], version: str = "version", start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """The highest version in effect at ``as_of`` for each key of ``by``."""
    return top_per_group(rules.where(during(as_of, F.col(start), F.col(end))), by, [F.col(version).desc()])


def select_rules(wanted: DataFrame, rules: DataFrame, as_of: Column) -> DataFrame:
    """``wanted(jurisdiction_id, rule_key)`` with the rule in effect, or the refusal RULE_UNAVAILABLE."""
    found = effective_rules(rules, as_of, ["jurisdiction_id", "rule_key"])
    out = wanted.join(found, ["jurisdiction_id", "rule_key"], "left")
    return out.withColumn("refusal", F.when(F.col("version").isNull(), "RULE_UNAVAILABLE"))


def ruleset_version(rule_key: Column, version: Column, election_code: Column, jurisdiction: Column, as_of: Column) -> Column:
    """Which rule a composed file went by, or why none."""
    return (
        F.when(version.isNotNull(), F.concat_ws("@", rule_key, version))
        .when(election_code.isNotNull(), F.concat(F.lit("no rule selected: "), election_code))
        .otherwise(F.concat(F.lit("no rule effective: jurisdiction="), jurisdiction, F.lit(", rule_key="), rule_key, F.lit(", as_of="), as_of.cast("string")))
    )
