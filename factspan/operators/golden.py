"""Normal forms that make two runs comparable: ids by position, lists sorted."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from factspan.operators.difference import differences


def positional_tokens(rows: DataFrame, by: str, order: str, label: str = "UUID") -> DataFrame:
    """``rows`` with ``tok``: <label:n> for the n-th group by its first (integer, unique) ``order``.

    A running number over all groups, without one task that sees them all: firsts are numbered
    inside of ranges of 2 ** 16 ids, and each range adds the groups of the ranges before it.
    """
    span = F.shiftright(F.col("_first"), 16)
    first = rows.groupBy(by).agg(F.min(order).alias("_first")).withColumn("_span", span)
    before = first.groupBy("_span").agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(Window.orderBy("_span")) - F.col("_n"))
    inside = F.row_number().over(Window.partitionBy("_span").orderBy("_first"))
    numbered = first.withColumn("_in", inside).join(before, "_span").select(by, (F.col("_in") + F.col("_before")).alias("_at"))
    return rows.join(numbered, by).withColumn("tok", F.concat(F.lit(f"<{label}:"), F.col("_at").cast("string"), F.lit(">"))).drop("_at")


def sorted_set(rows: DataFrame, by: str, value: str, name: str) -> DataFrame:
    return rows.groupBy(by).agg(F.sort_array(F.collect_set(value)).alias(name))


_ID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)
_TIME = re.compile(r"\d{4}-\d\d-\d\d[T ]\d\d:\d\d(?::\d\d(?:\.\d+)?)?(?:Z|[+-]\d\d:?\d\d)?")


def normal_form(payload, seen: dict | None = None):
    """A payload without what differs from run to run: ids by the order of their first appearance, times masked, lists sorted.

    Keys are visited in sorted order, lists in their own; they are sorted by their normal text afterwards.
    """
    seen = {} if seen is None else seen
    if isinstance(payload, dict):
        return {k: normal_form(payload[k], seen) for k in sorted(payload)}
    if isinstance(payload, list):
        return sorted((normal_form(x, seen) for x in payload), key=lambda x: json.dumps(x, sort_keys=True))
    if isinstance(payload, str):
        named = _ID.sub(lambda m: f"<UUID:{seen.setdefault(m[0].lower(), len(seen) + 1)}>", payload)
        return _TIME.sub("<TIME>", named)
    return payload


@F.pandas_udf(StringType())
def normalised(payloads: pd.Series) -> pd.Series:
    """The normal form of JSON texts, as text with sorted keys; null and what is no JSON stay as they are."""

    def one(text):
        try:
            return text if text is None else json.dumps(normal_form(json.loads(text)), sort_keys=True)
        except ValueError:
            return text

    return payloads.map(one)


def linked_facts(links: DataFrame, facts: DataFrame, by: str = "property_file_id") -> DataFrame:
    """A file's links with the field and value of their facts, one sorted list of 'use field value' per file."""
    rows = links.join(facts.select(F.col("id").alias("fact_id"), "field_key", "value"), "fact_id")
    return rows.groupBy(by).agg(F.array_sort(F.collect_list(F.concat_ws(" ", "use", "field_key", F.col("value").cast("string")))).alias("facts"))


def bless(forms: DataFrame, key: str, form: str, path: str) -> None:
    """Write normal forms (JSON text) as the ones to compare with later, one line for each, in order of their keys within a file."""
    forms.select(F.col(key).cast("string").alias("key"), F.col(form).alias("form")).repartitionByRange("key").sortWithinPartitions("key").write.mode("overwrite").json(path)


def compare(forms: DataFrame, key: str, form: str, path: str) -> DataFrame:
    """(key, path, kind, was, now, moved_to): how normal forms differ from the blessed ones; empty if they don't."""
    before = forms.sparkSession.read.schema("key string, form string").json(path)
    return differences(before, forms.select(F.col(key).cast("string").alias("key"), F.col(form).alias("form")), "key", "form")
