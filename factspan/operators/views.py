"""What a reader of the ledger asks for: registries, latest runs, exceptions, files, facts, migrations.

Arguments are validated before a plan is built: an unknown enumeration value or a malformed id
is the caller's error, not an empty answer.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspan.operators.rights import permitted
from factspan.plans.vocabulary import CHANNELS, ENUMS

_UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)


def valid_id(value: str) -> str:
    if not _UUID.fullmatch(value):
        raise ValueError(f"{value!r} is not an id")
    return value.lower()


def valid_enum(enum: str, value: str) -> str:
    if value not in ENUMS[enum]:
        raise ValueError(f"{value!r} is no {enum}")
    return value


def newest(rows: DataFrame, at: str, key: str, n: int) -> DataFrame:
    """The n newest rows; rows of the same time in the order of their key."""
    return rows.orderBy(F.col(at).desc(), F.col(key)).limit(n)


def licences(licence: DataFrame, channels: DataFrame) -> DataFrame:
    """Each licence with its channels, denied ones included, sorted."""
    held = channels.groupBy(F.col("licence_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("channel", "allowed"))).alias("channels"))
    return licence.join(held, "id", "left").orderBy("id")


def exceptions(rows: DataFrame, outcome: str | None = None, detector_key: str | None = None, detector_version: str | None = None, n: int = 500) -> DataFrame:
    """The newest exceptions under any of the filters."""
    for column, value in (("outcome", outcome and valid_enum("exception_outcome", outcome)), ("detector_key", detector_key), ("detector_version", detector_version)):
        rows = rows.where(F.col(column) == value) if value is not None else rows
    return newest(rows, "detected_at", "id", n)


def files(property_files: DataFrame, links: DataFrame, n: int = 200) -> DataFrame:
    """The newest files with their links, in one join instead of a query for each."""
    top = newest(property_files, "composed_at", "id", n)
    held = links.join(top.select(F.col("id").alias("property_file_id")), "property_file_id", "left_semi")
    held = held.groupBy("property_file_id").agg(F.array_sort(F.collect_list(F.struct("fact_id", "use"))).alias("links"))
    return top.join(held, F.col("id") == F.col("property_file_id"), "left").drop("property_file_id")


def parcel_facts(current: DataFrame, channels: DataFrame, channel: str, parcel: str) -> DataFrame:
    """A parcel's facts: shown, or omitted for rights (then without their value)."""
    if channel not in CHANNELS:
        raise ValueError(f"{channel!r} is no output channel")
    rows = permitted(current.where(F.col("parcel_id") == parcel), channels, "licence_id", channel)
    return rows.select("parcel_id", "field_key", F.when(F.col("allowed"), F.col("value")).alias("value"), (F.col("method") == "derived").alias("is_derived"), (~F.col("allowed")).alias("omitted_for_rights")).orderBy("field_key")


def migrations(expected: DataFrame, recorded: DataFrame) -> DataFrame:
    """(version, state): recorded, missing, unexpected, or changed since (another hash)."""
    both = expected.select("version", F.col("file_sha256").alias("_e")).join(recorded.select("version", F.col("file_sha256").alias("_r")), "version", "full")
    state = F.when(F.col("_r").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when(F.col("_e") != F.col("_r"), "changed").otherwise("recorded")
    return both.select("version", state.alias("state")).orderBy("version")


def refusal_totals(files: DataFrame, refusals: str) -> DataFrame:
    """How many files carry each refusal code (JSON array), most frequent first."""
    codes = F.array_distinct(F.transform(F.from_json(F.col(refusals), "array<struct<code:string>>"), lambda r: r["code"]))
    return files.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("files")).orderBy(F.col("files").desc(), "code")
