"""The life of an exception: found, cleared, found again, outlived by its detector's version.

Exceptions are rows with an outcome; each function returns the rows it changes or opens, so a
writer appends events and readers fold them to the latest. Reasons compare null-safely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspan.operators.current import top_per_group

_SUBJECT = ["parcel_id", "reason"]


def same(a: str, b: str, keys: list[str]) -> Column:
    """Whether the rows aliased ``a`` and ``b`` agree in all keys, null with null."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def _resolved(rows: DataFrame, outcome: str, at: Column, by: str) -> DataFrame:
    return rows.withColumn("outcome", F.lit(outcome)).withColumn("resolved_at", at).withColumn("resolved_by", F.lit(by))


def close_resolved(exceptions: DataFrame, still_true: DataFrame, at: Column, by: str = "reconcile", subject: list[str] | None = None) -> DataFrame:
    """Open exceptions whose condition no longer holds, cleared. Nothing still true clears all."""
    keys = subject or _SUBJECT
    open_ = exceptions.where("outcome = 'open'").alias("e")
    gone = open_.join(still_true.select(*keys).distinct().alias("s"), same("e", "s", keys), "left_anti")
    return _resolved(gone, "condition_cleared", at, by)


def close_for(exceptions: DataFrame, parcels: DataFrame, at: Column, by: str = "reconcile") -> DataFrame:
    """Open exceptions of these entities, cleared."""
    return _resolved(exceptions.where("outcome = 'open'").join(parcels.select("parcel_id").distinct(), "parcel_id", "left_semi"), "condition_cleared", at, by)


def retire_stranded(exceptions: DataFrame, detector: str, version: str, at: Column, by: str = "reconcile") -> DataFrame:
    """Open exceptions of the detector's other versions, which no run will look at again."""
    stranded = (F.col("outcome") == "open") & (F.col("detector_key") == detector) & (F.col("detector_version") != version)
    return _resolved(exceptions.where(stranded), "version_retired", at, by)


def latest_closed(exceptions: DataFrame, subject: list[str], order: list[Column]) -> DataFrame:
    return top_per_group(exceptions, subject, order)


def relink_reopened(open_: DataFrame, closed: DataFrame, order: list[Column], subject: list[str] | None = None, key: str = "id") -> DataFrame:
    """(key, prior): open exceptions with the latest closed one of the same subject; first-ever ones are absent."""
    keys = subject or _SUBJECT
    last = latest_closed(closed, keys, order).select(*keys, F.col(key).alias("prior")).alias("c")
    return open_.alias("o").join(last, same("o", "c", keys)).select(f"o.{key}", "prior")


def not_yet_open(found: DataFrame, exceptions: DataFrame, subject: list[str] | None = None) -> DataFrame:
    """Findings without an open exception of the same subject; of several alike, one."""
    keys = subject or _SUBJECT
    open_ = exceptions.where("outcome = 'open'").select(*keys).distinct().alias("x")
    return found.dropDuplicates(keys).alias("f").join(open_, same("f", "x", keys), "left_anti")


def fold(events: DataFrame, key: str = "id", order: str = "event_at") -> DataFrame:
    """The latest event of each exception is its state."""
    return top_per_group(events, [key], [F.col(order).desc(), F.col("outcome")])
