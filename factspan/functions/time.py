"""Half-open intervals on two time axes, and the dates that sources write."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def during(at: Column, start: Column, end: Column) -> Column:
    """start <= at < end, where a null end is open."""
    return (start <= at) & (end.isNull() | (end > at))


def visible(at: Column, prefix: str = "") -> Column:
    """Recorded and not yet superseded at ``at``, and in effect then."""
    c = lambda name: F.col(prefix + name)
    return during(at, c("recorded_at"), c("superseded_at")) & during(at, c("effective_from"), c("effective_to"))


def issue_date(c: Column) -> Column:
    """Dates as M/d/yyyy h:mm:ss AM; a value that isn't one fails the query, as a load must."""
    return F.to_timestamp(c, "M/d/yyyy h:mm:ss a").cast("date")


def week(c: Column) -> Column:
    """Monday of the week, without a time zone."""
    return F.date_trunc("week", c).cast("timestamp_ntz")


def stale(as_of: Column, retrieved_at: Column, after_days: Column) -> Column:
    """Older than its field allows; a field without a limit never is."""
    return F.coalesce(F.datediff(as_of, retrieved_at) > after_days, F.lit(False))
