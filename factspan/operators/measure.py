"""Measurements: exceptions and their truth, deliveries and their cost, predictions and their outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def ratio(part: Column, whole: Column) -> Column:
    """Four decimals; null if the whole is zero."""
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)), 4)


def outcomes(rows: DataFrame, by: list[Column], confirmed: Column, false_positive: Column, judged: Column) -> DataFrame:
    """Per detector: found, confirmed, false, and the false share of those judged."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("detected"), F.count_if(confirmed).alias("confirmed"), F.count_if(false_positive).alias("false_positive"),
        ratio(F.count_if(false_positive), F.count_if(judged)).alias("fpr"),
    )


def hit_rate(examined: DataFrame, hits: DataFrame, by: str, unit: str) -> DataFrame:
    """The share of examined units with a hit, by group; both inputs hold distinct (by, unit)."""
    marked = hits.select(by, unit, F.lit(1).alias("_hit"))
    return examined.join(marked, [by, unit], "left").groupBy(by).agg(F.count("*").alias("examined"), F.count("_hit").alias("hits"), ratio(F.count("_hit"), F.count("*")).alias("hit_rate"))


def with_support(files: DataFrame, support: DataFrame, key: str, requests: Column, corrections: Column) -> DataFrame:
    """Files with their support counts, aggregated before the join so that files don't multiply."""
    return files.join(support.groupBy(key).agg(requests.alias("requests"), corrections.alias("corrections")), key, "left")


def delivery_rates(files: DataFrame, week: Column, status: str = "status", cost: str = "cost_micros") -> DataFrame:
    """Per week, of files with their support: the shares that were corrected, refused or partial, requests a file, and the mean cost."""
    n = F.count("*")
    share = lambda c, name: ratio(F.count_if(c), n).alias(name)
    return files.groupBy(week.alias("wk")).agg(
        n.alias("files"), ratio(F.coalesce(F.sum("requests"), F.lit(0)), n).alias("support_rate"), share(F.col("corrections") > 0, "correction_rate"),
        share(F.col(status) == "refused", "refusal_rate"), share(F.col(status) == "partial", "partial_rate"), F.round(F.avg(cost), 4).alias("avg_cost_micros"),
    )


def deliveries(files: DataFrame, week: Column, full: Column) -> DataFrame:
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return files.groupBy(week.alias("wk")).agg(F.count("*").alias("files"), F.count_if(full).alias("full_files"), zero("requests").alias("requests"), zero("corrections").alias("corrections"))


def first_within(requests: DataFrame, later: DataFrame, by: str, at: str, request: str, event: str, window: Column) -> DataFrame:
    """(request, event): the first event of the same subject in [at, at + window), null if none.

    Two levels of time: a subject's rows are dealt by hour. Within the hour one pass, latest first,
    has the event last met as the next one in time; where the hour has none, it is the first event
    of the nearest later hour that has any, found in a table with a row for each subject and hour.
    So a subject with a large share of all rows is many groups, and no request meets more than one event.
    """
    if isinstance(requests.schema[at].dataType, NumericType):  # seconds, say
        hour = lambda c: F.floor(c / 3600)
    else:
        hour = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date")) * 24 + F.hour(c)
    both = requests.select(F.col(by).alias("_by"), F.col(at).alias("_at"), F.lit(0).alias("_kind"), F.col(request).alias("_request"), F.lit(None).alias("_event"))
    both = both.unionByName(later.select(F.col(by).alias("_by"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).alias("_request"), F.col(event).alias("_event")))
    both = both.where(F.col("_by").isNotNull() & F.col("_at").isNotNull()).withColumn("_hour", hour(F.col("_at")))
    met = F.when(F.col("_kind") == 1, F.struct("_at", "_event"))
    backward = Window.partitionBy("_by", "_hour").orderBy(F.col("_at").desc(), F.col("_kind").desc(), F.col("_event").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = both.withColumn("_next", F.last(met, ignorenulls=True).over(backward)).where("_kind = 0")
    hours = both.groupBy("_by", "_hour").agg(F.min(met).alias("_first"))
    after = Window.partitionBy("_by").orderBy(F.col("_hour").desc()).rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select("_by", "_hour", F.last("_first", ignorenulls=True).over(after).alias("_later"))
    found = own.join(hours, ["_by", "_hour"]).withColumn("_next", F.coalesce("_next", "_later"))
    told = found.select(F.col("_request").alias(request), F.when(F.col("_next._at") < F.col("_at") + window, F.col("_next._event")).alias(event))
    # a request without subject or time meets nothing
    return told.unionByName(requests.where(F.col(by).isNull() | F.col(at).isNull()).select(F.col(request).alias(request), F.lit(None).cast(later.schema[event].dataType).alias(event)))


def captured(rows: DataFrame, plan: str, customer: str, amount: Column) -> DataFrame:
    """Distinct customers and captured minor units by plan."""
    return rows.groupBy(F.col(plan).alias("plan")).agg(F.count_distinct(customer).alias("cust"), F.sum(amount).cast("long").alias("minor"))
