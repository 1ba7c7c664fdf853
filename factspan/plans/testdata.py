"""The given tables seen as a ledger's inputs; each view names what stands for what."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger(events: DataFrame) -> DataFrame:
    """Events as bitemporal facts: an event supersedes the one before of its user, type and source."""
    e = F.col("event_id")
    source = F.concat(F.lit("s"), (e % 3).cast("string"))
    day = lambda n: F.expr(f"interval '{n}' day")
    return events.select(
        e.alias("fact_id"), F.col("user_id").alias("entity_id"), F.col("event_type").alias("field_key"), source.alias("source_id"), "value",
        (e % 2 + 1).cast("int").alias("conf_ord"),
        F.when(e % 4 != 0, F.col("ts")).alias("retrieved_at"),
        F.when(e % 7 == 0, F.col("ts") + day(10)).otherwise(F.col("ts") - day(1)).alias("effective_from"),
        F.when(e % 7 == 0, F.col("ts") + day(16)).when(e % 9 == 0, F.col("ts") + day(5)).alias("effective_to"),
        F.col("ts").alias("recorded_at"),
        F.lead("ts").over(Window.partitionBy("user_id", "event_type", source).orderBy("ts", "event_id")).alias("superseded_at"),
    )


def source_ranks(spark: SparkSession) -> DataFrame:
    """A registry of known size, so that its join is planned as a broadcast from the start."""
    return spark.sql("select * from values ('s0', 'click', 2), ('s1', 'click', 1), ('s2', 'view', 1) as r(source_id, field_key, rank)")


def exceptions(events: DataFrame) -> DataFrame:
    """Events as exceptions of a user (parcel) and a type (reason), open where the value is high."""
    return events.select(F.col("event_id").alias("id"), F.col("user_id").alias("parcel_id"), F.col("event_type").alias("reason"), "ts", "value", F.when(F.col("value") > 300, "open").otherwise("confirmed").alias("outcome"))


def rules(orders: DataFrame) -> DataFrame:
    """Orders as versions of a customer's rule, each in effect until the next."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return orders.select(F.col("o_custkey").alias("rk"), F.col("o_orderkey").alias("id"), F.row_number().over(w).cast("long").alias("version"), F.col("o_orderdate").alias("effective_from"), F.lead("o_orderdate").over(w).alias("effective_to"))


def squares(supplier: DataFrame) -> DataFrame:
    """Suppliers as square polygons of side 12 with a zone, some without one."""
    k = F.col("s_suppkey")
    x, y = (k * 7 % 90).cast("double"), (k * 13 % 90).cast("double")
    p = lambda dx, dy: F.array(x + dx, y + dy)
    ring = F.array(p(0, 0), p(12, 0), p(12, 12), p(0, 12), p(0, 0))
    return supplier.select(k.alias("zid"), F.when(k % 9 != 0, F.concat(F.lit("Z"), (k % 4).cast("string"))).alias("zoning"), F.array(F.array(ring)).alias("geom"))


def places(customer: DataFrame) -> DataFrame:
    """Customers as points."""
    k = F.col("c_custkey")
    return customer.select(k.alias("pid"), (k * 31 % 1000 / 10.0 + 0.05).alias("x"), (k * 17 % 1000 / 10.0 + 0.05).alias("y"))
