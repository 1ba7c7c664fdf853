"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of the ring; a key belongs to the next point clockwise. A
shard takes at most ``ceil(n / shards)`` keys (exactly: the first ``n mod shards`` shards one
more than the rest). Keys of its own arcs come first, in ring order; what does not fit goes on
clockwise and is taken, first come first served, by the next shards that have room. So counts
are at most one apart whatever the hash does, and only the overflow of full shards moves.

How it runs: keys are counted per ring slot (a fixed number of slots), the overflow walk is a
fold over the ring's points in one row (its size is ``shards * vnodes``, a parameter, never the
data), and the allocation is joined back as a broadcast table of at most ``slots`` rows. The
one shuffle of documents deals narrow rows by ring slot, which the hash spreads evenly: no
source, text or shard is a shuffle key.

Nulls and ties: a null key is placed by its text's hash, and by a constant if that is null too;
rows that agree on key and text are interchangeable, each is placed. An empty table gives an
empty result. Columns of the input pass through; the added ones carry the names given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspan.llm.common import packed


def _slot(hashed: Column, slots: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - (slots.bit_length() - 1)).cast("int")


def ring(spark, shards: int, vnodes: int, slots: int) -> DataFrame:
    """The points of the ring in order: arc, shard, and the slots (first, last] that end there."""
    points = spark.range(shards * vnodes, numPartitions=1).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        _slot(F.xxhash64(F.col("id") % shards, F.floor(F.col("id") / shards), F.lit("point")), slots).alias("at"),
    )
    order = Window.orderBy("at", "shard")
    return points.select(
        (F.row_number().over(order) - 1).alias("arc"),
        "shard",
        F.lag("at", 1, -1).over(order).alias("after"),
        "at",
        F.max("at").over(Window.partitionBy()).alias("top"),
    )


def slot_arcs(points: DataFrame, slots: int) -> DataFrame:
    """(slot, arc) for each slot of the ring; slots beyond the last point wrap to the first."""
    own = F.when(F.col("at") > F.col("after"), F.sequence(F.col("after") + 1, F.col("at")))
    wrap = F.when((F.col("arc") == 0) & (F.col("top") < slots - 1), F.sequence(F.col("top") + 1, F.lit(slots - 1)))
    none = F.array().cast("array<int>")
    return points.select("arc", F.explode(F.concat(F.coalesce(own, none), F.coalesce(wrap, none))).alias("slot"))


def allocate(points: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """(arc, pieces): which ranks of each arc's keys go to which shard and at what offset there.

    ``loads``: (arc, own), the number of keys on each arc. Everything here has at most
    ``shards * vnodes`` rows, so it stays in one partition on purpose.
    """
    by_shard = Window.partitionBy("shard")
    arcs = (
        points.select("arc", "shard")
        .join(F.broadcast(loads), "arc", "left")
        .select("arc", "shard", F.coalesce("own", F.lit(0)).cast("long").alias("own"))
        .coalesce(1)
        .withColumn("n", F.sum("own").over(Window.partitionBy()))
        .withColumn("cap", F.floor(F.col("n") / shards) + F.when(F.col("shard") < F.col("n") % shards, 1).otherwise(0))
        .withColumn("before", F.sum("own").over(by_shard.orderBy("arc")) - F.col("own"))
        .withColumn("home", F.greatest(F.lit(0).cast("long"), F.least("own", F.col("cap") - F.col("before"))))
        .withColumn("room", F.col("cap") - F.sum("home").over(by_shard))
        .withColumn("over", F.col("own") - F.col("home"))
    )
    one = arcs.agg(
        F.sort_array(F.collect_list(F.struct("arc", "shard", "own", "home", "over"))).alias("arcs"),
        F.sort_array(F.collect_set(F.struct("shard", "room"))).alias("rooms"),
    )
    steps = F.concat(
        F.transform("arcs", lambda a: F.struct(a["shard"].alias("shard"), a["over"].alias("over"))),
        F.transform("arcs", lambda a: F.struct(a["shard"].alias("shard"), F.lit(0).cast("long").alias("over"))),
    )
    start = F.struct(
        F.lit(0).cast("long").alias("carry"),
        F.lit(0).cast("long").alias("done"),
        F.transform("rooms", lambda r: r["room"]).alias("room"),
        F.array().cast("array<struct<lo:bigint,hi:bigint,shard:int>>").alias("took"),
    )

    def walk(state: Column, step: Column) -> Column:
        waiting = state["carry"] + step["over"]
        take = F.least(waiting, F.get(state["room"], step["shard"]))
        taken = F.struct(state["done"].alias("lo"), (state["done"] + take).alias("hi"), step["shard"].alias("shard"))
        return F.when(
            take > 0,
            F.struct(
                (waiting - take).alias("carry"),
                (state["done"] + take).alias("done"),
                F.transform(state["room"], lambda x, i: F.when(i == step["shard"], x - take).otherwise(x)).alias("room"),
                F.concat(state["took"], F.array(taken)).alias("took"),
            ),
        ).otherwise(F.struct(waiting.alias("carry"), state["done"].alias("done"), state["room"].alias("room"), state["took"].alias("took")))

    swept = one.select("arcs", F.aggregate(steps, start, walk)["took"].alias("took"))
    rows = swept.select("took", F.inline("arcs")).withColumn("base", F.sum("over").over(Window.orderBy("arc")) - F.col("over"))
    # ranks of the arc: first those that stay at home, then those that others took
    home = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("home").alias("hi"), F.col("shard").alias("shard")))
    taken = F.transform(
        F.filter("took", lambda t: (t["hi"] > F.col("base")) & (t["lo"] < F.col("base") + F.col("over"))),
        lambda t: F.struct(
            (F.col("home") + F.greatest(t["lo"], F.col("base")) - F.col("base")).alias("lo"),
            (F.col("home") + F.least(t["hi"], F.col("base") + F.col("over")) - F.col("base")).alias("hi"),
            t["shard"].alias("shard"),
        ),
    )
    pieces = rows.select("arc", F.inline(F.concat(home, taken))).where("hi > lo")
    placed = pieces.withColumn("offset", F.sum(F.col("hi") - F.col("lo")).over(Window.partitionBy("shard").orderBy("arc", "lo")) - (F.col("hi") - F.col("lo")))
    return placed.groupBy("arc").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "shard", "offset"))).alias("pieces"))


def ring_shards(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16, vnodes: int = 48, slots: int = 1 << 14,
    shard_col: str = "shard", slot_col: str = "slot",
) -> DataFrame:
    """``docs`` with its shard (0 to shards - 1) and its place there (gapless from 0)."""
    if slots & (slots - 1) or not 1 <= shards * vnodes <= slots:
        raise ValueError("slots is a power of two, at least shards * vnodes")
    spark = docs.sparkSession
    hashed = F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key))).otherwise(F.xxhash64(F.lit("null"), F.col(text)))
    keyed = docs.select(packed(docs).alias("_row"), F.col(key).alias("_key"), F.crc32(F.col(text)).alias("_crc"), hashed.alias("_at")).withColumn("_slot", _slot(F.col("_at"), slots))
    points = ring(spark, shards, vnodes, slots)
    arcs = slot_arcs(points, slots)
    counts = keyed.groupBy("_slot").agg(F.count("*").alias("_n"))
    by_slot = (
        arcs.join(counts, arcs.slot == counts._slot, "left")
        .select("slot", "arc", F.coalesce("_n", F.lit(0)).alias("n"))
        # slots above the last point come before those at the ring's start: both are on arc 0
        .withColumn("_base", F.sum("n").over(Window.partitionBy("arc").orderBy("slot")) - F.col("n"))
    )
    pieces = allocate(points, by_slot.groupBy("arc").agg(F.sum("n").alias("own")), shards)
    plan = by_slot.join(F.broadcast(pieces), "arc").select(F.col("slot").alias("_slot"), "_base", F.col("pieces").alias("_pieces"))
    ranked = keyed.withColumn("_rank", F.row_number().over(Window.partitionBy("_slot").orderBy("_at", "_key", "_crc")) - 1)
    placed = ranked.join(F.broadcast(plan), "_slot").withColumn("_rank", F.col("_rank") + F.col("_base"))
    found = F.get(F.filter("_pieces", lambda p: (p["lo"] <= F.col("_rank")) & (F.col("_rank") < p["hi"])), F.lit(0))
    placed = placed.withColumn("_piece", found)
    return placed.select(
        *[F.col(f"_row.`{c}`") for c in docs.columns if c not in (shard_col, slot_col)],
        F.col("_piece.shard").alias(shard_col),
        (F.col("_piece.offset") + F.col("_rank") - F.col("_piece.lo")).alias(slot_col),
    )


def op6(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The contract's columns; the law that holds is ``rows``."""
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.crc32(F.lit(b""))).alias("text_crc32"),
        F.xxhash64("text").cast("string").alias("_text"),
    )
    out = ring_shards(narrow, text="_text", shards=shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
