"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: sources weigh ``weights`` in turn and share all words; no target passes ``most``
   times its source's words, the excess is shared again by weight (solved in closed form).
2. Each source is a stream of its documents in permuted order (by a hash), ``most`` times over, cut
   into blocks of one size in words; its quota is as many blocks as make up its target, about
   ``blocks`` in all, so there are more blocks in the stream than the quota takes (as many only
   where the target is the ceiling). A document comes up once each time the stream starts over, so
   none exceeds ``most`` times its size.
3. A tree over the output shards splits the quotas: at each node the left half's part is a uniform
   draw without replacement from the node's, so the counts by source follow the multivariate
   hypergeometric law and every quota is met exactly.
4. The source's blocks are permuted and dealt into a deck for each shard, as large as the shard's
   quota asks for; the shard draws its quota from its own deck in an order of its own. So decks
   are disjoint, and which blocks are drawn at all follows from the tree.
5. A copy of a document is taken if some shard drew the block in which its middle word lies. What
   whole documents then leave over or under is made up in permuted order, copy by copy, and in the
   end one copy of the document of the best-fitting size comes in or goes out.
6. Every copy has a ``mix_order`` of its own, by which each partition is sorted: the local
   shuffle. ``write_mix`` deals the copies by shard before, a shard in ``pieces`` random pieces.

What is large: texts are read once, for their sizes; one shuffle of narrow rows by (source, hash
bucket), where a source with a third of all rows still spreads over ``buckets`` groups. Stream
offsets are two-level sums: per bucket, then within the bucket. Buckets go by key and text, so
documents that share a key, or have none, are spread by their texts. What the best fit needs is summed
by (source, copies, size). The tables of sources, buckets and blocks grow with the sources only (a
block for each at least; about ``most * blocks`` in all otherwise): the tree's units are one task's.
They are written once each, so no plan carries the tree along.

Nulls and ties: a null text has 0 words; a null source is a source of its own, last in order;
documents of a source without any words are taken once. Rows with equal hash are ordered by key,
size and row number; repeated rows are documents of their own, long texts are never cut. An empty
table gives an empty result. Same input, same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspan.llm.common import WORD, cut, numbered


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``sources(_src, source_size)`` with ``target``. One row per source, ordered by code point."""
    turn = F.array(*[F.lit(w) for w in weights])
    s = sources.withColumn("w", F.get(turn, (F.row_number().over(Window.orderBy("_src")) - 1) % len(weights)).cast("long"))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("source_size") / F.col("w"), "_src").rowsBetween(Window.unboundedPreceding, -1)
    s = (
        s.withColumn("all", F.sum("source_size").over(everything))
        .withColumn("left", F.col("all") - F.coalesce(F.sum(F.col("source_size") * most).over(filled), F.lit(0)))
        .withColumn("open", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(filled), F.lit(0)))
        # in this order, sources reach their ceiling one after the other until one does not
        .withColumn("share", F.col("left") * F.col("w") / F.col("open"))
        .withColumn("full", F.col("share") >= F.col("source_size") * most)
    )
    level = F.min(F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("w"), F.col("_src"), F.col("left"), F.col("open")))).over(everything)
    s = s.withColumn("level", level)
    return s.select("_src", "source_size", F.when(F.col("full") | F.col("level").isNull(), (F.col("source_size") * most).cast("double")).otherwise(F.col("level.left") * F.col("w") / F.col("level.open")).alias("target"))


def split_tree(units: DataFrame, shards: int, seed: int) -> DataFrame:
    """``units(_src, block)``, a row for each block of a source's quota, with the shard that it falls to."""
    tree = units.coalesce(1).select("_src", "block", F.lit(0).alias("lo"), F.lit(shards).alias("hi"))
    for depth in range(max(1, (shards - 1).bit_length())):
        node = Window.partitionBy("lo", "hi")
        drawn = F.row_number().over(node.orderBy(F.xxhash64("_src", "block", F.lit(seed), F.lit(depth)), "_src", "block"))
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        quota = F.round(F.count("*").over(node) * (middle - F.col("lo")) / (F.col("hi") - F.col("lo")))
        tree = (
            tree.withColumn("mid", middle)
            .withColumn("left", (drawn <= quota) & (F.col("hi") - F.col("lo") > 1))
            .select(
                "_src", "block",
                F.when(F.col("left") | (F.col("hi") - F.col("lo") == 1), F.col("lo")).otherwise(F.col("mid")).alias("lo"),
                F.when(F.col("left"), F.col("mid")).otherwise(F.col("hi")).alias("hi"),
            )
        )
    return tree.select("_src", "block", F.col("lo").alias("shard"))


def quotas(sources: DataFrame, blocks: int, most: int = 3) -> DataFrame:
    """``targets``'s rows with ``quota`` (how many blocks make up the target), ``block_words`` (the size of each) and ``n_blocks`` (how many the stream has)."""
    per = F.greatest(F.lit(1.0), F.sum("target").over(Window.partitionBy()) / blocks)
    quota = F.when(F.col("target") > 0, F.greatest(F.lit(1), F.round(F.col("target") / per).cast("int"))).otherwise(0)
    out = sources.withColumn("quota", quota).withColumn("block_words", F.when(F.col("quota") > 0, F.col("target") / F.col("quota")).otherwise(1.0))
    whole = F.ceil(F.col("source_size") * most / F.col("block_words") - 1e-6).cast("int")
    return out.withColumn("n_blocks", F.when(F.col("quota") > 0, F.greatest("quota", whole)).otherwise(0))


def draw(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """``quotas``'s rows with ``_shards``: for each block of the source's stream the shard that draws it, null if none does."""
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    some = sources.where("quota > 0")
    part = split_tree(some.select("_src", upto("quota").alias("block")), shards, seed).groupBy("_src", "shard").agg(F.count("*").cast("int").alias("q"))
    before = Window.partitionBy("_src").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    decks = cut(part.withColumn("upto", F.sum("q").over(before)), narrow=True)
    decks = decks.groupBy("_src").agg(F.sort_array(F.collect_list(F.struct("upto", "shard", "q"))).alias("decks"))
    permuted = F.row_number().over(Window.partitionBy("_src").orderBy(F.xxhash64("_src", "block", F.lit(seed), F.lit("deck")), "block")) - 1
    dealt = some.select("_src", "quota", "n_blocks", upto("n_blocks").alias("block")).withColumn("at", permuted).join(decks, "_src")
    deck = F.get(F.filter("decks", lambda d: F.col("at") < F.floor(F.col("n_blocks") * d["upto"] / F.col("quota"))), F.lit(0))
    dealt = dealt.select("_src", "block", deck.alias("deck"))
    own = Window.partitionBy("_src", "deck.shard").orderBy(F.xxhash64("_src", "block", F.lit(seed), "deck.shard", F.lit("draw")), "block")
    drawn = dealt.select("_src", "block", F.when(F.row_number().over(own) <= F.col("deck.q"), F.col("deck.shard")).alias("shard"))
    drawn = drawn.groupBy("_src").agg(F.transform(F.sort_array(F.collect_list(F.struct("block", "shard"))), lambda x: x["shard"]).alias("_shards"))
    return sources.join(drawn, "_src", "left").withColumn("_shards", F.coalesce("_shards", F.array().cast("array<int>")))


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3, shards: int = 16, blocks: int = 4096, buckets: int = 4096, seed: int = 42, uid: str | None = None,
) -> DataFrame:
    """One row per document: key, size, source_size, target, copies, taken, draws (shard and mix_order of each copy).

    ``uid`` is a column that numbers the rows, returned beside the others; without it rows are numbered here.
    """
    number = F.col(uid) if uid else F.monotonically_increasing_id()
    sized = docs.select(number.alias("_uid"), F.col(key).alias("_key"), F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("~")).alias("_src"), words(F.col(text)).alias("size"), F.xxhash64(F.col(key), F.xxhash64(F.col(text)), F.lit(seed)).alias("_at")).withColumn("_bucket", F.pmod("_at", F.lit(buckets)).cast("int"))
    sized = cut(sized, narrow=True)  # texts are read once; ids of rows stay as they are from here on
    cell = ["_src", "_bucket"]
    sums = cut(sized.groupBy(*cell).agg(F.sum("size").alias("words")), narrow=True)
    sources = targets(sums.groupBy("_src").agg(F.sum("words").alias("source_size")), weights, most)
    sources = cut(draw(cut(quotas(sources, blocks, most), narrow=True), shards, seed), narrow=True)
    # all that a document needs to know of its source comes with its cell, (source, bucket): the
    # documents are dealt by cell once, and a source with a third of them is never one group
    each = F.array(*[F.lit(e) for e in range(most)])
    block = lambda e, at: F.floor((e * F.col("source_size") + at) / F.col("block_words")).cast("int")
    first = lambda e: block(e, F.col("_base"))
    cells = (
        sums.withColumn("_base", F.sum("words").over(Window.partitionBy("_src").orderBy("_bucket")) - F.col("words"))
        .join(sources, "_src")
        .select(*cell, "_base", "source_size", "target", "block_words", F.transform(each, lambda e: F.slice("_shards", first(e) + 1, block(e, F.col("_base") + F.col("words")) - first(e) + 1)).alias("_drawn"))
    )
    inner = Window.partitionBy(*cell).orderBy("_at", "_key", "size", "_uid").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_in", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(cells, cell)
    middle = F.col("_base") + F.col("_in") + F.col("size") / 2
    copies = F.transform(each, lambda e: F.struct(e.alias("e"), F.get(F.get("_drawn", e), block(e, middle) - first(e)).alias("shard")))
    spare = F.struct(F.lit(0).alias("e"), F.pmod("_at", F.lit(shards)).cast("int").alias("shard"))
    copies = F.when(F.col("source_size") > 0, F.filter(copies, lambda c: c["shard"].isNotNull())).otherwise(F.array(spare))
    placed = cut(placed.select("_uid", "_key", *cell, "_at", "size", "source_size", "target", copies.alias("_copies")), narrow=True)
    n, sign = F.size("_copies"), F.col("_by")
    # what whole documents left over or under, as copies of as many documents as make it up, by cell and then within it
    off = F.first("target").over(Window.partitionBy("_src")) - F.sum("words").over(Window.partitionBy("_src"))
    room = F.when(sign > 0, F.col("more")).otherwise(F.col("words"))
    short = placed.groupBy(*cell).agg(F.first("target").alias("target"), F.sum(n * F.col("size")).alias("words"), F.sum((most - n) * F.col("size")).alias("more")).withColumn("off", off).withColumn("_by", F.signum("off").cast("int"))
    short = short.select(*cell, "_by", (F.abs("off") - (F.sum(room).over(Window.partitionBy("_src").orderBy("_bucket")) - room)).alias("_left"))
    may = F.when(sign > 0, most - n).otherwise(n)
    placed = placed.join(short, cell).withColumn("_may", may)
    fit = F.floor((F.col("_left") - F.coalesce(F.sum(F.col("_may") * F.col("size")).over(inner), F.lit(0))) / F.col("size"))
    flips = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least("_may", fit)).cast("int")).otherwise(0)
    added = F.transform(F.array_repeat(F.lit(0), F.col("_flips")), lambda x, k: F.struct((F.lit(100) + k).alias("e"), F.pmod(F.col("_at") + k, F.lit(shards)).cast("int").alias("shard")))
    flipped = F.when(sign > 0, F.concat("_copies", added)).otherwise(F.slice("_copies", F.lit(1), F.greatest(F.lit(0), n - F.col("_flips"))))
    placed = cut(placed.withColumn("_flips", flips).withColumn("_copies", flipped).drop("_by", "_left", "_may", "_flips"), narrow=True)
    # and the document that fits best what is left of it
    alike = placed.groupBy("_src", F.size("_copies").alias("n"), "size").agg(F.first("target").alias("target"), F.count("*").alias("rows"), F.min(F.struct("_at", "_key", "_uid")).alias("who"))
    off = alike.groupBy("_src").agg((F.first("target") - F.sum(F.col("size") * F.col("n") * F.col("rows"))).alias("off"))
    fits = F.when(F.col("off") > 0, F.col("n") < most).otherwise(F.col("n") > 0) & (F.col("size") > 0) & (F.col("size") < 2 * F.abs("off"))
    best = alike.join(off, "_src").where(fits).groupBy("_src").agg(F.min(F.struct(F.abs(F.col("size") - F.abs("off")).alias("gap"), "who", F.signum("off").cast("int").alias("by"))).alias("b"))
    best = cut(best.select(F.col("b.who._uid").alias("_uid"), F.col("b.by").alias("_by")), narrow=True)
    # numbers of copies: 0 on for the stream's passes, then those added
    more = F.concat("_copies", F.array(F.struct(F.lit(200).alias("e"), spare["shard"].alias("shard"))))
    less = F.slice("_copies", F.lit(1), F.greatest(F.lit(0), F.size("_copies") - 1))
    placed = placed.join(best, "_uid", "left").withColumn("_copies", F.when(F.col("_by") > 0, more).when(F.col("_by") < 0, less).otherwise(F.col("_copies")))
    return placed.select(
        *([F.col("_uid").alias(uid)] if uid else []), F.col("_key").alias(key), "size", "source_size", "target",
        F.size("_copies").alias("copies"),
        (F.size("_copies") * F.col("size")).cast("long").alias("taken"),
        F.transform("_copies", lambda c: F.struct(c["shard"].alias("shard"), F.xxhash64("_at", "_uid", c["e"]).alias("mix_order"))).alias("draws"),
    )


def op4(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", F.col("draws.shard").alias("shards"))


def mixed_rows(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """(row, shard, mix_order): each row as often as the mix takes it."""
    rows = numbered(docs)
    narrow = rows.select("id", *[F.col("row").getField(c).alias(f"_{n}") for n, c in (("key", key), ("source", source), ("text", text))])
    draws = mix(narrow, key="_key", source="_source", text="_text", uid="id", **options).where("copies > 0").select("id", "draws")
    return rows.join(draws, "id").select("row", F.inline("draws"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as shards drew it, none for what no shard drew; in mixed order within a partition."""
    return mixed_rows(docs, **options).sortWithinPartitions("mix_order").select("row.*")


def write_mix(docs: DataFrame, path: str, pieces: int = 16, **options) -> None:
    """The mix as Parquet, a folder for each shard; each of a shard's ``pieces`` random pieces is written in mixed order."""
    rows = mixed_rows(docs, **options).repartition("shard", F.pmod("mix_order", F.lit(pieces))).sortWithinPartitions("shard", "mix_order")
    rows.select(F.col("shard").alias("_shard"), *[F.col(f"row.`{c}`") for c in docs.columns]).write.partitionBy("_shard").parquet(path)
