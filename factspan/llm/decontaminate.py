"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is a mask over a few consecutive tokens that looks at some positions and ignores
the others, so a passage still hits when the substituted tokens fall on ignored positions. Every
position of every document and of every benchmark item is hashed under each mask; equal hashes
are hits. A hit fixes the alignment of document and item (the difference of the two positions),
and the whole item is then compared token by token along it: an overlap counts when some stretch
of ``stretch`` tokens (the whole item, if it is shorter) agrees in at least ``agree`` of its tokens.

The masks lose nothing at the default ``agree``: whatever fifth of a stretch of 10 to 20 tokens
is substituted, one of the three ``MASKS`` finds all its looked-at tokens intact somewhere in it
(a test goes through every pattern), and ``SHORT_MASKS`` do the same for one substitution in 5 to
9 tokens. So the result is what comparing every item at every position would give.

How it runs, all in DataFrame functions: a document becomes an array of token hashes; its
positions are exploded, and each mask's hash is an ordinary compiled column of (array, position).
It meets the benchmark's seeds inside the same stage, so only hits leave it, each with the few
tokens that verification needs. The benchmark's seeds are broadcast only while their counted
number is within ``broadcast_seeds``; beyond it the token arrays are written once, only (row,
position, seed) is shuffled, and hits find their texts again by row.

Tokens are maximal runs of letters and digits, lower-cased. Items that differ in no token are
searched once and reported together. Items of fewer than ``least`` tokens say nothing (a word or two
stands in most texts) and are not searched; ``unsearched`` lists them, and with a smaller ``least``
they are searched too, those of under 5 tokens by all their positions. An ``agree`` under 0.8 is
refused. Null
or empty texts match nothing; a null item id is reported as null. Repeated rows each count. Long
texts are exploded like others, and none is cut. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspan.llm.common import cut, numbered

#: The positions that each mask looks at. For items of 10 tokens and more, and for shorter ones.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 4, 6, 7))
SHORT_MASKS = ((0, 1, 2), (0, 1, 3))
#: Items of fewer tokens are searched under ``SHORT_MASKS``; those of fewer than ``WHOLE`` by all positions.
LONG, WHOLE = 10, 5


def tokens(text: Column) -> Column:
    """Hashes of the tokens of a text, in order."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def items(benchmark: DataFrame, item: str = "item_id", text: str = "text", least: int = 5) -> DataFrame:
    """Distinct token arrays of the benchmark, with the ids that share them."""
    t = benchmark.select(F.col(item).alias("_item"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("_ih")).where(F.size("_ih") >= max(1, least))
    return t.groupBy("_ih").agg(F.sort_array(F.collect_set("_item")).alias("_items")).withColumn("_id", F.xxhash64("_ih"))


def unsearched(benchmark: DataFrame, item: str = "item_id", text: str = "text", least: int = 5) -> DataFrame:
    """(item, n_tokens) of the items that have too few tokens to be searched."""
    return benchmark.select(item, F.size(tokens(F.coalesce(F.col(text), F.lit("")))).alias("n_tokens")).where(F.col("n_tokens") < max(1, least))


def _masks(sizes: list[int]) -> list[tuple[int, tuple[int, ...], int, int]]:
    """(tag, positions, least and most tokens of the items that are searched under it) for the lengths that occur."""
    plans = [(t, m, LONG, 1 << 30) for t, m in enumerate(MASKS)] if any(n >= LONG for n in sizes) else []
    if any(WHOLE <= n < LONG for n in sizes):
        plans += [(10 + t, m, WHOLE, LONG - 1) for t, m in enumerate(SHORT_MASKS)]
    return plans + [(20 + n, tuple(range(n)), n, n) for n in sorted(sizes) if n < WHOLE]


def _seeds(rows: DataFrame, h: str, plans: list, kept: list[str], by_length: bool = False) -> DataFrame:
    """``kept``'s columns, _pos and _seed for every position and mask that fits; ``by_length``: only masks meant for that many tokens."""
    n, k = F.size(h), len(plans)
    spots = rows.select(*kept, *([h] if h not in kept else []), F.explode(F.when(n > 0, F.sequence(F.lit(0), n * k - 1))).alias("_at"))
    spots = spots.withColumn("_pos", F.floor(F.col("_at") / k).cast("int")).withColumn("_mask", F.col("_at") % k)
    seed = F.lit(None).cast("long")
    for i, (tag, positions, least, most) in reversed(list(enumerate(plans))):
        fits = F.col("_pos") + positions[-1] < n
        if by_length:
            fits = fits & n.between(least, most)
        looked = F.xxhash64(F.lit(tag), *[F.get(h, F.col("_pos") + p if p else F.col("_pos")) for p in positions])
        seed = F.when(F.col("_mask") == i, F.when(fits, looked)).otherwise(seed)
    return spots.select(*kept, "_pos", seed.alias("_seed")).where("_seed is not null")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    stretch: int = 20, agree: float = 0.8, least: int = 5, broadcast_seeds: int = 2_000_000,
) -> DataFrame:
    """One row per document that overlaps an item: key, items, n_items, best (share of the item's tokens that agree)."""
    if agree < 0.8:
        raise ValueError("the masks find every overlap of 0.8, not of less")
    found = items(benchmark, item, item_text, least)
    facts = found.agg(F.sum(F.size("_ih")), F.collect_set(F.least(F.size("_ih"), F.lit(LONG)))).first()  # ten lengths at most
    plans = _masks(facts[1] or []) or [(0, MASKS[0], LONG, 1 << 30)]
    few = (facts[0] or 0) * len(plans) <= broadcast_seeds

    seeds = _seeds(found.withColumn("_len", F.size("_ih")), "_ih", plans, ["_id", "_len"], by_length=True).withColumnRenamed("_pos", "_ip")
    d = docs.select(F.col(key).alias("_key"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("_h")).withColumn("_row", F.monotonically_increasing_id())
    start = (F.col("_pos") - F.col("_ip")).alias("_start")
    part = F.slice("_h", F.greatest(F.lit(0), F.col("_start")) + 1, F.col("_len") + F.least(F.lit(0), F.col("_start"))).alias("_part")
    if few:
        hits = _seeds(d, "_h", plans, ["_row", "_key", "_h"]).join(F.broadcast(seeds), "_seed").select("_row", "_key", "_h", "_id", "_len", start).select("_row", "_key", "_id", "_start", part)
        hits = hits.groupBy("_row", "_id", "_start").agg(F.first("_key").alias("_key"), F.first("_part").alias("_part"))
    else:
        d = cut(d)
        near = _seeds(d, "_h", plans, ["_row"]).join(seeds, "_seed").select("_row", "_id", "_len", start).distinct()
        hits = near.join(d, "_row").select("_row", "_key", "_id", "_start", part)
    same = F.transform("_ih", lambda x, k: F.when(F.get("_part", k + F.least(F.lit(0), F.col("_start"))) == x, 1).otherwise(0))
    width = F.least(F.lit(stretch), F.size("_ih"))
    runs = F.transform(F.sequence(F.lit(1), F.size("_same") - width + 1), lambda k: F.aggregate(F.slice("_same", k, width), F.lit(0), lambda a, x: a + x))
    checked = (
        hits.join(F.broadcast(found) if few else found, "_id")
        .withColumn("_same", same)
        .where(F.array_max(runs) >= agree * width)
        .withColumn("_share", F.aggregate("_same", F.lit(0), lambda a, x: a + x) / F.size("_same"))
    )
    return (
        checked.groupBy("_row")
        .agg(F.first("_key").alias(key), F.sort_array(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("items"), F.max("_share").alias("best"))
        .select(key, "items", F.size("items").alias("n_items"), "best")
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that overlap an item; other rows of the same key stay."""
    rows = numbered(docs)
    texts = rows.select("id", F.col("row").getField(text).alias("text"))
    return rows.join(contaminated(texts, benchmark, key="id", text="text", **options).select("id"), "id", "left_anti").select("row.*")


def op9(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark)


#: Without seeds: every item at every place of every text, by counting equal tokens along each alignment.
ORACLE = r"""
with d as (select row_number() over () rid, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') h from documents),
b as (select h, len(h) n, least(20, len(h)) w, list_sort(list(distinct item_id)) as items, row_number() over () bid
 from (select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') h from benchmark) where len(h) >= 5 group by h),
dt as (select rid, unnest(h) t, unnest(range(len(h))) i from d),
bt as (select bid, n, w, items, unnest(h) t, unnest(range(n)) j from b),
line as (select rid, bid, i - j s, any_value(n) n, any_value(w) w, any_value(items) items, list(j) js from dt join bt using (t) group by rid, bid, i - j having count(*) >= 0.8 * any_value(w)),
ok as (select *, len(js) / n as share from line
 where list_max(list_transform(range(0, n - w + 1), lambda k: len(list_filter(js, lambda j: j >= k and j < k + w)))) >= 0.8 * w)
select doc_id, list_sort(list_distinct(flatten(list(items)))) as items, cast(len(list_distinct(flatten(list(items)))) as int) n_items, max(share) best from ok join d using (rid) group by rid, doc_id
"""
