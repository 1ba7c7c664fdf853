"""Differences of JSON documents by path: what was added, removed or changed, and what moved within a list.

Documents are taken apart over VARIANT, a level at a time, all documents at once: a round opens
every object and array that is left, so there are as many rounds as the deepest document has
levels. A leaf is a scalar, or an object or array without members. Two documents of a key are
compared leaf by leaf at the same path; a scalar of a list that is gone at one place and new at
another of the same list has moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factspan.sources.tables import cut


def leaves(documents: DataFrame, key: str, document: str) -> DataFrame:
    """(key, path, list, value): every leaf of JSON documents; ``list`` is the path of the array that it is an element of."""
    front = documents.select(F.col(key).alias("_key"), F.lit("$").alias("path"), F.lit(None).cast("string").alias("list"), F.parse_json(F.col(document)).alias("v"))
    out = None
    while True:
        as_map, as_list = F.try_variant_get("v", "$", "map<string,variant>"), F.try_variant_get("v", "$", "array<variant>")
        kind = F.schema_of_variant("v")
        front = cut(front.where("v is not null").select("*", F.when(kind.startswith("OBJECT"), as_map).alias("m"), F.when(kind.startswith("ARRAY"), as_list).alias("a")))
        open_ = (F.coalesce(F.size("m"), F.lit(0)) > 0) | (F.coalesce(F.size("a"), F.lit(0)) > 0)
        done = front.where(~open_).select(F.col("_key").alias(key), "path", "list", F.to_json("v").alias("value"))
        out = done if out is None else out.unionByName(done)
        inner = front.where(open_)
        if inner.isEmpty():
            return out
        # a key is written as JSON writes it, so that no two paths look the same
        of_map = inner.where("m is not null").select("_key", "path", F.explode("m").alias("k", "v")).select("_key", F.concat("path", F.lit("."), F.to_json(F.struct("k"))).alias("path"), F.lit(None).cast("string").alias("list"), "v")
        of_list = inner.where("a is not null").select("_key", F.col("path").alias("list"), F.posexplode("a").alias("i", "v")).select("_key", F.concat("list", F.lit("["), F.col("i").cast("string"), F.lit("]")).alias("path"), "list", "v")
        front = of_map.withColumn("path", F.regexp_replace("path", r'\{"k":("(?:[^"\\]|\\.)*")\}$', "$1")).unionByName(of_list)


def differences(before: DataFrame, after: DataFrame, key: str, document: str) -> DataFrame:
    """(key, path, kind, was, now, moved_to): added, removed, changed and moved leaves; none where the documents agree."""
    a, b = (leaves(d, key, document).withColumnRenamed("value", v) for d, v in ((before, "was"), (after, "now")))
    both = a.withColumnRenamed("list", "_la").join(b.withColumnRenamed("list", "_lb"), [key, "path"], "full").where(~F.col("was").eqNullSafe(F.col("now")))
    both = cut(both.withColumn("list", F.coalesce("_la", "_lb")))
    # the n-th place where a list lost a value and the n-th where it won it are one move
    nth = lambda v: F.row_number().over(Window.partitionBy(key, "list", v).orderBy(F.length("path"), "path"))
    lost = both.where("list is not null and was is not null").select(key, "list", F.col("was").alias("value"), F.col("path").alias("_from"), nth("was").alias("n"))
    won = both.where("list is not null and now is not null").select(key, "list", F.col("now").alias("value"), F.col("path").alias("_to"), nth("now").alias("n"))
    moves = cut(lost.join(won, [key, "list", "value", "n"]))
    came, went = moves.select(key, F.col("_to").alias("path"), F.lit(True).alias("came")), moves.select(key, F.col("_from").alias("path"), F.col("_to").alias("moved_to"))
    rest = both.join(came, [key, "path"], "left").join(went, [key, "path"], "left")
    was, now = F.when(F.col("moved_to").isNull(), F.col("was")), F.when(F.col("came").isNull(), F.col("now"))
    kind = F.when(was.isNull(), "added").when(now.isNull(), "removed").otherwise("changed")
    plain = rest.where(was.isNotNull() | now.isNotNull()).select(key, "path", kind.alias("kind"), was.alias("was"), now.alias("now"), F.lit(None).cast("string").alias("moved_to"))
    return plain.unionByName(rest.where("moved_to is not null").select(key, "path", F.lit("moved").alias("kind"), "was", F.lit(None).cast("string").alias("now"), "moved_to"))
