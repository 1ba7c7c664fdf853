"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but ASCII white space, the word that every size and shingle counts.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that a helper column can't clash with a name of the input."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def cut(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there.

    The folder is the one named in ``spark.checkpoint.dir``, which a cluster shares between
    executors. A local session without that setting, as in tests, gets a temporary one; a cluster's is refused.
    ``narrow``: rows are short, so each core writes a few files instead of one for each shuffle partition.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-"))
    return (df.coalesce(4 * context.defaultParallelism) if narrow else df).checkpoint()


def numbered(df: DataFrame) -> DataFrame:
    """(id, row): every row of ``df`` as one struct, with a number of its own that is written before anything is decided."""
    return cut(df.select(F.monotonically_increasing_id().alias("id"), packed(df).alias("row")))


def parts(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in slices of ``rows``, so that its texts become Python objects a few at a time."""
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(src, dst)``; component: its smallest node.

    Alternates large-star and small-star steps: each links the neighbours of a node to the
    smallest of them, so rounds grow with the logarithm of the component's size and no group is
    ever collected: every step is a minimum over (node) or a distinct. Node ids are non-null
    longs. It ends when every node has one edge and no edge leads on from its end: then all lead
    to the smallest node. Each round is checkpointed, so a lost executor costs one round, and
    only a yes or no per round comes to the driver.
    """
    e = cut(edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).where("a <> b").distinct(), narrow=True)
    for _ in range(max_rounds):
        ends = e.select("a", F.lit(1).alias("down"), F.lit(0).alias("up")).union(e.select("b", F.lit(0), F.lit(1)))
        if ends.groupBy("a").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 and down > 0").isEmpty():
            break
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: neighbours above the node go to the smallest of the node and its neighbours
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: neighbours below the node, and the node, go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("x"))
        e = cut(small.select("x.a", "x.b").where("a <> b").distinct(), narrow=True)
    else:
        raise RuntimeError("components did not settle")
    # a star forest now: every edge leads to the root
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def crc32_sql(number: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a number's decimal digits: two table steps of four bits for each byte."""
    table, c = [], lambda y: f"xor(({y}) >> 4, tbl[(({y}) & 15) + 1])"
    for k in range(16):
        for _ in range(4):
            k = (k >> 1) ^ (0xEDB88320 if k & 1 else 0)
        table.append(k)
    step = c(c("xor(c, b)")).replace("tbl", f"cast({table} as bigint[])")
    return f"xor(list_reduce(list_transform(string_split(cast({number} as varchar), ''), lambda x: cast(ord(x) as bigint)), lambda c, b: {step}, cast(4294967295 as bigint)), 4294967295)"
