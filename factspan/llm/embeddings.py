"""Embedding near-duplicates: an exact metric range join over blocks of pivot cells.

Cosine >= ``cos`` between vectors is Euclidean distance <= r = sqrt(2 - 2 cos) between their unit
vectors. Each unit vector lives in the cell of its nearest pivot, and nowhere else. Cells are split
again by pivots of their own until they hold ``SPREAD`` blocks of ``BLOCK`` members at most, so the
number of pivots grows with the vectors; a cell that its pivots can't split (many vectors of one
direction), one so narrow that all its members link, or one still full after ``levels`` stays.

Each cell is packed into blocks, one row each, with a middle and the range of its members' distances
to it. By the triangle inequality two blocks can hold links only if their middles are at most r
farther apart than both reach, and a vector can have partners in a block only if its distance to the
block's middle lies within r of the block's range. Blocks that may meet do so once, as a cartesian
product of partitions of blocks: blocks are read again for it, but never copied, so disk grows as
the vectors do, whatever they are. A task's memory is a partition of ``TOGETHER`` blocks in the JVM and
a batch of pairs in Python. Blocks hold fewer members where vectors are long.

Copies collapse first, so the join sees each distinct vector once, with its number of copies.
Single precision decides all but what lies within a margin over its rounding error of ``cos``; that
is decided in double precision. A task gives back sums of counts, one for a vector, and the links
that connect what it has found not yet connected, fewer than its vectors: never all pairs of a group.

Only pivots come to the driver, one for a block of vectors. How many pairs of blocks are met depends
on the data: clustered vectors meet few, while directions without any structure in many dimensions
are within reach of most blocks, and their join tends to n * n / 2 products, done as matrix
products. Caps would lose links, so there are none.

Vectors that are null, empty, zero, or hold a null or non-finite component, link with nothing and
are components of their own, as are rows with a null id (their component is null). Vectors of
different lengths never link. Repeated ids count once for each row. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspan.llm.common import connected_components, cut

BLOCK = 4096
#: A cell of so many blocks is joined as it is.
SPREAD = 4
#: So many blocks are a partition of the join, and so many bytes of doubles a block at most.
TOGETHER = 32
BLOCK_BYTES = 1 << 22
_MARGIN = 1e-4


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length, single precision as it is and all else as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float32 if flat.dtype == np.float32 else np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distances(u: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (u @ p.T)))


def _linkable(key: str, vector: str) -> Column:
    v, finite = F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & F.col(key).isNotNull() & (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0)


def _digest(vector: str) -> Column:
    """32 bytes that stand for a linkable vector where only equality counts; zeros are equal, whatever their sign."""
    return F.unhex(F.sha2(F.array_join(F.transform(vector, lambda x: F.when(x == 0, "0").otherwise(x.cast("string"))), ","), 256))


def distinct_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(rep, n, v): each distinct linkable vector, its smallest id and how many rows hold it."""
    v = F.col(vector)
    return rows.where(_linkable(key, vector)).groupBy(v.alias("v")).agg(F.min(key).alias("rep"), F.count("*").alias("n")).select("rep", "n", "v")


def _home(batches: Iterator[pa.RecordBatch], pivot: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Each row (cell, was, ..., v) to the cell of its nearest pivot, with its distance from that; a cell's vectors are of one length."""
    for b in batches:
        cells = b.column(0).dictionary_encode()
        codes = cells.indices.to_numpy()
        for k, cell in enumerate(cells.dictionary.to_pylist()):
            part = b.filter(pa.array(codes == k))
            dist = _distances(_unit(_matrix(part.column("v"))), pivot[cell]) if cell in pivot else np.full((len(part), 1), 2.0)
            home = dist.argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array([f"{cell}/{c}" for c in home.tolist()], pa.string()), part.column(1), pa.array(dist.min(1)), *part.columns[2:]], names=["cell", "was", "far", *part.schema.names[2:]])


def _split(rows: DataFrame, r: float, pivots: int, block: int) -> DataFrame:
    """Rows of full cells in the cells of those cells' own pivots."""
    k = F.least(F.lit(pivots), F.ceil(F.col("m") / block))
    share = F.pmod(F.xxhash64("v"), F.lit(1 << 40)) / float(1 << 40)  # a few times as many as needed, before any sorting
    order = Window.partitionBy("cell").orderBy(F.xxhash64("v"), "rep")
    picked = rows.where(share * F.col("m") < 4 * k).withColumn("at", F.row_number().over(order) - 1).where(F.col("at") < k)
    pivot: dict[str, list] = {}
    for x in picked.select("cell", F.col("v").cast("array<double>").alias("w")).toLocalIterator():
        pivot.setdefault(x.cell, []).append(np.array(x.w))
    near = {c: _unit(np.stack(x)) for c, x in pivot.items()}
    others = [c for c in rows.columns if c not in ("cell", "m", "stuck")]
    kinds = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in others)
    placed = cut(rows.select("cell", F.col("m").alias("was"), *others).mapInArrow(lambda b: _home(b, near), "cell string, was long, far double" + kinds))
    own = cut(placed.groupBy("cell").agg(F.count("*").alias("m"), F.max("far").alias("reach")), narrow=True)
    stuck = (F.col("m") == F.col("was")) | (F.col("reach") <= r / 2)
    return placed.join(F.broadcast(own), "cell").select("cell", "m", stuck.alias("stuck"), *others)


_BLOCK = "block string, d int, mid array<double>, lo double, hi double, cls binary, rep binary, n binary, x binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (block, cls, rep, n, v) as one row for each block, with its middle and the range of its members' distances from it."""

    def packed(name, parts):
        cls, rep, n, x = (np.concatenate(y) for y in zip(*parts, strict=True))
        u = _unit(x)
        mid = u.mean(0, keepdims=True)
        mid = _unit(mid if np.linalg.norm(mid) > 1e-6 else u[:1])
        dist = _distances(u, mid)
        told = [name], [x.shape[1]], [mid[0].tolist()], [dist.min()], [dist.max()], [cls.tobytes()], [rep.tobytes()], [n.tobytes()], [x.tobytes()]
        kinds = pa.string(), pa.int32(), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(told, kinds, strict=True)], names=["block", "d", "mid", "lo", "hi", "cls", "rep", "n", "x"])

    now, parts = None, []
    for b in batches:
        names = np.array(b.column(0).to_pylist(), dtype=object)
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)] if len(names) else []
        for s, e in pairwise(cuts):
            if names[s] != now:
                if parts:
                    yield packed(now, parts)
                now, parts = names[s], []
            part = b.slice(s, e - s)
            parts.append((*(part.column(c).to_numpy() for c in (1, 2, 3)), _matrix(part.column(4))))
    if parts:
        yield packed(now, parts)


def _may_meet(r: float) -> Column:
    """Of blocks a and b: once for each two whose members may link, by the triangle inequality, and for each with itself; either may come first."""
    c = F.col
    dot = F.aggregate(F.zip_with("a.mid", "b.mid", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.sqrt(F.greatest(2 - 2 * dot, F.lit(0.0)))
    even = F.pmod(F.xxhash64("a.block"), F.lit(2)) == F.pmod(F.xxhash64("b.block"), F.lit(2))
    once = (c("a.block") == c("b.block")) | ((c("a.block") != c("b.block")) & ((c("a.block") < c("b.block")) == even))
    return once & (c("a.d") == c("b.d")) & (apart <= c("a.hi") + c("b.hi") + r)


def links(vectors: DataFrame, cos: float = 0.9, pivots: int = 256, block: int = BLOCK, spread: int = SPREAD, levels: int = 8) -> DataFrame:
    """Of (cls, rep, n, v), (kind, a, b): kind 0: the vector of number ``a`` has links with ``b`` more rows, in one or more rows; kind 1: ids a and b link."""
    r = float(np.sqrt(2 - 2 * cos)) + 1e-6
    full = (F.col("m") > spread * block) & ~F.col("stuck")
    rows = vectors.select(F.size("v").cast("string").alias("cell"), F.lit(vectors.count()).cast("long").alias("m"), F.lit(False).alias("stuck"), "cls", "rep", "n", "v")
    ready = []  # a table of several lengths counts them together here, and each length alone from the first level on
    for _ in range(levels):
        if rows.where(full).isEmpty():
            break
        ready.append(rows.where(~full))
        rows = _split(rows.where(full), r, pivots, block)
    for part in ready:
        rows = rows.unionByName(part)
    members = F.least(F.lit(block), F.greatest(F.lit(64), F.floor(BLOCK_BYTES / (8 * F.size("v")))))
    blocks = F.greatest(F.ceil(F.col("m") / members), F.lit(1))
    count = rows.groupBy("cell").agg(F.max(blocks).alias("k")).agg(F.sum("k")).first()[0] or 1
    dealt = rows.select(F.concat_ws("#", "cell", F.pmod(F.xxhash64("cls"), blocks)).alias("block"), "cls", "rep", "n", "v")
    # even partitions; each meets each, so a few make enough tasks
    parts = max(math.ceil(count / TOGETHER), min(count, math.ceil(math.sqrt(4 * rows.sparkSession.sparkContext.defaultParallelism))))
    # sorted in full: a task that runs again packs the same bytes, which are dealt by what they are
    packed = dealt.repartition("block").sortWithinPartitions("block", "cls").mapInArrow(_pack, _BLOCK).repartition(parts).hint("shuffle_replicate_nl")
    pairs = packed.alias("a").join(packed.alias("b"), _may_meet(r))
    sides = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in "ab" for c in packed.columns]
    return cut(pairs.select(*sides).mapInArrow(lambda b: _join(b, cos, r), "kind int, a long, b long"))


def _connect(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places i and j link: gives places they connect one label, the least, and returns links that do so and close no circle."""
    used = []
    while len(k := np.flatnonzero(label[i] != label[j])):
        i, j = i[k], j[k]
        high, low = np.maximum(label[i], label[j]), np.minimum(label[i], label[j])
        order = np.lexsort((low, high))
        first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
        used.append((i[first], j[first]))
        to = np.arange(len(label))
        to[high[first]] = low[first]
        while (to[to] != to).any():
            to = to[to]
        label[:] = to[label]
    return used


def _join(batches: Iterator[pa.RecordBatch], cos: float, r: float) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks to counts and links."""
    starts, seen, label, met = {}, [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting, edges = [], []

    def packed(kind, a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

    def settle():
        if waiting:
            edges.extend(_connect(label, *(np.concatenate(x) for x in zip(*waiting, strict=True))))
            waiting.clear()

    def opened(name, d, mid, lo, hi, cls, rep, n, x):
        """The block, and a place for each of its members among all that this task has seen."""
        nonlocal label, met
        rep, n = np.frombuffer(rep, np.int64), np.frombuffer(n, np.int64)
        if name not in starts:
            starts[name] = len(label)
            seen.append((np.frombuffer(cls, np.int64), rep))
            label, met = np.concatenate([label, np.arange(len(label), len(label) + len(rep))]), np.concatenate([met, np.zeros(len(rep), np.int64)])
        x = np.frombuffer(x, np.float32 if len(x) == 4 * d * len(rep) else np.float64).reshape(len(rep), d)
        return {"name": name, "rep": rep, "n": n, "unit": _unit(x), "mid": np.array([mid]), "lo": lo, "hi": hi, "start": starts[name]}

    def near(one, other):
        """Members of one block that may have partners in the other."""
        dist = _distances(one["unit"], other["mid"])[:, 0]
        return np.flatnonzero((dist >= other["lo"] - r) & (dist <= other["hi"] + r))

    def meet(one, other):
        mine, others = near(one, other), near(other, one)
        if not len(mine) or not len(others):
            return
        d, same = one["unit"].shape[1], one["name"] == other["name"]
        margin = max(_MARGIN, 2e-7 * d)
        left, right = one["unit"][mine].astype(np.float32), other["unit"][others].astype(np.float32).T
        step = max(1, (1 << 20) // len(others))
        for k in range(0, len(mine), step):
            close = left[k : k + step] @ right
            some = np.flatnonzero(close.max(1) >= cos - margin)
            if not len(some):
                continue
            close = close[some]
            i, j = np.nonzero(close >= cos - margin)
            link = close[i, j] >= cos + margin
            i, j = mine[k + some[i]], others[j]
            unsure = np.flatnonzero(~link)
            for s in range(0, len(unsure), max(1, (1 << 21) // d)):
                u = unsure[s : s + max(1, (1 << 21) // d)]
                link[u] = np.einsum("ij,ij->i", one["unit"][i[u]], other["unit"][j[u]]) >= cos
            link &= one["rep"][i] != other["rep"][j]
            i, j = i[link], j[link]
            met[one["start"] : one["start"] + len(one["rep"])] += np.bincount(i, other["n"][j], len(one["rep"])).astype(np.int64)
            i, j = i + one["start"], j + other["start"]
            if not same:
                met[other["start"] : other["start"] + len(other["rep"])] += np.bincount(j - other["start"], one["n"][i - one["start"]], len(other["rep"])).astype(np.int64)
            new = label[i] != label[j]
            waiting.append((i[new], j[new]))
            if sum(len(x) for x, _ in waiting) >= 1 << 16:
                settle()

    one = None
    for b in batches:
        for k in range(b.num_rows):
            a, c = ([b.column(x)[k].as_py() for x in side] for side in (range(9), range(9, 18)))
            one = one if one and one["name"] == a[0] else opened(*a)
            meet(one, one if c[0] == a[0] else opened(*c))
    settle()
    if seen:
        cls, rep = (np.concatenate(x) for x in zip(*seen, strict=True))
        k = np.flatnonzero(met)
        yield packed(0, cls[k], met[k])
        for i, j in edges:
            yield packed(1, rep[i], rep[j])


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cos: float = 0.9, **options) -> DataFrame:
    """One row per vector: key, n_links, component, kept."""
    narrow = rows.select(F.col(key).alias("_key"), F.col(vector).alias("_v"))
    classes = cut(distinct_vectors(narrow, "_key", "_v").withColumn("cls", F.monotonically_increasing_id()))  # vectors of a repeated id may share rep
    found = links(classes, cos, **options)
    counts = found.where("kind = 0").groupBy(F.col("a").alias("cls")).agg(F.sum("b").alias("met"))
    parts = connected_components(found.where("kind = 1").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    met = F.col("n") - 1 + F.coalesce("met", F.lit(0))
    short = classes.select("cls", "rep", "n", _digest("v").alias("_same"))
    told = short.join(counts, "cls", "left").join(parts, F.col("rep") == F.col("node"), "left").select("_same", met.alias("met"), F.coalesce("component", "rep").alias("component"))
    out = narrow.select("_key", F.when(_linkable("_key", "_v"), _digest("_v")).alias("_same")).join(told, "_same", "left")
    linked = F.col("_key").isNotNull()
    component = F.when(linked, F.coalesce("component", "_key"))
    return out.select(
        F.col("_key").alias(key), F.when(linked, F.coalesce("met", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component"), F.coalesce(F.col("_key") == component, F.lit(False)).alias("kept"),
    )


def op5(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings).withColumnRenamed("component", "component_id")


#: Every pair compared, and links followed to their end: the brute force of it, for small tables.
ORACLE = """
with recursive v as (select vec_id, cast(embedding as double[]) e from embeddings where len(embedding) > 0
 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (select a.vec_id a, b.vec_id b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.9),
reach as (select vec_id a, vec_id root from embeddings union select link.b, reach.root from reach join link on link.a = reach.a)
select vec_id, (select count(*) from link where link.a = vec_id) n_links, min(root) component_id, vec_id = min(root) kept from embeddings join reach on reach.a = vec_id group by vec_id
"""
