"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits: bit i is 1 if it is set in over half of the document's shingle
hashes. Two fingerprints link at ``3`` or fewer differing bits. Cut in two segments of 32 bits,
one segment of such a pair differs by at most one bit; so each segment is indexed under its 32
variants with one wildcard position, and every linked pair meets under an equal key. Candidates
are verified on all 64 bits.

Copies collapse first: the join sees each fingerprint once. A bucket of the join holds distinct
fingerprints that agree in 31 bits; of each of its groups it gives back every member with the
smallest, never all pairs. A bucket of more than ``BUCKET`` fingerprints (a huge group of near copies) is not
searched but keyed again by the same rule on the bits that are still free: first 16, then 8 of
the other segment; after that at most 2 ** 11 fingerprints can share a key, so nothing is
capped and no link is lost. Buckets are read as sorted streams: memory is one bucket's.

Words are lower-cased in A-Z only and split at ASCII white space; shingles are 3 words, repeats
included (fewer words: the whole sequence). A text without words, or null, has fingerprint zero
and links like any other. Components take their smallest non-null document id; ties and repeated
rows share their group's. Null ids get a component but never name one unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspan.llm.common import connected_components, cut, numbered, parts

BITS = 3
#: Fingerprints that one bucket compares with each other before it is keyed again; no key of the third level can have more.
BUCKET = 8192
_PIECE = 1 << 16


def fingerprint(text: str | bytes | None, size: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text (bytes: in UTF-8)."""
    import xxhash

    words = (text.encode() if isinstance(text, str) else text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - size + 1)
    begin = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stop = ends[-n:].tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, _PIECE):
        h = np.array([digest(line[a:b], 42) for a, b in zip(begin[k : k + _PIECE], stop[k : k + _PIECE], strict=True)], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): fp is the fingerprint as a signed long."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in parts(b):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))], names=["_key", "fp"])

    return rows.mapInArrow(run, f"_key {kind}, fp long").withColumnRenamed("_key", key)


def _variants(level: int) -> tuple[int, Column, Column]:
    """At each level: how many variants, the bits they look at, and how many bits that are."""
    v = F.col("v")
    if level == 1:
        part = F.when(v < 32, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("fp", 32))
        return 64, part, v % 32
    other = F.when(F.col("seg") == 0, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(0xFFFFFFFF))
    if level == 2:
        return 32, F.when(v < 16, other.bitwiseAND(0xFFFF)).otherwise(F.shiftrightunsigned(other, 16)), v % 16
    rest = F.when(F.col("half") == 0, F.shiftrightunsigned(other, 16)).otherwise(other.bitwiseAND(0xFFFF))
    return 16, F.when(v < 8, rest.bitwiseAND(0xFF)).otherwise(F.shiftrightunsigned(rest, 8)), v % 8


def _keyed(rows: DataFrame, level: int) -> DataFrame:
    """``rows(fp, key, seg, half)`` under each one-wildcard variant of this level."""
    n, part, wild = _variants(level)
    rows = rows.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), wild.cast("int"))
    rows = rows.withColumn("m", part.bitwiseAND(F.bitwise_not(one)))
    key = (F.col("v").cast("long") * (1 << 32)).bitwiseOR(F.col("m")) if level == 1 else F.xxhash64("key", "v", "m")
    return rows.select(
        key.alias("key"), "fp",
        (F.when(F.col("v") < 32, 0).otherwise(1) if level == 1 else F.col("seg")).cast("int").alias("seg"),
        (F.when(F.col("v") < 16, 0).otherwise(1) if level == 2 else F.lit(0)).cast("int").alias("half"),
    )


def stars(fp: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Of each group of ``fp`` (unsigned, distinct) that links connect: every other member, and the smallest as signed."""
    members, least, left = [], [], np.sort(fp.view(np.int64))
    while len(left) > 1:
        group, front, left = [left[:1]], left[:1], left[1:]
        while len(front) and len(left):
            at, front = front[0], front[1:]
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= bits
            if near.any():
                group.append(left[near])
                front, left = np.concatenate([front, group[-1]]), left[~near]
        if len(group) > 1:
            members += group[1:]
            least.append(np.full(sum(map(len, group)) - 1, group[0][0]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *members]), np.concatenate([none, *least])


_LINKS = "kind int, a long, b long, seg int, half int"


def _search(batches: Iterator[pa.RecordBatch], most: float) -> Iterator[pa.RecordBatch]:
    """Sorted (key, fp, seg, half): links of each bucket (kind 0), or its rows if it has over ``most`` (kind 1)."""
    names = ["kind", "a", "b", "seg", "half"]

    def packed(kind, a, b, seg, half):
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(a), pa.array(b), pa.array(np.broadcast_to(seg, n).astype(np.int32)), pa.array(np.broadcast_to(half, n).astype(np.int32))], names=names)

    def solve(key, fp, seg, half):
        """All runs of a block of whole buckets."""
        edge = np.flatnonzero(np.diff(key)) + 1
        begin, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])
        width = end - begin
        two = begin[width == 2]
        x, y = fp[two], fp[two + 1]
        ok = np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= BITS
        if ok.any():
            yield packed(0, x[ok], y[ok], 0, 0)
        found = []
        for s, e in zip(begin[width > 2], end[width > 2], strict=True):
            if e - s > most:
                yield packed(1, key[s:e], fp[s:e], seg[s], half[s])
            else:
                found.append(stars(fp[s:e]))
        if found:
            yield packed(0, *(np.concatenate(x) for x in zip(*found, strict=True)), 0, 0)

    held, hot = None, None
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if hot is not None:  # a bucket that has been given back in part: its other rows follow it
            same = int(np.searchsorted(cols[0], hot, "right"))
            if same:
                yield packed(1, cols[0][:same], cols[1][:same], cols[2][0], cols[3][0])
            if same == len(cols[0]):
                continue
            cols, hot = [c[same:] for c in cols], None
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        last = int(np.searchsorted(cols[0], cols[0][-1], "left"))
        if last:
            yield from solve(*[c[:last] for c in cols])
        held = [c[last:] for c in cols]
        if len(held[0]) > most:
            hot = held[0][0]
            yield packed(1, held[0], held[1], held[2][0], held[3][0])
            held = None
    if held is not None and len(held[0]):
        yield from solve(*held)


def links(distinct_fps: DataFrame) -> DataFrame:
    """(src, dst) fingerprints that differ in at most 3 bits; enough of them to connect every group."""
    rows = distinct_fps.select("fp", F.lit(0).cast("long").alias("key"), F.lit(0).alias("seg"), F.lit(0).alias("half"))
    out = None
    for level in (1, 2, 3):
        keyed = _keyed(rows, level)
        if level > 1:
            keyed = keyed.dropDuplicates(["key", "fp"])
        most = BUCKET if level < 3 else float("inf")
        found = cut(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _search(b, most), _LINKS), narrow=True)  # noqa: B023
        part = found.where("kind = 0").select(F.col("a").alias("src"), F.col("b").alias("dst"))
        out = part if out is None else out.union(part)
        rows = found.where("kind = 1").select(F.col("b").alias("fp"), F.col("a").alias("key"), "seg", "half")
        if level == 3 or rows.isEmpty():
            return out
    return out


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, fp (signed long), component (smallest key reachable)."""
    fps = cut(fingerprints(docs, key, text), narrow=True)
    groups = fps.groupBy("fp").agg(F.min(key).alias("_least"))
    named = connected_components(links(groups.select("fp")))
    named = groups.join(named, groups.fp == named.node, "left").select(groups.fp.alias("fp"), "_least", F.coalesce("component", groups.fp).alias("_part"))
    least = named.groupBy("_part").agg(F.min("_least").alias("component"))
    return fps.join(named.join(least, "_part").select(F.col("fp").alias("_fp"), "component"), F.col("fp") == F.col("_fp")).select(key, "fp", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group, the one with the smallest key.

    Null keys come last, and of rows that share the smallest key the first stays. Rows are told
    apart by a number of their own, so rows that share a key are judged each by its own text.
    """
    rows = numbered(docs)
    name = F.col("row").getField(key)
    found = components(rows.select(F.struct(name.isNull().alias("none"), name.alias("key"), "id").alias("at"), F.col("row").getField(text).alias("text")), "at", "text")
    return rows.join(found.where("at.id = component.id").select("at.id"), "id", "left_semi").select("row.*")


def op3(docs: DataFrame) -> DataFrame:
    return components(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
