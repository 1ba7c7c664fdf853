"""Prefix tries of conversations by adaptive radix trees over fixed-width turn ids.

A turn's id has ``WIDTH`` bytes: twelve of the SHA-256 of its role and text, then the bytes of its
text as a big-endian number. A conversation is the concatenation of its ids, so ids of the same
width compare byte by byte as whole turns do, and a node of the trie is a prefix that ends on a
multiple of ``WIDTH``.

How it runs:

1. Turns become ids where they lie; one row per conversation then holds its ids in order (texts
   stay behind). These rows are written once and dealt by ranges of (ids, conversation): equal
   conversations lie side by side and still spread over as many tasks as they need, since no two
   rows are the same. The number of ranges grows with the conversations (``share`` of them each at most, about).
2. Each task builds an adaptive radix tree of its range: nodes of 4, 16, 48 or 256 children that
   grow into one another, and compressed paths. One walk from the leaves up gives every prefix
   that ends on a turn its members, children, leaves and saved tokens.
3. Prefixes of a range's first or last conversation may go on in the next range; all others are
   final. What is known of the former (``2 * ranges`` paths in all, whatever the data) is summed by
   prefix, and one small walk adds up what they hold of one another.
4. The members that end at a node are hashed in order. Within a range that is one string; where
   a conversation's copies go over several ranges, their strings are dealt by prefix and hashed
   one after the other, as SHA-256 asks, in constant memory.

Nulls: a null role or text is empty; a null turn sorts first, turns that share a number are
ordered by id; rows with a null conversation id form one conversation, which counts as a member but has
no number to be named or hashed by. Repeated rows are turns of their own. A
conversation's ids are one row, 16 bytes a turn. An empty table gives an empty result. Only the
columns named are read, so columns of other names don't matter.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspan.llm.common import crc32_sql, cut

WIDTH = 16
_EMPTY = hashlib.sha256(b"").hexdigest()


class Inner:
    """A node: a compressed path (from the parent's branching byte on), children by byte, the conversations that end here.

    Up to 4 and up to 16 children are two sorted lists, up to 48 an index of 256 bytes into a
    list, beyond that a list by byte. A node grows when it is full.
    """

    __slots__ = ("path", "ends", "size", "keys", "below")

    def __init__(self, path: bytes):
        self.path, self.ends, self.size, self.keys, self.below = path, None, 4, bytearray(), []

    def get(self, byte: int) -> Inner | None:
        if self.size <= 16:
            k = bisect_left(self.keys, byte)
            return self.below[k] if k < len(self.keys) and self.keys[k] == byte else None
        if self.size == 48:
            return self.below[self.keys[byte] - 1] if self.keys[byte] else None
        return self.below[byte]

    def put(self, byte: int, child: Inner) -> None:
        """Set the child of a byte; the node grows to the next layout if there is no room."""
        if self.size <= 16:
            k = bisect_left(self.keys, byte)
            if k < len(self.keys) and self.keys[k] == byte:
                self.below[k] = child
                return
            if len(self.keys) < self.size:
                self.keys.insert(k, byte)
                self.below.insert(k, child)
                return
        elif self.size == 48:
            if self.keys[byte]:
                self.below[self.keys[byte] - 1] = child
                return
            if len(self.below) < 48:
                self.below.append(child)
                self.keys[byte] = len(self.below)
                return
        else:
            self.below[byte] = child
            return
        held = self.items()
        self.size = {4: 16, 16: 48, 48: 256}[self.size]
        if self.size == 48:
            self.keys, self.below = bytearray(256), []
        elif self.size == 256:
            self.keys, self.below = bytearray(), [None] * 256
        if self.size > 16:
            for b, c in held:
                self.put(b, c)
        self.put(byte, child)

    def items(self) -> list[tuple[int, Inner]]:
        """Children in the order of their bytes."""
        if self.size <= 16:
            return list(zip(self.keys, self.below, strict=True))
        if self.size == 48:
            return [(b, self.below[k - 1]) for b, k in enumerate(self.keys) if k]
        return [(b, c) for b, c in enumerate(self.below) if c is not None]


class Tree:
    """An adaptive radix tree of byte strings, each with the ids put under it."""

    def __init__(self):
        self.root = Inner(b"")

    def insert(self, key: bytes, member) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.ends = node.ends or []
                node.ends.append(member)
                return
            child = node.get(key[at])
            if child is None:
                child = Inner(key[at:])
                child.ends = [member]
                node.put(key[at], child)
                return
            path = child.path
            if not key.startswith(path, at):
                same = _common(path, key, at)
                upper = Inner(path[:same])
                child.path = path[same:]
                upper.put(path[same], child)
                node.put(key[at], upper)
                child = upper
            at += len(child.path)
            node = child


def _common(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``path`` stand in ``key`` from ``at`` on."""
    low, high = 0, min(len(path), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if path[:mid] == key[at : at + mid] else (low, mid - 1)
    return low


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


class _Sum:
    """What is known of a subtree: members, the smallest, childless nodes, saved tokens, and its topmost nodes."""

    __slots__ = ("n", "least", "leaves", "saved", "children", "tops")

    def __init__(self):
        self.n, self.least, self.leaves, self.saved, self.children, self.tops = 0, None, 0, 0, 0, []

    def add(self, other: _Sum) -> None:
        self.n += other.n
        self.least = _least(self.least, other.least)
        self.leaves += other.leaves
        self.saved += other.saved
        self.children += other.children
        small, large = sorted((self.tops, other.tops), key=len)
        large.extend(small)
        self.tops = large


def _mark(before: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(before + turn, digest_size=16).digest()


def prefixes(tree: Tree, first: bytes, last: bytes) -> tuple[list[list], list[tuple]]:
    """The nodes of a tree: final rows, and what is known of prefixes of ``first`` and ``last``.

    Final: [least member, depth, parent's least member, members, children, leaves, saved, members
    that end here, parent's mark]; the mark stands where the parent isn't final. Open: (mark,
    parent's mark, depth, bytes of the last text, members, least member, children, leaves, saved,
    members that end here), of what is final below and of this range's members.
    """
    marks = {}
    for side, key in enumerate((first, last)):
        marks[side] = [b"root"]
        for at in range(0, len(key), WIDTH):
            marks[side].append(_mark(marks[side][-1], key[at : at + WIDTH]))
    final, open_, done = [], {}, {}
    stack = [(tree.root, 0, True, True, b"", False)]  # node, where its path begins, prefix of first, of last, what of the turn came before
    while stack:
        node, at, is_first, is_last, part, ready = stack.pop()
        end = at + len(node.path)
        held = node.items()
        if not ready:
            stack.append((node, at, is_first, is_last, part, True))
            rest = (part + node.path)[-(end % WIDTH) :] if end % WIDTH else b""
            for k, (_, child) in enumerate(held):
                stack.append((child, end, is_first and k == 0 and not node.ends, is_last and k == len(held) - 1, rest, False))
            continue
        below = _Sum()
        for _, child in held:
            below.add(done.pop(id(child)))
        ends = node.ends or []
        below.n += len(ends)
        for e in ends:
            below.least = _least(below.least, e)
        # depths that end on this node's path, the deepest first; the root's own depth is 0
        deepest, shallowest = end // WIDTH, at // WIDTH + 1 if node is not tree.root else 0
        for depth in range(deepest, shallowest - 1, -1):
            here = ends if depth * WIDTH == end else []
            if is_first or is_last:
                side = 0 if is_first else 1
                mark = marks[side][depth]
                size = int.from_bytes((first, last)[side][depth * WIDTH - 4 : depth * WIDTH], "big") if depth else 0
                open_[mark] = (mark, marks[side][depth - 1] if depth else None, depth, size, below.n, below.least, below.children, below.leaves, below.saved, here)
                for top in below.tops:
                    top[8] = mark
                # what is final below is told once, with this prefix; prefixes above add it up in the end
                below.leaves = below.saved = below.children = 0
                below.tops = []
                continue
            begin = depth * WIDTH - 4 - at
            size = int.from_bytes(node.path[begin : begin + 4] if begin >= 0 else (part + node.path)[begin + len(part) : begin + len(part) + 4], "big")
            below.leaves += 0 if below.children else 1
            below.saved += (below.n - 1) * size
            row = [below.least, depth, None, below.n, below.children, below.leaves, below.saved, here, None]
            for top in below.tops:
                top[2] = below.least
            final.append(row)
            below.children, below.tops = 1, [row]
        done[id(node)] = below
    return final, list(open_.values())


def _told(members: list) -> str:
    """The members that have a number, ascending, joined by commas."""
    return ",".join(map(str, sorted(m for m in members if m is not None)))


def turn_ids(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, id): ids as hexadecimal digits."""
    said = F.coalesce(F.col(text), F.lit(""))
    who = F.coalesce(F.col(role), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said), 256)
    return turns.select(F.col(conv).alias("_c"), F.col(turn).alias("_t"), F.concat(F.substring(digest, 1, 24), F.lpad(F.lower(F.hex(F.octet_length(said))), 8, "0")).alias("_id"))


def conversation_keys(ids: DataFrame) -> DataFrame:
    """(conv, key): each conversation's ids in order, as bytes."""
    told = ids.groupBy("_c").agg(_in_order().alias("_ids"))
    return told.select(F.col("_c").alias("conv"), _bytes(F.col("_ids")).alias("key"))


def _in_order() -> Column:
    return F.transform(F.sort_array(F.collect_list(F.struct("_t", "_id"))), lambda x: x["_id"])


def _bytes(ids: Column) -> Column:
    return F.unhex(F.array_join(ids, ""))


def rebuilt_keys(ids: DataFrame) -> DataFrame:
    """(conv, key) of conversations as the contract rebuilds them: the first turns come from the first of each five.

    Turns are dealt once, by five: both a conversation and the head it takes are found there.
    """
    five = ids.withColumn("_b", F.col("_c") - F.col("_c") % 5).repartition("_b")
    own = five.groupBy("_b", "_c").agg(_in_order().alias("_ids"))
    none = F.array().cast("array<string>")
    head = F.max(F.when(F.col("_c") == F.col("_b"), F.slice("_ids", 1, 8))).over(Window.partitionBy("_b"))
    h = F.coalesce((F.crc32(F.col("_c").cast("string").cast("binary")) % 9).cast("int"), F.lit(0))
    own = own.select("_c", "_ids", F.coalesce(head, none).alias("_head"), h.alias("_h"))
    rest = F.slice("_ids", F.col("_h") + 1, F.greatest(F.lit(0), F.size("_ids") - F.col("_h")))
    return own.select(F.col("_c").alias("conv"), _bytes(F.concat(F.slice("_head", F.lit(1), F.col("_h")), rest)).alias("key"))


_NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, first_end long, mark binary, parent binary, size long"


def _range_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one range of conversations, which come in order of (key, conv)."""
    tree, first, last = Tree(), None, None
    for b in batches:
        for conv, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            first, last = key if first is None else first, key
            tree.insert(key, conv)
    if first is None:
        return
    final, open_ = prefixes(tree, first, last)
    names = [c.split()[0] for c in _NODES.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in _NODES.split(", ")]
    for k in range(0, len(final), 10_000):
        rows = [(*r[:7], hashlib.sha256(_told(r[7]).encode()).hexdigest() if r[7] else _EMPTY, None, None, r[8], None) for r in final[k : k + 10_000]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    for mark, parent, depth, size, n, least, children, leaves, saved, ends in open_:
        told = [e for e in ends if e is not None]
        row = (least, depth, None, n, children, leaves, saved, _told(told), min(told, default=None), mark, parent, size)
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes that several ranges share, with what they hold of one another; as many as ranges have paths."""
    rows = {r["mark"]: r for b in batches for r in b.to_pylist()}
    for r in sorted(rows.values(), key=lambda r: -r["depth"]):
        r["n_leaves"] += 0 if r["n_children"] else 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["size"]
        if above := rows.get(r["parent"]):
            above["n_children"] += 1
            above["n_leaves"] += r["n_leaves"]
            above["saved_tokens"] += r["saved_tokens"]
            r["parent_conv_id"] = above["conv_id"]
    if rows:
        schema = pa.schema([("mark", pa.binary()), *[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]])
        yield pa.RecordBatch.from_pylist([{c: r[c] for c in schema.names} for r in rows.values()], schema)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the members of each prefix; their strings come in order of (mark, first member)."""
    mark, sha, out = None, None, []
    for b in batches:
        for m, told in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if m != mark:
                out += [(mark, sha.hexdigest())] if sha else []
                mark, sha = m, hashlib.sha256(told.encode())
            else:
                sha.update(f",{told}".encode())
    out += [(mark, sha.hexdigest())] if sha else []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], names=["mark", "ends_sha256"])


def prefix_trie(keys: DataFrame, share: int = 100_000, broadcast_rows: int = 500_000) -> DataFrame:
    """A row per node of the trie of ``keys`` (conv long, key binary): the contract's columns.

    ``share``: conversations a range has at most, about, which bounds the memory of a task.
    """
    spark = keys.sparkSession
    keys = cut(keys.select("conv", "key"))
    ranges = max(spark.sparkContext.defaultParallelism, -(-keys.count() // share))
    dealt = keys.repartitionByRange(ranges, "key", "conv").sortWithinPartitions("key", F.col("conv"))
    nodes = cut(dealt.mapInArrow(_range_nodes, _NODES))
    open_ = nodes.where("mark is not null")
    same = ["parent", "depth", "size"]
    summed = open_.groupBy("mark").agg(*[F.first(c).alias(c) for c in same], F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.lit(None).cast("long").alias("parent_conv_id"))
    settled = cut(summed.repartition(1).mapInArrow(_settle, "mark binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"))
    told = open_.where("first_end is not null").select("mark", "ends", "first_end").repartition("mark").sortWithinPartitions("mark", "first_end").select("mark", "ends")
    hashed = told.mapInArrow(_ends, "mark binary, ends_sha256 string")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = settled.join(hashed, "mark", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))).select(*columns)
    closed = nodes.where("mark is null").withColumnRenamed("ends", "ends_sha256")
    above = settled.select(F.col("mark").alias("parent"), F.col("conv_id").alias("_above"))
    if settled.count() <= broadcast_rows:  # paths of the ranges' first and last conversations, some 2 * ranges
        above = F.broadcast(above)
    hung = closed.where("parent is not null").join(above, "parent").withColumn("parent_conv_id", F.col("_above"))
    return closed.where("parent is null").select(*columns).unionByName(hung.select(*columns)).unionByName(shared)


def op13(conversations: DataFrame) -> DataFrame:
    return prefix_trie(rebuilt_keys(turn_ids(conversations)))


#: Without a tree: every prefix of every conversation, grouped, and summed over all prefixes of it.
ORACLE = f"""
with t as (select conv_id c, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
i as (select c, turn, sha256(cast(octet_length(encode(role)) as varchar) || ':' || role || text)[1:24] || lpad(printf('%x', octet_length(encode(text))), 8, '0') id from t),
o as (select c, list(id order by turn nulls first, id) ids, coalesce({crc32_sql("c")} % 9, 0) h from i group by c),
r as (select o.c, list_concat(list_slice(coalesce(b.ids, []), 1, o.h), list_slice(o.ids, o.h + 1, len(o.ids))) ids from o left join o b on b.c = o.c - o.c % 5),
p as (select c, ids, d, array_to_string(list_slice(ids, 1, d), '') p from (select c, ids, unnest(range(len(ids) + 1)) d from r)),
node as (select p, d, min(c) conv_id, count(*) n_convs, count(distinct ids[d + 1]) n_children, string_agg(c, ',' order by c) filter (len(ids) = d) ends,
  (count(*) - 1) * case when d = 0 then 0 else cast('0x' || any_value(ids[d])[25:32] as bigint) end saved from p group by p, d),
up as (select unnest(range(d + 1)) k, p, saved, n_children from node),
below as (select p[1:32 * k] p, k d, count(*) filter (n_children = 0) n_leaves, cast(sum(saved) as bigint) saved_tokens from up group by 1, 2)
select n.conv_id, n.d as depth, q.conv_id as parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, sha256(coalesce(n.ends, '')) as ends_sha256
from node n join below using (p, d) left join node q on q.d = n.d - 1 and q.p = n.p[1:32 * q.d]
"""
