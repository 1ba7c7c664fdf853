"""The prefix trie against dictionaries of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from factspan.llm import trie


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 255) | st.sampled_from([0, 1, 255]), max_size=6).map(bytes), max_size=120))
def test_the_radix_tree_holds_what_was_put(keys):
    tree, want = trie.Tree(), defaultdict(list)
    for k, key in enumerate(keys):
        tree.insert(key, k)
        want[key].append(k)
    found, order = {}, []

    def walk(node, before):
        path = before + node.path
        if node.ends:
            found[path] = node.ends
            order.append(path)
        held = node.items()
        assert node is tree.root or node.ends or len(held) > 1  # paths are compressed
        assert node.size == next(s for s in (4, 16, 48, 256) if len(held) <= s) or node is tree.root
        for byte, child in held:
            assert child.path[0] == byte and node.get(byte) is child
            walk(child, path)

    walk(tree.root, b"")
    assert found == want and order == sorted(want)


def test_layouts_grow():
    node, sizes = trie.Inner(b""), []
    for k in range(256):
        node.put(k * 37 % 256, trie.Inner(bytes([k * 37 % 256])))
        sizes.append(node.size)
    assert [sizes[k] for k in (3, 4, 15, 16, 47, 48, 255)] == [4, 16, 16, 48, 48, 256, 256]
    assert [b for b, _ in node.items()] == list(range(256)) and node.get(200).path == bytes([200])


def nodes(convs):
    """convs: {conv: [(role, text), ...]}"""
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                below[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    least = lambda p: min((c for c in members[p] if c is not None), default=None)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not below[p]
        saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    told = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in ends[p] if c is not None))).encode()).hexdigest()
    return sorted(((least(p), len(p), least(p[:-1]) if p else None, len(members[p]), len(below[p]), leaves[p], saved[p], told(p)) for p in members), key=repr)


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        own[c].append((t is not None, t or 0, (r or "", x or "")))
    own = {c: [v[2] for v in sorted(vs, key=lambda v: v[:2])] for c, vs in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if c is not None else 0
        head = own.get(c - c % 5, []) if c is not None else []
        out[c] = head[:h] + turns[h:]
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_op13_on_any_rows(spark, frame):
    rng, rows = random.Random(4), []
    said = [("user", "a"), ("user", "b"), ("assistant", "ü" * 9), ("", ""), (None, None), ("user", "x" * 5000)]
    for c in [k for k in range(400) if k % 7] + [None]:
        n = rng.choice([1, 2, 3, 5, 9, 14])
        hot = c is not None and c % 3 == 0  # a third are the same
        rows += [(c, t if t else rng.choice([0, None]), *(said[t % 3] if hot else rng.choice(said))) for t in range(n if not hot else 12)]
    rng.shuffle(rows)
    df = frame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as key", "1 as _b", "2 as conv")
    assert rows_of(trie.op13(df)) == nodes(rebuilt(rows))
    assert trie.op13(df.limit(0)).count() == 0
    one = frame([(3, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    assert rows_of(trie.op13(one)) == nodes(rebuilt([(3, 0, "user", "a")]))


def test_copies_over_many_ranges_and_a_long_conversation(spark, frame):
    convs = {k: [("u", "same"), ("a", "again")] for k in range(300)} | {k: [("u", "same")] for k in range(300, 400)} | {500: [("u", str(k)) for k in range(5000)], 501: [("u", str(k)) for k in range(4990)] + [("a", "other")]}
    rows = [(c, t, *x) for c, turns in convs.items() for t, x in enumerate(turns)]
    keys = trie.conversation_keys(trie.turn_ids(frame(rows, "conv_id long, turn long, role string, text string")))
    for share in (100_000, 20):
        assert rows_of(trie.prefix_trie(keys, share=share, broadcast_rows=0 if share == 20 else 10**6)) == nodes(convs)
