"""Operators over the whole corpus against brute force."""

import bisect
import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from factspan.llm import decontaminate, embeddings, mixing, sharding, simhash
from factspan.llm.common import connected_components

rng = random.Random(5)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
prose = lambda n: " ".join(rng.choices(VOCABULARY, k=n))


def groups(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in linked:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark, frame):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(200, 100), (100, 150), (-5, 300), (7, 7)]
    got = {r.node: r.component for r in connected_components(frame(pairs, "src long, dst long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 150: 100, 200: 100, -5: -5, 300: -5}
    assert connected_components(frame([], "src long, dst long")).count() == 0


def reference_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \n\t ", "One", "one two", "a b c", "A É é B\x0bc d", prose(300), "x " * 3000, "  nbsp word em"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == reference_fingerprint(text)


def check_op3(df):
    got = simhash.op3(df).collect()
    rows = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got if r.doc_id is not None))
    part = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 3])
    assert [r[2] for r in rows] == [rows[p][0] for p in part]
    return got


def test_op3(spark, frame):
    texts = [prose(120) for _ in range(25)]
    near = [t.replace(t.split()[k], "changed", 1) for t in texts[:10] for k in (3, 70)]
    docs = list(enumerate(texts + near + texts[:5] + ["", None, "w", "W", prose(4)])) + [(3, texts[3]), (None, texts[0])]
    df = frame(docs, "doc_id long, text string").selectExpr("*", "1 as fp", "'k' as key")
    got = check_op3(df)
    assert len(got) == len(docs) and {r.fingerprint for r in got if r.doc_id in (50, 51)} >= {"0" * 16}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    best = {r.component_id for r in got}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(best)
    assert simhash.op3(df.limit(0)).count() == 0


def test_large_buckets_are_split_not_capped(spark, frame, monkeypatch):
    """A ball of fingerprints around one value: with tiny buckets every level of keys is used."""
    center = 0x0123456789ABCDEF
    values = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(150)}
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in sorted(values)]
    monkeypatch.setattr(simhash, "BUCKET", 4)
    got = {r.node: r.component for r in connected_components(simhash.links(frame(rows, "fp long"))).collect()}
    signed = sorted(r[0] for r in rows)
    part = groups(len(signed), [(i, j) for i in range(len(signed)) for j in range(i) if ((signed[i] ^ signed[j]) & (2**64 - 1)).bit_count() <= 3])
    assert [got.get(s, s) for s in signed] == [signed[p] for p in part]


def test_op4(spark, frame):
    docs = [(i, prose(rng.randint(1, 40)), s) for i, s in enumerate(["a"] * 200 + ["b"] * 60 + [None] * 30 + ["é"] * 5 + ["B"] * 100)] + [(900, None, "z"), (901, "", "z"), (0, "again and again", "a"), (None, "x y", "a")]
    df = frame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as _at")
    got = mixing.op4(df).collect()
    assert len(got) == len(docs)
    names = sorted({s for _, _, s in docs if s is not None}) + [None]
    size = {n: sum(len((t or "").split()) for _, t, s in docs if s == n) for n in names}
    weight = {n: (1, 2, 3)[i % 3] for i, n in enumerate(names)}
    total, open_, target = sum(size.values()), set(names), {}
    while open_:
        left, w = total - sum(target.values()), sum(weight[n] for n in open_)
        over = {n for n in open_ if left * weight[n] / w > 3 * size[n]}
        target |= {n: 3 * size[n] for n in over} if over else {n: left * weight[n] / w for n in open_}
        open_ = open_ - over if over else set()
    source = {i: s for i, _, s in docs}
    taken = dict.fromkeys(names, 0)
    for r in got:
        n = source[r.doc_id]
        assert r.source_size == size[n] and r.target == pytest.approx(target[n]) and r.taken <= 3 * r.size and r.taken == r.copies * r.size and len(r.shards) == r.copies
        taken[n] += r.taken
    assert all(abs(taken[n] - target[n]) <= 3 + 0.01 * target[n] for n in names)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.op4(df.repartition(3)).collect()), key=repr)
    mixed = mixing.mixed_documents(df.where("doc_id > 0"))
    assert mixed.columns == df.columns and mixed.count() > 0
    assert mixing.op4(df.limit(0)).count() == 0


def test_splitting_tree_meets_every_quota(spark, frame):
    """Every block is drawn once, shards are even, and counts by source follow the hypergeometric law."""
    n = {"a": 50, "b": 30, "c": 16}
    blocks = frame([(s, b) for s, k in n.items() for b in range(k)], "_src string, block int").cache()
    counts = []
    for seed in range(12):
        got = mixing.split_tree(blocks, 6, seed).collect()
        assert sorted((r._src, r.block) for r in got) == [(s, b) for s, k in n.items() for b in range(k)]
        assert np.bincount([r.shard for r in got]).tolist() == [16] * 6
        counts += [[sum(r._src == s and r.shard == k for r in got) for s in "abc"] for k in range(6)]
    x, share = np.array(counts), np.array([50, 30, 16]) / 96
    assert np.allclose(x.mean(0), 16 * share, atol=0.01)
    law = 16 * share * (1 - share) * (96 - 16) / 95
    assert (x.var(0) > 0.5 * law).all() and (x.var(0) < 1.7 * law).all()


def test_what_is_taken_is_what_shards_draw(spark, frame, monkeypatch):
    """By hand: copies whose middle word lies in a drawn block, then copies in permuted order until the target is met, then the best fit."""
    docs = [(i, " ".join("w" * rng.randint(1, 30)), "ab"[i % 3 == 0]) for i in range(300)]
    df = frame(docs, "doc_id long, text string, source string")
    options = {"blocks": 40, "buckets": 8, "shards": 5}
    got = {r.doc_id: r for r in mixing.mix(df, **options).collect()}
    at = {r.doc_id: r.h for r in df.selectExpr("doc_id", "xxhash64(doc_id, xxhash64(text), 42) h").collect()}
    sizes = frame([(f"={s}", sum(got[i].size for i, _, x in docs if x == s)) for s in "ab"], "_src string, source_size long")
    drawn = {r._src: r for r in mixing.draw(mixing.quotas(mixing.targets(sizes), 40), 5, 42).collect()}
    for s in "ab":
        ids, plan = sorted((i for i, _, x in docs if x == s), key=lambda i: (at[i] % 8, at[i])), drawn[f"={s}"]
        assert sum(x is not None for x in plan._shards) == plan.quota <= plan.n_blocks == len(plan._shards)
        size, target, begin, want = got[ids[0]].source_size, got[ids[0]].target, 0, {}
        for i in ids:
            want[i] = sum(plan._shards[int((e * size + begin + got[i].size / 2) // plan.block_words)] is not None for e in range(3))
            begin += got[i].size
        assert begin == size
        off = target - sum(n * got[i].size for i, n in want.items())
        left, by = abs(off), 1 if off > 0 else -1
        for i in ids:
            may = 3 - want[i] if by > 0 else want[i]
            k = max(0, min(may, int(left // got[i].size)))
            left -= may * got[i].size
            want[i] += by * k
        changed = [i for i in ids if got[i].copies != want[i]]
        assert len(changed) <= 1
        before, after = (abs(target - sum(n * got[i].size for i, n in c.items())) for c in (want, {i: got[i].copies for i in ids}))
        assert after <= before <= 30 and (not changed or after < before)
    rows = mixing.mixed_rows(df, **options).collect()
    draws = sorted((i, d.shard, d.mix_order) for i, r in got.items() for d in r.draws)
    assert [x[:2] for x in draws] == sorted((r.row.doc_id, r.shard) for r in rows) and {r.shard for r in rows} == set(range(5))
    assert len({r.mix_order for r in rows}) == len(rows)
    # the tree decides what is taken: with one that gives all to the first shard other documents are
    monkeypatch.setattr(mixing, "split_tree", lambda units, shards, seed: units.select("_src", "block", mixing.F.lit(0).alias("shard")))
    other = {r.doc_id: r.copies for r in mixing.mix(df, **options).collect()}
    assert sum(other[i] != got[i].copies for i in other) > 30


def test_hot_ids_are_spread(spark, frame):
    """A third of the rows without an id and a third with the same: buckets of the mix go by their texts too."""
    df = frame([(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " * (i % 9), "a") for i in range(3000)], "doc_id long, text string, source string")
    got = mixing.mix(df).agg(mixing.F.sum("taken").alias("n"), mixing.F.first("target").alias("t")).first()
    assert abs(got.n - got.t) <= 27
    buckets = df.selectExpr("pmod(xxhash64(doc_id, xxhash64(text), 42), 4096) b").groupBy("b").count()
    assert buckets.where("count > 20").count() <= 3  # those of the empty texts
    counts = [r["count"] for r in sharding.op6(df).groupBy("shard").count().collect()]
    assert len(counts) == 16 and max(counts) - min(counts) <= 1


def test_mix_is_written_by_shard(spark, frame, tmp_path):
    df = frame([(i, prose(9), "ab"[i % 2]) for i in range(60)], "doc_id long, text string, source string")
    mixing.write_mix(df, f"{tmp_path}/mix", shards=4)
    out = spark.read.parquet(f"{tmp_path}/mix")
    assert set(out.columns) == {*df.columns, "_shard"} and out.count() == mixing.mixed_documents(df, shards=4).count()
    assert mixing.mixed_documents(df.limit(0)).count() == 0


def brute_vectors(rows, cos=0.9):
    keys = [k for k, _ in rows]
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    linked = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cos:
                    linked.append((i, j))
    part = groups(len(rows), linked)
    least = {}
    for i, p in enumerate(part):
        least[p] = min(least.get(p, keys[i]), keys[i])
    counts = np.bincount(np.array(linked, int).ravel(), minlength=len(rows)) if linked else np.zeros(len(rows), int)
    return sorted((keys[i], int(counts[i]), least[part[i]]) for i in range(len(rows)))


@pytest.mark.parametrize("options", [{}, {"block": 5, "spread": 1}, {"block": 3, "spread": 2, "pivots": 2}, {"block": 3, "spread": 1, "levels": 0}])
def test_op5(spark, frame, options):
    g = np.random.default_rng(3)
    centers = g.standard_normal((8, 6))
    vectors = [(c + s * g.standard_normal(6)).astype(np.float32).tolist() for c in centers for s in (0.05, 0.1, 0.2, 0.4, 0.4)]
    rows = list(enumerate(vectors + [vectors[0], vectors[0], [0.0] * 6, [], None, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0], [2.0, 4.0], [1e-30] * 6, [3e30] * 6]))
    df = frame([(k, None if v is None else v, 0) for k, v in rows], "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as rep", "2 as n")
    got = sorted((r.vec_id, r.n_links, r.component, r.kept) for r in embeddings.near_duplicates(df, **options).collect())
    assert [x[:3] for x in got] == brute_vectors(rows) and all(x[3] == (x[0] == x[2]) for x in got)
    assert embeddings.op5(df.limit(0)).count() == 0


def test_cells_split_level_by_level(spark, frame):
    """Pivots of pivots find what brute force finds; clustered vectors go to few cells, a single direction to blocks."""
    g = np.random.default_rng(5)
    spread = [(c + 0.15 * g.standard_normal(8)).tolist() for c in g.standard_normal((60, 8)) for _ in range(6)]
    one_way = [[float(k), 0.0, float(k), 0.0, 0.0, 0.0, 0.0, 0.0] for k in range(1, 60)]
    rows = list(enumerate(spread + one_way))
    df = frame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component) for r in embeddings.near_duplicates(df, block=8, spread=2, pivots=3).collect())
    assert got == brute_vectors(rows)
    tight = frame([(i, (c + 1e-3 * g.standard_normal(32)).tolist()) for i, c in enumerate(np.repeat(g.standard_normal((64, 32)), 8, axis=0))], "vec_id long, embedding array<double>")
    classes = embeddings.distinct_vectors(tight, "vec_id", "embedding").selectExpr("''  as cell", "512L as m", "false as stuck", "0 as visit", "rep", "n", "v")
    r = float(np.sqrt(0.02)) + 1e-7
    first = embeddings._split(classes, r, 8, 32)
    second = embeddings._split(first, r, 8, 8)
    for level in (first, second):
        assert level.where("visit = 0").count() == level.where("visit = 0").select("rep").distinct().count() == 512
    few, many = first.select("cell").distinct().count(), second.select("cell").distinct().count()
    assert many > 2 * few and second.count() < 2 * first.count() < 512 * few  # copies don't grow with the cells


def test_vectors_without_structure_are_not_copied(spark, frame, tmp_path):
    """Every block may hold partners of every vector, and still what is written grows as the vectors do; results are brute force's."""
    g = np.random.default_rng(11)
    g_rows = lambda n: [(k, v) for k, v in enumerate(x for c in g.standard_normal((n // 2, 24)) for x in (c.tolist(), (c + 0.05 * g.standard_normal(24)).tolist()))]
    context, kept = spark.sparkContext, spark.sparkContext.getCheckpointDir()
    written = []
    try:
        for n in (1000, 4000):
            rows = g_rows(n)
            context.setCheckpointDir(str(tmp_path / str(n)))
            out = embeddings.near_duplicates(frame(rows, "vec_id long, embedding array<double>"), block=32, spread=1).collect()
            written.append(sum(p.stat().st_size for p in (tmp_path / str(n)).rglob("part-*")))
            x = np.array([v for _, v in rows])
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            met = (x @ x.T >= 0.9).sum(1) - 1
            assert met.max() == 1 and sorted((r.vec_id, r.n_links, r.component) for r in out) == [(k, m, k - k % 2 if m else k) for k, m in enumerate(met)]
    finally:
        context.setCheckpointDir(kept)
    assert written[1] < 6 * written[0] and written[1] < 4000 * 24 * 8 * 8


def test_links_of_a_cell_that_cannot_split_and_of_copies(spark, frame):
    """One narrow group over many blocks: each link counts once for each row, whichever block comes first, and all are one component."""
    g = np.random.default_rng(12)
    group = [(c / np.linalg.norm(c)).tolist() for c in np.array([1.0, 1.0, 0.0, 0.0]) + 0.02 * g.standard_normal((150, 4))]
    ring = [[float(np.cos(a)), float(np.sin(a)), 0.0, 0.0, 5.0] for a in np.arange(0, 2 * np.pi, 0.03)]
    rows = list(enumerate(group + group[:40] + [[-x for x in v] for v in group[:5]] + ring + [[0.0, 1.0], [-0.0, 1.0]]))
    df = frame(rows, "vec_id long, embedding array<double>")
    for options in ({"block": 16, "spread": 1}, {"block": 7, "spread": 2, "pivots": 3}):
        got = sorted((r.vec_id, r.n_links, r.component) for r in embeddings.near_duplicates(df, **options).collect())
        assert got == brute_vectors(rows)


def test_vectors_of_a_repeated_id(frame):
    """One row for each vector, with that vector's own links, also where two vectors of one id are the first of theirs."""
    df = frame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (None, [1.0, 0.0]), (3, [-0.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id) for r in embeddings.op5(df).collect()))
    assert got == [(0, 0, None), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_connect_keeps_one_link_for_each_merge():
    g = np.random.default_rng(13)
    for links in (1, 40, 400):
        i, j = g.integers(0, 120, (2, links))
        label = np.arange(120)
        kept = embeddings._connect(label, i[: links // 2], j[: links // 2]) + embeddings._connect(label, i, j)
        part, same = groups(120, list(zip(i.tolist(), j.tolist()))), groups(120, [(int(a), int(b)) for x, y in kept for a, b in zip(x, y)])
        assert len(set(zip(part, same))) == len(set(part)) == len(set(same)) == len(set(label.tolist())) == 120 - sum(len(x) for x, _ in kept)


def test_op6(spark, frame):
    docs = [(i, "x" * (i % 7) + "é") for i in range(333)] + [(None, None), (None, None), (5, "again"), (5, "again"), (-1, None)]
    df = frame(docs, "doc_id long, text string").selectExpr("*", "7 as shard", "'s' as slot", "1 as _slot", "2 as _row")
    got = sharding.op6(df).collect()
    n = np.bincount([r.shard for r in got], minlength=16)
    assert len(got) == len(docs) and n.max() - n.min() <= 1
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n[s]))
    import zlib

    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs}
    out = sharding.ring_shards(df)
    assert sorted(out.columns) == sorted(df.columns) and out.count() == len(docs)
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.op6(df.repartition(5)).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in got}
    assert sharding.op6(df.limit(0)).count() == 0 and sharding.op6(df.limit(1)).count() == 1


def test_most_keys_stay_on_their_arc(spark, frame):
    """Full shards pass on what they can't hold, and only that."""
    points = sharding.ring(spark, 8, 48, 1 << 12)
    arcs = sharding.slot_arcs(points, 1 << 12).collect()
    assert sorted(r.slot for r in arcs) == list(range(1 << 12))
    home = {r.arc: r.shard for r in points.collect()}
    load = [(r.arc, 10) for r in points.collect()]
    pieces = sharding.allocate(points, frame(load, "arc int, own long"), 8).collect()
    taken = np.zeros(8, int)
    for r in pieces:
        lo = 0
        for p in r.pieces:
            assert p.lo == lo
            lo = p.hi
            taken[p.shard] += p.hi - p.lo
        assert lo == 10
    assert taken.tolist() == [480] * 8 and all(p.shard == home[r.arc] for r in pieces for p in r.pieces)
    skew = [(a, 1000 if a < 20 else 1) for a, _ in load]
    pieces = sharding.allocate(points, frame(skew, "arc int, own long"), 8).collect()
    taken = np.zeros(8, int)
    for r in pieces:
        for p in r.pieces:
            taken[p.shard] += p.hi - p.lo
    total = sum(n for _, n in skew)
    assert sorted(taken) == sorted(total // 8 + (s < total % 8) for s in range(8))


def walked(points, keys, shards, n):
    """By hand: keys on the ring, own arcs first, then what is over goes on clockwise to the next shards with room."""
    cap = [n // shards + (k < n % shards) for k in range(shards)]
    at = [p.at for p in points]
    of_arc = [[] for _ in points]
    for slot, hashed, key in sorted(keys):
        of_arc[bisect.bisect_left(at, slot) % len(points)].append(key)
    home, over = {}, []
    for p, ks in zip(points, of_arc):
        fits = min(len(ks), cap[p.shard])
        cap[p.shard] -= fits
        home |= dict.fromkeys(ks[:fits], p.shard)
        over.append(ks[fits:])
    waiting = []
    for p, ks in [*zip(points, over), *((p, []) for p in points)]:
        waiting += ks
        taken, waiting = waiting[: cap[p.shard]], waiting[cap[p.shard] :]
        cap[p.shard] -= len(taken)
        home |= dict.fromkeys(taken, p.shard)
    return home


def test_op6_walks_the_ring(spark, frame):
    n, slots = 3001, 1 << 10
    df = frame([(i, f"text {i}") for i in range(n)], "doc_id long, text string")
    hashed = df.selectExpr("doc_id", "xxhash64(doc_id) h").collect()
    placed = {}
    for shards in (7, 8):
        points = sorted(sharding.ring(spark, shards, 48, slots).collect(), key=lambda p: p.arc)
        want = walked(points, [((r.h % (1 << 64)) >> 54, r.h, r.doc_id) for r in hashed], shards, n)
        placed[shards] = {r.doc_id: r.shard for r in sharding.ring_shards(df, shards=shards, slots=slots).collect()}
        assert placed[shards] == want
    moved = sum(placed[7][i] != placed[8][i] for i in range(n))
    # a new shard takes an eighth; the tight bound moves some more along the ring, far from the 7/8 of hashing anew
    assert n / 8 <= moved <= n / 2, moved


def test_op9(spark, frame):
    bench = [(1, prose(40)), (2, prose(25)), (3, prose(8)), (4, "too short"), (5, None), (6, prose(40))]
    bench += [(7, bench[0][1].upper())]
    one = bench[0][1].split()
    swapped = [w if i % 9 else "OTHER" for i, w in enumerate(one)]
    docs = {
        10: prose(50) + " " + bench[0][1] + " " + prose(5), 11: prose(9) + "\n" + " ".join(swapped) + ". " + prose(30), 12: bench[1][1].replace(" ", ",  "), 13: "Say: " + bench[2][1].title() + "!",
        14: " ".join(one[:22]) + " " + prose(60), 20: prose(400), 21: " ".join(one[:9]) + " " + prose(60), 22: "too short", 23: "", 24: None, 25: " ".join(reversed(one)), 26: prose(5000), 27: " ".join(bench[2][1].split()[:6]),
    }
    df = frame([*docs.items(), (10, docs[10]), (None, docs[12])], "doc_id long, text string").selectExpr("*", "1 as pos", "2 as _row")
    bf = frame(bench, "item_id long, text string")
    got = decontaminate.contaminated(df, bf)
    found = sorted(((r.doc_id, tuple(r["items"])) for r in got.collect()), key=repr)
    assert found == sorted([(10, (1, 7)), (10, (1, 7)), (11, (1, 7)), (12, (2,)), (13, (3,)), (14, (1, 7)), (None, (2,))], key=repr)
    forced = decontaminate.contaminated(df, bf, broadcast_seeds=0)
    assert sorted(((r.doc_id, tuple(r["items"])) for r in forced.collect()), key=repr) == found
    left = decontaminate.clean(df, bf)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [20, 21, 22, 23, 24, 25, 26, 27]
    assert decontaminate.contaminated(df.limit(0), bf).count() == 0 and decontaminate.contaminated(df, bf.limit(0)).count() == 0


def test_stages_decide_by_row_not_by_key(spark, frame):
    """Rows that share a key, or have none, are kept or dropped each for its own text."""
    a, b, c, d, item = prose(80), prose(80), prose(80), prose(80), prose(40)
    rows = [(1, a), (2, a), (2, b), (3, c), (3, d), (None, prose(80)), (None, prose(80)), (None, d)]
    df = frame(rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(df).collect()), key=repr) == sorted([*rows[:1], *rows[2:7]], key=repr)
    dirty = [(None, item + " " + a), (4, item + " " + b)]
    clean = [(None, c), (4, d), (5, a)]
    left = decontaminate.clean(frame(dirty + clean, "doc_id long, text string"), frame([(1, item)], "item_id long, text string"))
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(clean, key=repr)
    same = frame([(7, prose(20), "s") for _ in range(40)] + [(None, prose(20), "t") for _ in range(40)], "doc_id long, text string, source string")
    want = mixing.mix(same).selectExpr("sum(copies) n").first().n
    assert mixing.mixed_documents(same).count() == want < 80 * 3


def test_masks_lose_no_overlap():
    """Whichever fifth of a stretch is substituted, some mask finds all its tokens intact in it."""
    for n in range(decontaminate.WHOLE, 21):
        masks = decontaminate.MASKS if n >= decontaminate.LONG else decontaminate.SHORT_MASKS
        for changed in itertools.combinations(range(n), n - -(-4 * n // 5)):
            assert any(not {s + p for p in m} & {*changed} for m in masks for s in range(n - m[-1])), (n, changed)


def test_op9_finds_all_that_brute_force_finds(spark, frame):
    """Substituted passages of items of every length, at the edges of texts and beside each other."""
    words, bench, docs = VOCABULARY[:60], [], []
    for n in [*range(1, 23), 30, 45]:
        bench.append((n, " ".join(rng.choices(words, k=n))))
        for share in (0, 0.1, 0.2, 0.3):
            said = bench[-1][1].split()
            for i in rng.sample(range(n), int(share * n)):
                said[i] = "other"
            lead = rng.choices(words, k=rng.choice([0, 0, 3]))
            docs.append((len(docs), " ".join([*lead, *said[rng.choice([0, 0, n // 6]) :], *rng.choices(words, k=rng.choice([0, 4]))])))

    def overlaps(h, b):
        w = min(20, len(b))
        for s in range(1 - len(b), len(h)):
            same = [0 <= s + j < len(h) and h[s + j] == x for j, x in enumerate(b)]
            if any(sum(same[k : k + w]) >= 0.8 * w for k in range(len(b) - w + 1)):
                return True
        return False

    df, bf = frame(docs, "doc_id long, text string"), frame(bench, "item_id long, text string")
    for options in ({}, {"broadcast_seeds": 0}, {"least": 1}):
        want = {(i, tuple(k for k, b in bench if k >= options.get("least", 5) and overlaps(t.split(), b.split()))) for i, t in docs}
        got = {(r.doc_id, tuple(r["items"])) for r in decontaminate.contaminated(df, bf, **options).collect()}
        assert got == {x for x in want if x[1]}


def test_items_that_are_not_searched_are_told(spark, frame):
    bench = frame([(1, "one two three four"), (2, "aa bb cc dd ee"), (3, None)], "item_id long, text string")
    assert sorted(map(tuple, decontaminate.unsearched(bench).collect())) == [(1, 4), (3, 0)]
    docs = frame([(9, "zero one two three four")], "doc_id long, text string")
    assert decontaminate.contaminated(docs, bench).count() == 0
    assert [list(r["items"]) for r in decontaminate.contaminated(docs, bench, least=1).collect()] == [[1]]
    with pytest.raises(ValueError):
        decontaminate.contaminated(docs, bench, agree=0.7)
