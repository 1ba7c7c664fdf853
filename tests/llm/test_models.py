"""Quality and toxicity: gradients, held-out accuracy, edge cases; and the pipeline as a whole."""

import random
import zlib

import numpy as np
import pytest

from factspan.llm import quality, toxicity

rng = random.Random(11)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(300)]
prose = lambda n: ". ".join(" ".join(rng.choices(VOCABULARY, k=9)) for _ in range(n // 9 + 1))
junk = lambda n: " ".join(w + rng.choice(["!!", "$$$", "###"]) for w in rng.choices(VOCABULARY[:20], k=n)).upper()


def test_features_of_any_text():
    for t in (None, "", " ", "a", "é" * 50_000, "word " * 50_000, "\n\n"):
        f = quality.features(t)
        assert len(f) == len(quality.FEATURES) and np.isfinite(f).all()


def test_trees_find_the_cut():
    g, h = np.array([-5.0, -5, -5, 5, 5]), np.full(5, 4.0)
    leaf = quality._cut(g, h, cuts=1)
    assert (leaf[:3] < 0).all() and (leaf[3:] > 0).all()
    grid = np.zeros((4, 4))
    grid[2:, 2:] = 9
    gain, table = quality._quadrants(grid, np.ones((4, 4)))
    assert gain > 0 and table[3, 3] > 1 and abs(table[0, 0]) < 1e-9


def test_pairs_catch_what_single_features_can_not():
    x = np.random.default_rng(0).random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    one = quality.AdditiveModel().fit(x, y, pairs=0)
    two = quality.AdditiveModel().fit(x, y)
    right = lambda m: ((m.score(x) > 0.5) == (y > 0.5)).mean()
    assert right(one) < 0.65 and right(two) > 0.9


def test_op8(spark, frame):
    docs = [(i, prose(120) if i % 4 else junk(120)) for i in range(400)] + [(500, None), (501, ""), (None, prose(9)), (1, prose(60))]
    df = frame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "'en' as lang")
    labels = frame([(i, int(i % 4 > 0)) for i in range(0, 400, 2)] + [(1, None), (None, 1), (4, 0)], "doc_id long, quality int")
    got = quality.op8(df, labels).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == (r.doc_id % 4 > 0) for r in got if r.doc_id is not None and r.doc_id < 400 and r.held_out]) > 0.95
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.where("doc_id between 100 and 399").collect()} == {i for i in range(100, 400) if i % 4}
    none = quality.op8(df, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.op8(df.limit(0), labels).count() == 0


def test_gradients():
    words = ["aa", "bb", "cc", "zz", "longer"]
    net = toxicity.Network(words[:3], np.zeros(3), np.random.default_rng(1).standard_normal(toxicity.GRAMS), kind=np.float64)
    g = np.random.default_rng(0)
    at = g.integers(-1, 5, (4, toxicity.WINDOW))
    at[:, :3] = abs(at[:, :3])
    y = np.array([1.0, 0, 1, 0])
    loss = lambda: net.gradients(*net.inputs(words), at, y)
    _, grad = loss()
    for name, d in grad.items():
        where = np.argwhere(np.abs(d) > 1e-9)
        for i in map(tuple, where[:: max(1, len(where) // 3)][:3]):
            v, e = net.p[name], 1e-5
            keep = v[i]
            v[i] = keep + e
            up = loss()[0]
            v[i] = keep - e
            down = loss()[0]
            v[i] = keep
            assert d[i] == pytest.approx((up - down) / 2 / e, rel=1e-3, abs=1e-8), name


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 56, 57, 1000])
def test_windows_cover_every_word_and_overlap(n):
    w = toxicity.windows(np.arange(n))
    assert set(w[w >= 0]) == set(range(n)) and w.shape[1] == toxicity.WINDOW
    for a, b in zip(w[:-1], w[1:], strict=True):
        assert len(set(a[a >= 0]) & set(b[b >= 0])) == toxicity.WINDOW - toxicity.STRIDE


def test_long_runs_are_read_to_their_end():
    """Whatever stands in a run without spaces lies whole in one of its pieces."""
    for n in (40, 41, 60, 61, 1000):
        run = "".join(rng.choices("abcdefgh", k=n))
        pieces = toxicity.words(run)
        assert all(len(w) <= toxicity.LETTERS for w in pieces) and all(any(run[k : k + 20] in w for w in pieces) for k in range(n - 19))
    long = ["x" * 60 + "tail", "x" * 60 + "last"]
    at, of = toxicity.grams(long)
    assert set(at[of == 0]) != set(at[of == 1])
    assert toxicity.STRIDE <= toxicity.WINDOW // 2


def test_one_row_of_a_picked_id_is_fetched(spark, frame, monkeypatch):
    fetched = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: fetched.append(len(texts)) or 0.5)
    docs = frame([(1, prose(9)) for _ in range(200)] + [(i, prose(9)) for i in range(2, 30)], "doc_id long, text string")
    labels = frame([(i, i % 2, i % 2) for i in range(1, 30)], "doc_id long, toxic int, quality int")
    toxicity.fit(docs, labels, folds=1000)
    assert fetched and fetched[0] <= 29
    toxicity.fit(docs.selectExpr("doc_id", "if(doc_id = 5, repeat(text, 1000), text) text"), labels, folds=1000, longest=10_000)
    assert fetched.pop() == fetched[0] - 1
    monkeypatch.setattr(quality.AdditiveModel, "fit", lambda self, x, y: fetched.append(len(x)) or self)
    quality.fit(docs, labels, folds=1000)
    assert fetched[1] <= 29


def insult(text):
    ws = text.split()
    for _ in range(2):
        ws.insert(rng.randrange(len(ws)), rng.choice(["zkrut", "vompal", "grox" + rng.choice(VOCABULARY)]))
    return " ".join(ws)


def test_op10(spark, frame):
    docs = [(i, insult(prose(80)) if i % 3 == 0 else prose(80)) for i in range(450)]
    docs += [(1000, prose(4000) + " zkrut vompal groxab"), (1001, None), (1002, ""), (1003, "12 34 !!"), (None, "zkrut"), (0, docs[0][1])]
    df = frame(docs, "doc_id long, text string").selectExpr("*", "1 as score")
    labels = frame([(i, int(i % 3 == 0)) for i in range(450)] + [(1, None)], "doc_id long, toxic int")
    got = toxicity.op10(df, labels).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    tested = [(r.predicted, int(r.doc_id % 3 == 0)) for r in got if r.doc_id is not None and r.doc_id < 450 and r.held_out]
    assert np.mean([a == b for a, b in tested]) > 0.93
    by = {r.doc_id: r.predicted for r in got}
    assert by[1000] == 1 and by[1001] == by[1002] == by[1003] == 0
    assert {r.score for r in toxicity.op10(df, labels.limit(0)).collect()} == {0.5}
    assert toxicity.op10(df.limit(0), labels).count() == 0


def test_quality_scores_by_hand():
    """The sum of one looked-up value per feature and pair, for each row by itself."""
    g = np.random.default_rng(2)
    x = g.random((500, 4))
    model = quality.AdditiveModel().fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float), rounds=20)
    bin_of = lambda edges, v: sum(v >= e for e in edges)
    for row, got in zip(x[:50], model.score(x[:50])):
        total = model.base + sum(t[bin_of(e, v)] for e, t, v in zip(model.edges, model.tables, row))
        total += sum(t[bin_of(ei, row[i])][bin_of(ej, row[j])] for i, j, ei, ej, t in model.pairs)
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_toxicity_scores_by_hand():
    """One word after the other through both layers, attention over their states, the largest window counts."""
    g = np.random.default_rng(4)
    net = toxicity.Network(VOCABULARY[:50], g.standard_normal(50), g.standard_normal(toxicity.GRAMS), kind=np.float64)
    sig, p, h = lambda v: 1 / (1 + np.exp(-v)), net.p, toxicity.HIDDEN
    texts = [prose(n) for n in (3, 40, 100)] + [""]

    def of_word(w):
        at, _ = toxicity.grams([w])
        return np.concatenate([p["word"][net.index.get(w, 0)], p["char"][at].max(0)])

    def window(ws):
        states = {}
        for side in "fb":
            now, states[side] = np.zeros(h), []
            for w in ws if side == "f" else ws[::-1]:
                i, r = of_word(w) @ p[f"W{side}"] + p[f"b{side}"], now @ p[f"U{side}"]
                z, reset = sig(i[:h] + r[:h]), sig(i[h : 2 * h] + r[h : 2 * h])
                now = now + z * (np.tanh(i[2 * h :] + reset * r[2 * h :]) - now)
                states[side].append(now)
        both = np.concatenate([states["f"], states["b"][::-1]], axis=1)
        e = np.exp(np.tanh(both @ p["A"]) @ p["v"])
        return (e / e.sum()) @ both @ p["o"] + p["c"][0]

    got = toxicity.Scorer(net).score(texts)
    for t, s in zip(texts[:3], got):
        ws = toxicity.words(t)
        starts = range(0, max(1, len(ws) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        assert s == pytest.approx(sig(max(window(ws[k : k + toxicity.WINDOW]) for k in starts)), rel=1e-4)


def test_stages_take_any_rows(spark, tmp_path, frame):
    """Nulls, empty and repeated rows, ties, clashing names and empty tables go through every stage."""
    import corpus_pipeline

    text = [prose(40) for _ in range(6)]
    docs = [(i, text[i % 6], "en", "s", 1) for i in range(24)] + [(None, None, None, None, None), (None, text[0], None, "s", 0), (1, "", "en", None, 0), (1, text[1], "en", "s", 1), (2, "w " * 30_000, "en", "t", 5)]
    df = frame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *[f"{k} as {c}" for k, c in enumerate(("id", "_key", "_text", "_row", "size", "copies", "fp", "node", "_uid", "_at"))])
    frame([(i, 1, 0) for i in range(9)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame([(1, prose(30)), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        assert out.columns[: len(df.columns)] == df.columns, name
        assert {r.doc_id for r in out.select("doc_id").collect()} <= {r[0] for r in docs}, name
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0, name
    kept = corpus_pipeline.STAGES[1][1](spark, df, str(tmp_path)).collect()
    assert len({r.text for r in kept}) == len(kept)


def test_pipeline(spark, tmp_path, frame):
    import corpus_pipeline

    docs = [(i, prose(150), "en", "s" if i % 2 else "t", 1) for i in range(200)]
    docs += [(300 + i, docs[i][1], "en", "s", 1) for i in range(20)] + [(400 + i, junk(100), "en", "t", 1) for i in range(60)]
    item = prose(45)
    docs += [(500 + i, prose(60) + " " + item + " " + prose(30), "de", "u", 1) for i in range(5)]
    frame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    frame([(i, int(not 400 <= i < 460)) for i, *_ in docs if i % 3 or i >= 400], "doc_id long, quality int").selectExpr("*", "0 as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    frame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    d, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        d = stage(spark, d, str(tmp_path))
        d.write.parquet(f"{tmp_path}/out{k}")
        d = spark.read.parquet(f"{tmp_path}/out{k}")
        seen.append([r.doc_id for r in d.select("doc_id").collect()])
        assert k == len(corpus_pipeline.STAGES) - 1 or d.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good = set(range(200)) | set(range(300, 320)) | set(range(500, 505))
    assert set(seen[0]) == good
    assert set(seen[1]) == good - set(range(300, 320)) and len(seen[1]) == len(set(seen[1]))
    assert set(seen[2]) == set(range(200))
    assert set(seen[3]) <= set(seen[2]) and max(np.unique(seen[3], return_counts=True)[1]) <= 3
    assert sorted(seen[4]) == sorted(seen[3]) and {"shard", "slot"} <= set(d.columns)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()) == sorted(seen[4])


def test_digits_in_words_reach_the_network():
    assert toxicity.words("K1ll 100% !!! a_b é😀 2nd") == ["k1ll", "a", "b", "é", "2nd"]
    net = toxicity.Network(["k1ll"], np.array([2.0]), np.zeros(toxicity.GRAMS))
    ids, (grams, of), _ = net.inputs(["k1ll", "kill"])
    assert ids.tolist() == [1, 0] and set(grams[of == 0]) != set(grams[of == 1])


def test_places_of_ranges():
    begin = np.array([0, 3, 3, 7, 9])
    assert toxicity._ranges(begin, np.array([2, 0, 1, 3])).tolist() == [3, 4, 5, 6, 0, 1, 2, 7, 8]
    assert toxicity._ranges(begin, np.array([], int)).tolist() == []
