"""Periodic runs against comparing every word with every later one."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factspan.llm import runs


def brute(w, least=12):
    seen, out = set(), []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcde"), min_size=1, max_size=30), st.integers(1, 6)), max_size=8))
def test_runs_of_repeated_blocks(blocks):
    w = [x for block, times in blocks for x in block * times]
    assert runs.word_runs(w) == brute(w)


@pytest.mark.parametrize("kind", range(4))
def test_runs_of_hard_sequences(kind):
    rng = random.Random(kind)
    for _ in range(60):
        if kind == 0:
            w = [rng.choice("ab") for _ in range(rng.randint(0, 200))]
        elif kind == 1:  # Fibonacci words have runs of many periods over one another
            a, b = "a", "b"
            for _ in range(rng.randint(3, 11)):
                a, b = a + b, a
            w = list(a)
            w[rng.randrange(len(w))] = "c"
        elif kind == 2:
            w = ["x"] * rng.randint(0, 300) + ["y"] + ["x"] * rng.randint(0, 300)
        else:  # long periods, past several levels of lags, with a broken last one
            b = [str(rng.randrange(1000)) for _ in range(rng.randint(1, 300))]
            w = [str(k) for k in range(30)] + b * rng.randint(2, 4) + b[: rng.randint(0, len(b))] + [str(k) for k in range(30)]
        assert runs.word_runs(w) == brute(w)


def test_segments_split_until_no_word_is_alone():
    w = list("abcabcabcabc") + ["once"] + list("defgdefgdefg") + ["a"] + list("hihihihihihi")
    codes = [sorted(set(w)).index(x) for x in w]
    found = runs.segments(runs.np.array(codes), 12)
    # the second "a" is alone after the first split and splits again
    assert found == [(0, 12), (13, 25), (26, 38)]


def planted(doc_id, text):
    w = runs._WORDS(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(doc_id, text):
    w = planted(doc_id, text)
    found = brute(w)
    top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_op11_on_any_rows(spark, frame):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "one", "a " * 500, " x y " * 9, ("line of seven words that comes again\n") * 40, "Ünï cödé 😀 " * 30]
    texts += [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 400))) for _ in range(150)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(7, texts[7]), (None, "b b " * 20), (-5, texts[40])]
    df = frame(rows, "doc_id long, text string").selectExpr("*", "'x' as runs", "1 as _w", "2 as _id", "'y' as collapsed")
    got = sorted(map(tuple, runs.op11(df).collect()), key=repr)
    assert got == sorted((expected(*r) for r in rows), key=repr)
    assert any(r[1] and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in got)
    assert runs.op11(df.limit(0)).count() == 0


def test_a_very_long_text_is_scanned_whole(spark, frame):
    tail = ["p", "q", "r"] * 100
    text = " ".join([str(k) for k in range(200_000)] + tail)
    row = runs.periodic_runs(frame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(200_000, 300, 3)] and row.collapsed.endswith("199999 p q r") and row.n_words == 200_300
    assert runs.word_runs(["z"] * 100_000) == [(0, 100_000, 1)]
