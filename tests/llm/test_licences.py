"""License scans against every clause at every place."""

import random
import re

import pytest

from factspan.llm import licences
from factspan.llm.licences import TEMPLATES, Clause


def brute(text, templates=TEMPLATES, agree=0.8):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    out = []
    for c in templates:
        n, least = len(c.words), len(c.words) - int(len(c.words) * (1 - agree) + 1e-9)
        for s in range(-n, len(w)):
            same = [0 <= s + j < len(w) and w[s + j] == x for j, x in enumerate(c.words)]
            if sum(same) >= least and all(a or not m for a, m in zip(same, c.must, strict=True)):
                out.append((s, c.label, c.base, sum(same) / n))
    return len(w), sorted(out)


def texts():
    rng = random.Random(3)
    out = [None, "", " .,- ", "CC BY", "cc-by cc_by CC.BY 4.0", "cc by" * 2, "İ general PUBLIC lİcense", "all rights\nreserved, all rights reserved", "by cc", "général public license é", "license " * 3000]
    for c in TEMPLATES:
        out += [c.text, c.text.upper()]
        for _ in range(6):  # substitutions, cut ends, doubled words
            w = c.words
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(["x", "the", "license", "public"])
            out.append(" ".join(rng.choice([w, w[1:], w[:-1], w + w]) + rng.choice([[], ["cc", "by"], ["general", "public", "license"] * 2])))
    return out


@pytest.mark.parametrize("agree", [1.0, 0.8, 0.5])
def test_places_are_all_places(spark, frame, agree):
    rows = list(enumerate(texts())) + [(None, "CC BY"), (3, "CC BY")]
    df = frame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as _w", "3 as label", "4 as places")
    got = sorted(((r.doc_id, r.n_words, sorted(map(tuple, r.places))) for r in licences.scan(df, agree=agree).collect()), key=repr)
    assert got == sorted(((k, *brute(t, agree=agree)) for k, t in rows), key=repr)
    assert licences.scan(df.limit(0)).count() == 0


def test_op12(spark, frame):
    rows = list(enumerate(texts())) + [(None, "cc by"), (4, "")]
    want = []
    for k, t in rows:
        n, places = brute(t)
        base = [p for p in places if p[2]]
        joined = lambda ps: ",".join(sorted({p[1] for p in ps}))
        want.append((k, n, len(base), min((p[0] for p in base), default=None), max((p[0] for p in base), default=None), joined(base), joined(places), max((p[3] for p in places), default=0.0)))
    got = sorted(map(tuple, licences.op12(frame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted(want, key=repr)


def test_the_rarest_words_are_looked_up(spark, frame):
    df = frame([(k, "the license of the land") for k in range(5)] + [(9, "granted the license"), (10, "fee")], "doc_id long, text string")
    t = (Clause("x", "the license [fee] granted of"),)
    rows = licences.index(df, "text", t, 0.8).collect()
    assert [(r.word, r["at"], list(r.before)) for r in sorted(rows, key=lambda r: len(r.before))] == [("fee", 2, []), ("granted", 3, [2])]
    assert [p.share for r in licences.scan(frame([(1, "a license fee granted of")], "doc_id long, text string"), templates=t).collect() for p in r.places] == [0.8]
    with pytest.raises(ValueError):
        licences.scan(df, templates=(Clause("x", "no key phrase"),))


def test_a_long_text_and_a_frequent_word(spark, frame):
    text = "word " * 50_000 + "license " * 5_000 + "Licensed under CC BY-NC 4.0."
    r = licences.op12(frame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_words, r.n_base, r.first_word, r.labels, r.score) == (55_007, 1, 55_002, "cc-by,cc-by-nc", 1.0)
