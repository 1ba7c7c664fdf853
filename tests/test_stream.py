"""Streams of files, and names in texts against searching for each."""

import hashlib
import random

import pytest

from factspan.operators import names
from factspan.sources import stream


def test_digests_and_prefixes(spark, tmp_path):
    rng = random.Random(1)
    held = {f"f{k}.bin": rng.randbytes(n) for k, n in enumerate((2, 1, 8, 100_000, 3_000_001))}
    for name, data in held.items():
        (tmp_path / name).write_bytes(data)
    for chunk in (1 << 12, stream.CHUNK):
        got = {r.path.split("/")[-1]: (r.byte_size, r.content_hash) for r in stream.digests(spark, str(tmp_path), chunk).collect()}
        assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in held.items()}
    heads = {r.path.split("/")[-1]: (r.byte_size, bytes(r.prefix)) for r in stream.prefixes(spark, str(tmp_path), 5000).collect()}
    assert heads == {n: (len(d), d[:5000]) for n, d in held.items()}
    (tmp_path / "empty").write_bytes(b"")
    assert stream.digests(spark, f"{tmp_path}/empty").count() == 0
    data = held["f3.bin"]
    stream.verify(spark, f"{tmp_path}/f3.bin", hashlib.sha256(data).hexdigest(), len(data))
    for bad in ((hashlib.sha256(b"").hexdigest(), len(data)), (hashlib.sha256(data).hexdigest(), 1)):
        with pytest.raises(ValueError):
            stream.verify(spark, f"{tmp_path}/f3.bin", *bad)


def test_probes_see_bytes_not_characters(spark, tmp_path):
    (tmp_path / "a").write_text('{"é": 1, "APN": 2}')
    probes = lambda n: stream.prefixes(spark, f"{tmp_path}/a", n)
    assert [r.has for r in probes(100).select(stream.has_bytes("prefix", '"APN"').alias("has")).collect()] == [True]
    assert [r.has for r in probes(14).select(stream.has_bytes("prefix", '"APN"').alias("has")).collect()] == [False]
    # a prefix that ends inside of a character
    assert [tuple(r) for r in probes(3).select(stream.has_bytes("prefix", "é").alias("e"), stream.has_bytes("prefix", '{"').alias("o")).collect()] == [(False, True)]


def test_names_equal_searching_for_each(spark, frame):
    rng = random.Random(2)
    listed = ["a", "aa", "ana", "banana", "é", "😀b", "nab"]
    texts = [(k, "".join(rng.choice(["a", "n", "b", "é", "😀", " "]) for _ in range(rng.randint(0, 300)))) for k in range(60)] + [(None, "aaa"), (7, "aa"), (8, None), (9, "b" * 50_000 + "ana")]
    got = sorted(map(tuple, names.occurrences(frame(texts, "id long, t string"), frame([(n,) for n in [*listed, "a", None]], "name string"), "id", "t").collect()), key=repr)
    want = [(k, n, i) for k, t in texts for n in listed for i in range(len(t or "")) if t.startswith(n, i)]
    assert got == sorted(want, key=repr)
    few = frame([("a",), ("b",)], "name string")
    with pytest.raises(ValueError):
        names.occurrences(frame(texts, "id long, t string"), few, "id", "t", most=1)
    assert names.occurrences(frame(texts, "id long, t string"), few.limit(0), "id", "t").count() == 0
