"""Periodic runs of words: recursive frequency splitting, then a scan of lags.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) that
has at least ``least`` words and two periods and that no neighbouring word extends. Each word of
a run therefore occurs at least twice in it, so:

1. A word that occurs fewer than two times in its segment belongs to no run of that segment and
   splits it. Segments are counted again after each split, until none of them changes; those of
   fewer than ``least`` words go. Most prose is gone after a few rounds.
2. The segments that are left are scanned lag by lag, shorter ones first: for each lag, the
   stretches of words that agree with the word one lag on. Lags under ``DENSE`` are compared word
   by word. A run of a longer period has as many agreements in a row as the period is long, so
   of the lags from g to 2g it holds a whole block of those that begin at multiples of g/2 and
   are g/2 long: blocks are compared, as hashes, with what lies g to 2g on, and every agreement
   is extended word by word to both sides. Nothing is lost by that, and a level of lags costs as
   many comparisons as the segment has words, so a text of n words costs about n log n.
3. A stretch whose bounds a shorter period had already is that run. Agreements that lie inside of
   a run whose period divides their lag are that run too, and aren't extended.

How it runs: each text is a row, read and scanned where it lies (Arrow batches, a few texts as
Python objects at a time); nothing is shuffled. A text is scanned whole, however long.

Nulls: a null text has no words. Empty and short texts have no runs and keep their words. Rows
that repeat or share a key are scanned each; a null key passes. An empty table gives an empty
result. Only the columns named are read, so columns of other names don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspan.llm.common import WORD, crc32_sql, parts

#: Lags that are compared word by word.
DENSE = 16
_WORDS = re.compile(WORD).findall
_MIX = np.uint64(0x9E3779B97F4A7C15)


def segments(codes: np.ndarray, least: int) -> list[tuple[int, int]]:
    """The stretches (start, end) that are left when no word of any of them is alone in it."""
    done, open_ = [], [(0, len(codes))]
    while open_:
        start, end = open_.pop()
        if end - start < least:
            continue
        _, word, count = np.unique(codes[start:end], return_inverse=True, return_counts=True)
        cuts = np.flatnonzero(count[word] < 2)
        if not len(cuts):
            done.append((start, end))
            continue
        edges = np.concatenate([[-1], cuts, [end - start]])
        wide = np.flatnonzero(np.diff(edges) > least)
        open_ += [(start + int(edges[k]) + 1, start + int(edges[k + 1])) for k in wide]
    return sorted(done)


def _stretches(same: np.ndarray) -> np.ndarray:
    """(start, end) rows of the stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    return edge.reshape(-1, 2)


def _reach(w: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on (backwards if ``step`` is -1) agree with the word ``lag`` on."""
    room, n, width = len(w) - lag - at if step > 0 else at + 1, 0, 32
    while n < room:
        width = min(width * 2, room - n)
        here = slice(at + n, at + n + width) if step > 0 else slice(at - n - width + 1, at - n + 1)
        off = np.flatnonzero(w[here] != w[here.start + lag : here.stop + lag])
        if len(off):
            return n + int(off[0] if step > 0 else width - 1 - off[-1])
        n += width
    return n


def _hashes(w: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words at each place; ``width`` is a power of two."""
    h, k = w.astype(np.uint64) * _MIX + _MIX, 1
    while k < width:
        h = (h[:-k] * _MIX ^ (h[:-k] >> np.uint64(29))) + h[k:]
        h ^= h >> np.uint64(32)
        k *= 2
    return h


def scan(w: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of one segment."""
    n, runs, bounds = len(w), [], set()

    def found(start: int, end: int, lag: int):
        if end - start >= max(least, 2 * lag) and (start, end) not in bounds:
            bounds.add((start, end))
            runs.append((start, end - start, lag))

    for lag in range(1, min(DENSE, n // 2 + 1)):
        for start, end in _stretches(w[:-lag] == w[lag:]):
            found(int(start), int(end) + lag, lag)
    g = DENSE
    while g <= n // 2:
        half = g // 2
        h = _hashes(w, half)
        most = min(2 * g, n // 2 + 1)  # lags from g to most - 1
        blocks = np.arange(0, len(h), half)
        blocks = blocks[blocks + g < len(h)]
        later = np.concatenate([h, np.zeros(most, np.uint64)])
        ahead = np.lib.stride_tricks.sliding_window_view(later, most - g)[blocks + g]
        hit, shift = np.nonzero(ahead == h[blocks][:, None])
        at, lag = blocks[hit], shift + g
        inside = at + lag + half <= n
        at, lag = at[inside], lag[inside]
        todo = np.ones(len(at), bool)

        def settle(start: int, length: int, period: int, at=at, lag=lag, todo=todo, half=half):
            """Agreements within a run whose period divides their lag need no look."""
            a, b = np.searchsorted(at, [start, start + length])
            todo[a:b] &= ~((lag[a:b] % period == 0) & (at[a:b] + lag[a:b] + half <= start + length))

        for r in runs:
            settle(*r)
        for k in np.argsort(lag, kind="stable"):
            if todo[k]:
                a, q = int(at[k]), int(lag[k])
                start = a - _reach(w, a - 1, q, -1) if a else 0
                end = a + _reach(w, a, q, 1)
                if end - start >= half:
                    before = len(runs)
                    found(start, end + q, q)
                    if len(runs) > before:
                        settle(*runs[-1])
                    lo, hi = np.searchsorted(at, [start, end])
                    todo[lo:hi] &= lag[lo:hi] != q
        g *= 2
    return runs


def word_runs(words: list[str], least: int = 12) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of a sequence of words, by start, then period."""
    if len(words) < least:
        return []
    place: dict[str, int] = {}
    codes = np.fromiter((place.setdefault(x, len(place)) for x in words), np.int64, len(words))
    return sorted(((s + a, n, q) for s, e in segments(codes, least) for a, n, q in scan(codes[s:e], least)), key=lambda r: (r[0], r[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without what repeats: of every run its first period stays, unless another run drops it."""
    if not runs:
        return " ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return " ".join(words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0))


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 12) -> DataFrame:
    """(key, n_words, runs, collapsed) for every row; runs: array of (start, length, period), by start, then period."""
    kind = docs.schema[key].dataType.simpleString()
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in parts(batch, 64):
                sizes, all_runs, kept = [], [], []
                for t in b.column(1).to_pylist():
                    words = _WORDS(t or "")
                    found = word_runs(words, least)
                    sizes.append(len(words))
                    all_runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                    kept.append(collapse(words, found))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(all_runs, run_type), pa.array(kept, pa.string())], names=["_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string").withColumnRenamed("_id", key)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) as the contract rewrites them: a tenth of the texts turn periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))
    rows = docs.select("doc_id", "text", h.alias("_h"), F.floor(h / 10).alias("_g"), F.when(h % 10 == 0, words).alias("_w"))
    n, g = F.size("_w").cast("long"), F.col("_g")
    a = (g % n).cast("int")
    period = F.lit(1) + F.floor((n - F.col("_a")) / (F.lit(3) + g % 8)).cast("int")
    rows = rows.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, period))
    again = F.transform("_w", lambda w, i: F.when(i < F.col("_a"), w).otherwise(F.get("_w", F.col("_a") + (i - F.col("_a")) % F.col("_p"))))
    return rows.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11(docs: DataFrame) -> DataFrame:
    """The contract's columns, from the runs and texts of the operator."""
    rows = periodic_runs(planted(docs))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return rows.withColumn("_top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_top.start")).alias("start"), F.col("_top.length").alias("length"), (-F.col("_top.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("_top.length") / -F.col("_top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


#: Without splitting and blocks: all pairs of equal six-word stretches of a text (a run has as many agreements in a row at least), gathered by lag.
ORACLE = rf"""
with d as (select row_number() over () rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w, {crc32_sql("doc_id")} h from documents),
e as (select *, len(w) n, h // 10 g, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end a from d),
p as (select rid, doc_id, case when a is null then w else list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) end w from e),
s as (select rid, unnest(range(len(w) - 5)) i, w from p where len(w) >= 12),
six as (select rid, i, hash(w[i + 1], w[i + 2], w[i + 3], w[i + 4], w[i + 5], w[i + 6]) x from s),
pair as (select l.rid, l.i, r.i - l.i q from six l join six r on l.rid = r.rid and l.x = r.x and r.i > l.i),
row as (select rid, q, i, i - row_number() over (partition by rid, q order by i) k from pair),
stretch as (select rid, q, min(i) s, count(*) + 5 + q as len from row group by rid, q, k having count(*) + 5 >= greatest(12 - q, q)),
run as (select rid, s, len, min(q) q from stretch group by rid, s, len),
runs as (select rid, count(*) n_runs, max({{'len': len, 's': -s, 'q': -q}}) top, string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) told, list({{'a': s + q, 'b': s + len}}) gone from run group by rid)
select doc_id, coalesce(n_runs, 0) as n_runs, -top.s as start, top.len as length, -top.q as period, cast(1000 * top.len // -top.q as bigint) as exponent_milli, sha256(coalesce(told, '')) as runs_sha256,
  sha256(array_to_string(case when gone is null then w else list_filter(w, lambda x, i: len(list_filter(gone, lambda r: i - 1 >= r.a and i - 1 < r.b)) = 0) end, ' ')) as collapsed_sha256
from p left join runs using (rid)
"""
