"""Quality classifier: a generalised additive model with pairwise interactions.

Features are read from the text alone (shape of words, lines, characters). Each feature is cut
into quantile bins; boosting goes round the features in turn and fits a tree of at most two
cuts to the gradient, which only ever changes that feature's table of bin values. Then the
pairs of features whose coarse grids explain most of what is left get tables of their own, by
the same cyclic boosting with one cut on each axis. A score is the logistic of the sum of one
looked-up value per feature and pair: whole batches are scored by vectorised additions.

Training needs ``sample`` labelled documents at most (a bound, not a share): a hash of the id
picks them, Spark reads their texts and computes the features, and the driver receives a row of
``len(FEATURES)`` numbers each. Scoring reads every whole text, where the text lies.

Nulls: a null text is the empty text; rows without a label, or whose label is null, are not
learned from; if several labels name one document the largest counts. Without labels, or with
one class only, every score is the smoothed share of label 1. Repeated rows are scored each. Long
texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = (
    "log_words", "word_length", "short_words", "long_words", "distinct_words", "upper", "digits", "symbols", "stops",
    "bangs", "bars", "line_length", "repeated_lines", "symbol_words", "spaces",
)
_UPPER, _LOWER, _DIGIT, _SYMBOL, _STOP, _SPACE = range(6)
_KIND = np.zeros((6, 256))
_KIND[_UPPER, 65:91] = _KIND[_LOWER, 97:123] = _KIND[_DIGIT, 48:58] = 1
_KIND[_SYMBOL, [ord(c) for c in "#$%&*+<=>@[\\]^_`{|}~"]] = _KIND[_STOP, [ord(c) for c in ".,;:?"]] = 1
_KIND[_SPACE, [9, 10, 11, 12, 13, 32]] = 1


def features(text: str | None) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``."""
    raw = (text or "").encode()
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digit, symbol, stop, space = (_KIND @ seen).tolist()
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = [x for x in raw.split(b"\n") if x]
    ends = np.fromiter((w[-1] for w in words), np.uint8, len(words)) if words else np.zeros(0, np.uint8)
    return [
        np.log1p(len(words)), lengths.mean(), (lengths <= 3).mean(), (lengths > 12).mean(), len(set(words)) / n ** 0.9,
        upper / max(1.0, upper + lower), digit / size, symbol / size, stop / n, seen[33] / n, seen[124] / n,
        np.log1p(size / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), _KIND[_SYMBOL][ends].sum() / n, space / size,
    ]


def _cut(grad: np.ndarray, hess: np.ndarray, cuts: int = 2, ridge: float = 1.0) -> np.ndarray:
    """Leaf values of the tree over ordered bins that is best grown by ``cuts`` cuts."""
    edges, g, h = [0, len(grad)], np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    for _ in range(cuts):
        best, at = 1e-9, None
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            gl, hl, gr, hr = g[k] - g[a], h[k] - h[a], g[b] - g[k], h[b] - h[k]
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
            if gain.max() > best:
                best, at = gain.max(), int(k[gain.argmax()])
        if at is None:
            break
        edges = sorted([*edges, at])
    out = np.zeros(len(grad))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """The best tree with one cut on each axis of a grid: its gain and leaf values."""
    cg, ch = np.zeros((2, *(np.array(g.shape) + 1)))
    cg[1:, 1:], ch[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    leaf = lambda c: (c[1:-1, 1:-1], c[1:-1, -1:] - c[1:-1, 1:-1], c[-1:, 1:-1] - c[1:-1, 1:-1], c[-1, -1] - c[1:-1, -1:] - c[-1:, 1:-1] + c[1:-1, 1:-1])
    gains = sum(x**2 / (y + ridge) for x, y in zip(leaf(cg), leaf(ch), strict=True))
    if not gains.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + ridge)
    return float(gains.max() - g.sum() ** 2 / (h.sum() + ridge)), out


class AdditiveModel:
    """Tables of bin values by feature and by pair of features; a plain set of arrays."""

    def __init__(self, base: float = 0.0):
        self.base, self.edges, self.tables, self.pairs = base, [], [], []

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        b = self.bins(x)
        for f, t in enumerate(self.tables):
            total += t[b[f]]
        for i, j, ei, ej, t in self.pairs:
            total += t[np.searchsorted(ei, x[:, i], "right"), np.searchsorted(ej, x[:, j], "right")]
        return 1 / (1 + np.exp(-total))

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, bins: int = 32, pairs: int = 6, grid: int = 8):
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        if len(y) == 0 or y.min() == y.max():
            return self
        cuts = lambda v, n: np.unique(np.quantile(v, np.linspace(0, 1, n + 1)[1:-1]))
        self.edges = [cuts(x[:, f], bins) for f in range(x.shape[1])]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        b, total = self.bins(x), np.full(len(y), self.base)
        for _ in range(rounds):
            for f, t in enumerate(self.tables):
                p = 1 / (1 + np.exp(-total))
                step = rate * _cut(np.bincount(b[f], y - p, len(t)), np.bincount(b[f], p * (1 - p), len(t)))
                t += step
                total += step[b[f]]
        coarse = [cuts(x[:, f], grid) for f in range(x.shape[1])]
        cb = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]

        def sums(i, j):
            p, shape = 1 / (1 + np.exp(-total)), (len(coarse[i]) + 1, len(coarse[j]) + 1)
            at = cb[i] * shape[1] + cb[j]
            return at, *(np.bincount(at, w, shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p)))

        ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda ij: -_quadrants(*sums(*ij)[1:])[0])
        self.pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for i, j in ranked[:pairs]]
        for _ in range(rounds // 2):
            for i, j, _ei, _ej, t in self.pairs:
                at, g, h = sums(i, j)
                step = rate * _quadrants(g, h)[1]
                t += step
                total += step.ravel()[at]
        return self


def held_out(key: Column, folds: int, fold: int) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % folds == fold


def labelled(labels: DataFrame, key: str, label: str, folds: int, fold: int) -> DataFrame:
    """(_id, _y) of the rows that may be learned from."""
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key), folds, fold))
    return rows.groupBy(F.col(key).alias("_id")).agg(F.max(label).cast("int").alias("_y"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5, fold: int = 0, sample: int = 20_000) -> AdditiveModel:
    """A model from at most about ``sample`` labelled documents outside of the held-out fold."""
    known = labelled(labels, key, label, folds, fold)
    share = min(1.0, sample / max(1, known.count()))
    picked = known.where(F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked), "_id")
    texts = texts.groupBy("_id").agg(F.min("_text").alias("_text"), F.first("_y").alias("_y"))  # repeated rows are one

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([features(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), x, b.column(2)], names=["_id", "x", "y"])

    rows = texts.select("_id", "_text", "_y").mapInArrow(run, f"_id {kind}, x array<double>, y int").collect()
    rows.sort(key=lambda r: (r._id, r.x))
    return AdditiveModel().fit(np.array([r.x for r in rows]).reshape(-1, len(FEATURES)), np.array([r.y for r in rows], float))


def score(docs: DataFrame, model: AdditiveModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in b.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["_id", "score"])

    return docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", key)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose score is below ``threshold``; rows stay where they lie."""
    model, at = fit(docs, labels, text=text, **options), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in b.column(at).to_pylist()]).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(model.score(x) >= threshold))

    columns = docs.columns
    spare = docs.toDF(*[f"c{i}" for i in range(len(columns))])  # clashing names don't matter to Arrow
    return spare.mapInArrow(run, spare.schema).toDF(*columns)


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id"), 5, 0), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
