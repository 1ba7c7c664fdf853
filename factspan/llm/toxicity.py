"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its own embedding (words of the training sample that occur in two documents or
more; all others share one) beside its characters: the embeddings of its 3- to 5-grams, of which
each component's maximum passes. Digits in words are read ("k1ll"); numbers and signs by themselves are not. Runs of over ``LETTERS`` letters (scripts without spaces) are read
in pieces that overlap by ``LAP``, to their end. A text is read in windows of ``WINDOW`` words, each overlapping
the next by ``WINDOW - STRIDE``, to its end; a window goes through a forward and a backward gated recurrent layer, attention weighs their states, and
the pooled state gives the window's probability. The text's score is its most toxic window's.

Training is multiple-instance: only texts have labels, so each epoch the best window of a toxic
text and the worst of the others' windows are what the network learns from. The embeddings'
first component starts at the log-odds of word or gram between toxic and other texts. At most
``positives`` and ``negatives`` labelled documents of ``longest`` bytes are fetched, one row for each id, all three
bounds; the rest of the work, over all whole texts, runs where the texts lie. In it, each distinct word of a batch
passes the input layer once, and all windows of many texts step through the network together.

Nulls: a null text is the empty text and is scored as one empty window. Long texts have as many
windows as it takes; they are scored whole. An empty table gives an empty result. Rows without a label
are not learned from; of several labels of one document the largest counts. Without labels of
both classes every score is the smoothed share of label 1. Repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspan.llm.quality import held_out, labelled

WINDOW, STRIDE = 32, 16
#: Letters of a word, and by how many the pieces of a longer run overlap.
LETTERS, LAP = 40, 20
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION, GRAMS = 8, 8, 8, 8, 1 << 16
#: Words are runs of letters and digits with a letter among them.
_WORDS = re.compile(r"[^\W_]*[^\W\d_][^\W_]*").findall
_KEPT = 100_000


def words(text: str | None) -> list[str]:
    """The words of a text in order; runs of more than ``LETTERS`` letters as overlapping pieces, each a word."""
    found = _WORDS((text or "").lower())
    if max(map(len, found), default=0) <= LETTERS:
        return found
    return [w[k : k + LETTERS] for w in found for k in range(0, max(1, len(w) - LAP), LETTERS - LAP)]


def grams(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 3- to 5-grams of words, and the word that each belongs to, word by word."""
    raw = np.frombuffer("\0".join(["<" + w + ">" for w in vocabulary]).encode(), np.uint8).astype(np.uint32)
    owner = np.cumsum(raw == 0)
    at, of = [], []
    for n in (3, 4, 5):
        if len(raw) < n:
            continue
        mixed = np.full(len(raw) - n + 1, n, np.uint32)
        for k in range(n):
            mixed = (mixed * np.uint32(0x01000193)) ^ (raw[k : len(raw) - n + 1 + k] * np.uint32(0x9E3779B1))
        inside = (owner[n - 1 :] == owner[: len(mixed)]) & (raw[: len(mixed)] != 0)
        at.append((mixed ^ (mixed >> np.uint32(15)))[inside] % GRAMS)
        of.append(owner[: len(mixed)][inside])
    order = np.argsort(np.concatenate(of), kind="stable")
    return np.concatenate(at)[order].astype(np.int32), np.concatenate(of)[order].astype(np.int32)


def windows(ids: np.ndarray) -> np.ndarray:
    """All windows over one text's word ids, as rows padded with -1."""
    n = max(1, -(-(len(ids) - WINDOW) // STRIDE) + 1)
    padded = np.full((n - 1) * STRIDE + WINDOW, -1, np.int32)
    padded[: len(ids)] = ids
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    def __init__(self, vocabulary: list[str], odds: np.ndarray, gram_odds: np.ndarray, seed: int = 7, kind=np.float32):
        rng, d = np.random.default_rng(seed), WORD_DIM + CHAR_DIM
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(kind)
        self.index = {w: i + 1 for i, w in enumerate(vocabulary)}
        word = (0.1 * rng.standard_normal((len(vocabulary) + 1, WORD_DIM))).astype(kind)
        word[1:, 0] = odds
        char = (0.1 * rng.standard_normal((GRAMS, CHAR_DIM))).astype(kind)
        char[:, 0] = gram_odds
        self.p = {"word": word, "char": char}
        for side in "fb":
            self.p |= {f"W{side}": init(d, 3 * HIDDEN), f"U{side}": init(HIDDEN, 3 * HIDDEN), f"b{side}": np.zeros(3 * HIDDEN, kind)}
        self.p |= {"A": init(2 * HIDDEN, ATTENTION), "v": init(ATTENTION, 1)[:, 0], "o": init(2 * HIDDEN, 1)[:, 0], "c": np.zeros(1, kind)}

    def inputs(self, vocabulary: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Word ids, grams and input rows of distinct words."""
        ids = np.array([self.index.get(w, 0) for w in vocabulary], np.int64)
        if not vocabulary:
            return ids, (ids, ids), np.zeros((0, WORD_DIM + CHAR_DIM), self.p["word"].dtype)
        at, of = grams(vocabulary)
        begin = np.searchsorted(of, np.arange(len(vocabulary)))
        return ids, (at, of), np.concatenate([self.p["word"][ids], np.maximum.reduceat(self.p["char"][at], begin, axis=0)], axis=1)

    def _layer(self, side: str, pre: np.ndarray, at: np.ndarray, keep: list | None):
        """States of one direction: (steps, windows, HIDDEN). pre: input rows times W, plus b."""
        u, n = self.p[f"U{side}"], len(at)
        h, out = np.zeros((n, HIDDEN), pre.dtype), np.empty((WINDOW, n, HIDDEN), pre.dtype)
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            x, hu, live = pre[at[:, t]], h @ u, (at[:, t] >= 0)[:, None]
            gates = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN] * live, gates[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, c, hu[:, 2 * HIDDEN :], live))
            h = h + z * (c - h)
            out[t] = h
        return out

    def _pool(self, states: np.ndarray, at: np.ndarray):
        a = np.tanh(states @ self.p["A"])
        e = np.where(at.T >= 0, a @ self.p["v"], -30)
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        pooled = (w[:, :, None] * states).sum(0)
        return a, w, pooled, pooled @ self.p["o"] + self.p["c"]

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Input rows through both directions' input layers; the last row stands for padding."""
        x = np.concatenate([x, np.zeros((1, x.shape[1]), x.dtype)])
        return {s: x @ self.p[f"W{s}"] + self.p[f"b{s}"] for s in "fb"}

    def projected(self, vocabulary: list[str], step: int = 20_000) -> dict[str, np.ndarray]:
        """``project`` of many words, a part at a time."""
        parts = [self.project(self.inputs(vocabulary[k : k + step])[2]) for k in range(0, max(1, len(vocabulary)), step)]
        return {s: np.concatenate([*(p[s][:-1] for p in parts), parts[-1][s][-1:]]) for s in "fb"}

    def logits(self, pre: dict[str, np.ndarray], at: np.ndarray, step: int = 4096) -> np.ndarray:
        """The logit of each window (rows of ``at`` index the projected words)."""
        out = []
        for k in range(0, len(at), step):
            part = at[k : k + step]
            out.append(self._pool(np.concatenate([self._layer(s, pre[s], part, None) for s in "fb"], axis=2), part)[3])
        return np.concatenate(out)

    def _both(self, pre: dict[str, np.ndarray], at: np.ndarray):
        """States of both directions, (steps, windows, 2 * HIDDEN), and what their gradients need, by step and direction."""
        n, kind = len(at), pre["f"].dtype
        u = np.stack([self.p["Uf"], self.p["Ub"]])
        rows = np.stack([at.T, at.T[::-1]], axis=1)  # step, direction, window: the backward layer reads from the end
        x, live = np.stack([pre["f"][rows[:, 0]], pre["b"][rows[:, 1]]], axis=1), (rows >= 0)[..., None]
        h, keep = np.zeros((2, n, HIDDEN), kind), [np.empty((WINDOW, 2, n, HIDDEN), kind) for _ in range(6)]
        for t in range(WINDOW):
            hu = h @ u
            gates = _sigmoid(x[t, :, :, : 2 * HIDDEN] + hu[:, :, : 2 * HIDDEN])
            z, r, hc = gates[:, :, :HIDDEN] * live[t], gates[:, :, HIDDEN:], hu[:, :, 2 * HIDDEN :]
            c = np.tanh(x[t, :, :, 2 * HIDDEN :] + r * hc)
            for held, v in zip(keep, (h, z, r, c, hc), strict=False):
                held[t] = v
            h = h + z * (c - h)
            keep[5][t] = h
        states = keep[5]
        return np.concatenate([states[:, 0], states[::-1, 1]], axis=2), keep[:5], u, live

    def gradients(self, ids, of_words, x, at, y, once: bool = False):
        """Mean logistic loss of windows ``at`` with labels ``y``, and its gradient. ``once``: no gram is twice in a word."""
        p, pre = self.p, self.project(x)
        states, (hs, zs, rs, cs, hcs), u, live = self._both(pre, at)
        a, w, pooled, logit = self._pool(states, at)
        q = _sigmoid(logit)
        loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
        d = ((q - y) / len(y)).astype(x.dtype)
        g = {"o": pooled.T @ d, "c": d.sum(keepdims=True)}
        dpool = d[:, None] * p["o"]
        dw = (states * dpool).sum(2)
        de = w * (dw - (w * dw).sum(0))
        da = (de[:, :, None] * p["v"]) * (1 - a * a)
        g["v"], g["A"] = (a * de[:, :, None]).sum((0, 1)), np.tensordot(states, da, ([0, 1], [0, 1]))
        dstates = w[:, :, None] * dpool + da @ p["A"].T
        dstates = np.stack([dstates[:, :, :HIDDEN], dstates[::-1, :, HIDDEN:]], axis=1)
        back, dh = u.transpose(0, 2, 1), np.zeros((2, len(at), HIDDEN), x.dtype)
        pre_x, gu = np.empty((WINDOW, 2, len(at), 3 * HIDDEN), x.dtype), np.zeros_like(u)
        for t in range(WINDOW - 1, -1, -1):
            h, z, r, c, hc = hs[t], zs[t], rs[t], cs[t], hcs[t]
            dh = dh + dstates[t]
            dc = dh * z * (1 - c * c)
            dz = dh * (c - h) * live[t] * (z * (1 - z))
            dr = dc * hc * r * (1 - r)
            pre_x[t] = np.concatenate([dz, dr, dc], axis=2)
            pre_h = np.concatenate([dz, dr, dc * r], axis=2)
            gu += h.transpose(0, 2, 1) @ pre_h
            dh = dh * (1 - z) + pre_h @ back
        # what all places of a word add up to: places sorted by word once, for both directions
        place = at.T.ravel()
        order = np.argsort(place, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(place[order]) != 0]))
        which = place[order][first]
        xs = np.concatenate([x, np.zeros((1, x.shape[1]), x.dtype)])
        dx = np.zeros((len(x) + 1, x.shape[1]), x.dtype)
        for k, side in enumerate("fb"):
            steps = pre_x[:, k] if k == 0 else pre_x[::-1, k]
            total = np.add.reduceat(steps.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
            g |= {f"W{side}": xs[which].T @ total, f"U{side}": gu[k], f"b{side}": total.sum(0)}
            dx[which] += total @ p[f"W{side}"].T
        dx = dx[:-1]
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], ids, dx[:, :WORD_DIM])
        gram, of = of_words
        if not once:
            pairs = np.unique(of.astype(np.int64) * GRAMS + gram)  # a gram counts once in a word
            of, gram = pairs // GRAMS, pairs % GRAMS
        top = (p["char"][gram] == x[of, WORD_DIM:]) * dx[of, WORD_DIM:]
        for k in range(CHAR_DIM):
            g["char"][:, k] = np.bincount(gram, top[:, k], GRAMS)
        return loss, g


def _ranges(begin: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The places from ``begin[i]`` to ``begin[i + 1]`` for every i picked, one after the other."""
    sizes = begin[picked + 1] - begin[picked]
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - begin[picked], sizes)


def _log_odds(counts: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """counts: (2, things) texts by label with the thing. What few texts say is mostly chance, and shrinks."""
    odds = np.log((counts[1] + 0.5) / (texts[1] + 1)) - np.log((counts[0] + 0.5) / (texts[0] + 1))
    return np.clip(odds, -3, 4) * np.minimum(1, counts.sum(0) / 8)


def _signature(ws: list[str]) -> int:
    """The least hash of the runs of five words: near copies mostly share it, other texts don't."""
    return min((crc32(" ".join(ws[i : i + 5]).encode()) for i in range(max(1, len(ws) - 4))), default=0)


def train(texts: list[str], labels: np.ndarray, epochs: int = 10, rate: float = 0.01, seed: int = 7, distinct_only: bool = True) -> Network | float:
    """A network, or the smoothed share of label 1 if there is nothing to tell apart."""
    labels = all_labels = np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        return float((labels.sum() + 1) / (len(labels) + 2))
    # copies of a text would make its own rare words look like evidence: one of them is enough
    place, placed, kept, seen = {}, [], [], set()
    for k, t in enumerate(texts):
        ws = words(t)
        if distinct_only and (mark := _signature(ws)) in seen:
            continue
        seen.add(mark if distinct_only else k)
        placed.append(np.fromiter((place.setdefault(w, len(place)) for w in ws), np.int32, len(ws)))
        kept.append(k)
    labels, distinct = labels[kept], list(place)
    if labels.min() == labels.max():
        return train(texts, all_labels, epochs, rate, seed, distinct_only=False)
    per_label = np.array([(labels == y).sum() for y in (0, 1)])
    word_counts, gram_counts = np.zeros((2, len(distinct) + 1)), np.zeros((2, GRAMS))
    gram, per_word = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for k in range(0, len(distinct), 20_000):  # a part at a time: sorting them takes several times their size
        at, of = grams(distinct[k : k + 20_000])
        gram.append(at)
        per_word.append(np.bincount(of, minlength=len(distinct[k : k + 20_000])))
    gram, begin = np.concatenate(gram), np.concatenate([[0], np.cumsum(np.concatenate(per_word))])
    pairs = np.sort(np.repeat(np.arange(len(distinct)), np.diff(begin)) * GRAMS + gram)
    pairs = pairs[np.diff(pairs, prepend=-1) != 0]  # a gram once in a word
    gram, begin = (pairs % GRAMS).astype(np.int32), np.searchsorted(pairs // GRAMS, np.arange(len(distinct) + 1))
    for ids, y in zip(placed, labels.astype(int), strict=True):
        own = np.flatnonzero(np.bincount(ids, minlength=1))
        word_counts[y, own] += 1
        held = np.zeros(GRAMS, bool)
        held[gram[_ranges(begin, own)]] = True
        gram_counts[y] += held
    odds, gram_odds = _log_odds(word_counts, per_label), _log_odds(gram_counts, per_label)
    common = np.flatnonzero(word_counts.sum(0) > 1)
    net = Network([distinct[i] for i in common], odds[common], gram_odds, seed)
    net.p["char"][gram_counts.sum(0) == 0] = 0  # grams that were never seen say nothing
    of_word = odds.copy()
    if distinct:
        of_word[:-1] = np.maximum(odds[:-1], np.maximum.reduceat(gram_odds[gram], begin[:-1]))
    wins = [windows(ids) for ids in placed]
    sizes = np.array([len(w) for w in wins])
    at, owner, starts = np.concatenate(wins), np.repeat(np.arange(len(wins)), sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    word_of, sizes_of = np.array([net.index.get(w, 0) for w in distinct], np.int64), np.diff(begin)
    rng, moment, step = np.random.default_rng(seed), {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}, 0
    clean = labels == 0
    batch = int(np.clip((len(labels) + 3 * clean.sum()) / 48, 16, 256))
    for epoch in range(epochs):
        if epoch % 2 == 0 or epoch > 6:
            value = np.where(at >= 0, of_word[at], -9).max(1) if epoch == 0 else net.logits(net.projected(distinct), at, 1024)
        order = np.lexsort((-value, owner))  # each text's windows, the most toxic first
        best, other = order[starts], starts + (rng.random(len(starts)) * sizes).astype(int)
        worst = [order[starts + np.minimum(k, sizes - 1)][clean] for k in (1, 2)]
        chosen = np.concatenate([best, *worst, other[clean]])
        target = np.concatenate([labels, np.zeros(3 * clean.sum())]).astype(np.float32)
        shuffled = rng.permutation(len(chosen))
        for k in range(0, len(shuffled), batch):
            pick = shuffled[k : k + batch]
            rows = at[chosen[pick]]
            used, local = np.unique(rows, return_inverse=True)
            local = local.reshape(rows.shape) - (1 if used[0] == -1 else 0)
            used = used[used >= 0]
            if not len(used):
                continue
            of, own = np.repeat(np.arange(len(used)), sizes_of[used]), gram[_ranges(begin, used)]
            starts_at = np.cumsum(sizes_of[used]) - sizes_of[used]
            x = np.concatenate([net.p["word"][word_of[used]], np.maximum.reduceat(net.p["char"][own], starts_at, axis=0)], axis=1)
            _, g = net.gradients(word_of[used], (own, of), x, local, target[pick], once=True)
            step += 1
            now = rate * (1 - epoch / epochs) + 1e-4
            for name, d in g.items():
                mean, square = moment[name]
                mean *= 0.9
                mean += 0.1 * d
                square *= 0.999
                d *= d
                square += 0.001 * d
                np.sqrt(square / (1 - 0.999**step), out=d)
                d += 1e-7
                np.divide(mean, d, out=d)
                d *= now / (1 - 0.9**step)
                net.p[name] -= d
    return net


class Scorer:
    """Scores texts; keeps the projected input rows of up to ``_KEPT`` distinct words."""

    def __init__(self, net: Network):
        self.net, self.place, self.pre = net, {}, net.project(np.zeros((0, WORD_DIM + CHAR_DIM), np.float32))

    def _placed(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.place) > _KEPT:
            self.__init__(self.net)
        place = self.place
        new = list(dict.fromkeys(w for ws in texts for w in set(ws) if w not in place))
        if new:
            place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
            more = self.net.project(self.net.inputs(new)[2])
            self.pre = {s: np.concatenate([self.pre[s][:-1], more[s]]) for s in "fb"}
        return [np.fromiter(map(place.__getitem__, ws), np.int32, len(ws)) for ws in texts]

    def score(self, texts: list[str | None], group: int = 150_000) -> np.ndarray:
        """The score of each text; texts go through together until they have ``group`` words."""
        out, held, size = [], [], 0
        for k, t in enumerate(texts):
            held.append(words(t))
            size += len(held[-1])
            if size >= group or k == len(texts) - 1:
                wins = [windows(i) for i in self._placed(held)]
                logits = self.net.logits(self.pre, np.concatenate(wins))
                out.append(np.maximum.reduceat(logits, np.concatenate([[0], np.cumsum([len(w) for w in wins])[:-1]])))
                held, size = [], 0
        return _sigmoid(np.concatenate(out).astype(float)) if out else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 3, fold: int = 1, positives: int = 1500, negatives: int = 2000, longest: int = 200_000) -> Network | float:
    """A network from about ``positives`` toxic and ``negatives`` other labelled documents at most, of ``longest`` bytes each at most."""
    known = labelled(labels, key, label, folds, fold)
    n = {r._y: r["count"] for r in known.groupBy("_y").count().collect()}
    part = lambda bound, y: int(min(1.0, bound / max(1, n.get(y, 0))) * (1 << 20))
    picked = known.where(F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 20)) < F.when(F.col("_y") == 1, part(positives, 1)).otherwise(part(negatives, 0)))
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).where(F.coalesce(F.octet_length("_text"), F.lit(0)) <= longest).join(F.broadcast(picked), "_id")
    rows = rows.groupBy("_id").agg(F.min("_text").alias("_text"), F.first("_y").alias("_y")).collect()  # repeated rows are one
    rows.sort(key=lambda r: (r._id, r._text or ""))
    return train([r._text for r in rows], np.array([r._y for r in rows]))


def score(docs: DataFrame, net: Network | float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if isinstance(net, float) else Scorer(net)
        for b in batches:
            s = scorer.score(b.column(1).to_pylist()) if scorer else np.full(len(b), net)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["_id", "score"])

    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", key)


def op10(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id"), 3, 1), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
