"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting: each round gives every feature in turn a shallow tree fitted to
what is left to explain, at a small rate. Summed up, a feature's trees
are one look-up table over its bins; pairs of features that still explain
most get tables over both their bins in the same way. A score adds
up one entry of each table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .labelled import held_out, sample

SAMPLE, ROUNDS, PAIRS, PAIR_ROUNDS, BINS, PAIR_BINS, RATE = 20_000, 150, 6, 60, 64, 12, 0.1
_KIND = np.zeros(256, np.int64)  # classes of bytes
for _k, _of in enumerate((range(97, 123), range(65, 91), range(48, 58), b" ", b"\n", b".,", b"!?", b"|<>{}[]\\/_=", b"#$%&*@^~+", b"'\"():;-`", range(128, 256)), 1):
    _KIND[list(_of)] = _k
_KINDS = 12
FEATURES = ("log_bytes", "log_words", "word_length", "long_words", "lower", "upper", "digits", "newlines", "stops", "shouts", "bars", "symbols", "marks", "non_ascii", "other",
            "distinct_words", "same_as_before", "top_word", "distinct_pairs", "line_words", "same_lines", "upper_words", "symbol_words")


def features(column: pa.Array) -> np.ndarray:
    """A row of numbers for each text, from its whole."""
    out = [np.zeros((0, len(FEATURES)))]
    for a, z, data, at in W.slices(column):
        w = W.words(data, at)
        n = z - a
        size, count = np.diff(at), np.diff(w.bounds)
        doc = np.repeat(np.arange(n), count)
        kind = np.bincount(np.repeat(np.arange(n), size) * _KINDS + _KIND[data], minlength=n * _KINDS).reshape(n, _KINDS)
        share = kind / np.maximum(size, 1)[:, None]
        words = np.maximum(count, 1)
        length = w.end - w.start

        def per(x, doc=doc, n=n):
            return np.bincount(doc, x, n)

        order = np.lexsort([w.hash, doc])
        h, d = w.hash[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        runs = np.diff(np.append(np.flatnonzero(new), len(h)))
        top = np.zeros(n)
        np.maximum.at(top, d[new], runs)
        before = np.zeros(len(doc), bool)
        before[1:] = (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])
        g, _, first = w.grams(2)
        gd = np.repeat(np.arange(n), np.diff(first))
        order = np.lexsort([g, gd])
        g, gd2 = g[order], gd[order]
        fresh = np.ones(len(g), bool)
        fresh[1:] = (g[1:] != g[:-1]) | (gd2[1:] != gd2[:-1])
        lines = kind[:, 5] + 1
        # lines by their first and last word
        starts = np.ones(len(doc), bool)
        starts[1:] = (doc[1:] != doc[:-1]) | (data[np.maximum(w.start[1:] - 1, 0)] == 10)
        s = np.flatnonzero(starts)
        line = W.spans(w.hash, 0x9FB21C651E98DF25, s, np.append(s[1:], len(doc))) if len(s) else np.zeros(0, np.uint64)
        ld = doc[s]
        order = np.lexsort([line, ld])
        x, xd = line[order], ld[order]
        again = np.zeros(len(x), bool)
        again[1:] = (x[1:] == x[:-1]) & (xd[1:] == xd[:-1])
        first_kind, last_kind = _KIND[data[w.start]], _KIND[data[w.end - 1]]
        out.append(np.column_stack([
            np.log1p(size), np.log1p(count), per(length) / words, per(length > 20) / words, share[:, 1], share[:, 2], share[:, 3], share[:, 5], share[:, 6], share[:, 7], share[:, 8],
            share[:, 9], share[:, 10], share[:, 11], share[:, 0], np.bincount(d[new], minlength=n) / words, per(before) / words, top / words,
            np.bincount(gd2[fresh], minlength=n) / np.maximum(np.diff(first), 1), count / lines, np.bincount(xd[again], minlength=n) / np.maximum(np.bincount(ld, minlength=n), 1),
            per((first_kind == 2) & (last_kind != 1)) / words, per((last_kind == 9) | (last_kind == 7) | (last_kind == 8)) / words]))
    return np.concatenate(out)


@dataclass
class Gam:
    """Edges of each feature's bins, a table each; the same for pairs."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += t[np.searchsorted(e, x[:, k], "right")]
        bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.coarse)]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values of a tree over ordered bins with sums g of gradients and h of curvatures."""
    if depth and len(g) > 1:
        a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(a, b) + _gain(g.sum() - a, h.sum() - b)
        k = int(gain.argmax()) + 1
        if gain[k - 1] > _gain(g.sum(), h.sum()) + 1e-9:
            return np.concatenate([_tree(g[:k], h[:k], depth - 1), _tree(g[k:], h[k:], depth - 1)])
    return np.full(len(g), g.sum() / (h.sum() + 1.0))


def _square(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values of the best cut of both features' bins into four parts, and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    parts = [(cg, ch), (cg[-1:, :] - cg, ch[-1:, :] - ch), (cg[:, -1:] - cg, ch[:, -1:] - ch)]
    parts.append((tg - sum(p[0] for p in parts), th - sum(p[1] for p in parts)))
    gain = sum(_gain(x, np.maximum(y, 0)) for x, y in parts)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out = np.empty_like(g)
    cut = ((slice(None, i + 1), slice(None, j + 1)), (slice(i + 1, None), slice(None, j + 1)), (slice(None, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(j + 1, None)))
    for at in cut:
        out[at] = g[at].sum() / (h[at].sum() + 1.0)
    return out, float(gain.max() - _gain(tg, th))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS, pair_rounds: int = PAIR_ROUNDS) -> Gam:
    """With no rows or one class only, the model is a constant."""
    width = x.shape[1]
    p = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(p / (1 - p)))
    edges = [_edges(x[:, k], BINS) if len(x) else np.zeros(0) for k in range(width)]
    coarse = [_edges(x[:, k], PAIR_BINS) if len(x) else np.zeros(0) for k in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    if not len(y) or y.min() == y.max():
        return Gam(base, edges, tables, [], coarse, [])
    bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)]
    total = np.full(len(y), base)

    def left() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-total))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for k in range(width):
            g, h = left()
            step = RATE * _tree(np.bincount(bins[k], g, len(tables[k])), np.bincount(bins[k], h, len(tables[k])))
            tables[k] += step
            total += step[bins[k]]
    two = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(coarse)]

    def sums(i: int, j: int, v: np.ndarray) -> np.ndarray:
        n, m = len(coarse[i]) + 1, len(coarse[j]) + 1
        return np.bincount(two[i] * m + two[j], v, n * m).reshape(n, m)

    g, h = left()
    ranked = sorted(((_square(sums(i, j, g), sums(i, j, h))[1], i, j) for i in range(width) for j in range(i)), reverse=True)[:pairs]
    chosen = [(i, j) for _, i, j in ranked]
    pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in chosen]
    for _ in range(pair_rounds):
        for t, (i, j) in zip(pair_tables, chosen, strict=True):
            g, h = left()
            step = RATE * _square(sums(i, j, g), sums(i, j, h))[0]
            t += step
            total += step[two[i], two[j]]
    return Gam(base, edges, tables, chosen, coarse, pair_tables)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE, id: str = "doc_id", text: str = "text") -> Gam:
    """Learns from about ``most`` labelled rows at most (documented bound), none held out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(b.column(0)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel())), b.column(1)], names=["x", "y"])

    got = sample(docs, labels, label, most, id, text).mapInArrow(run, "x array<float>, y int").toArrow().combine_chunks()
    x = np.concatenate([c.flatten().to_numpy() for c in got["x"].chunks] or [np.zeros(0)]).reshape(-1, len(FEATURES)).astype(np.float64)
    y = got["y"].to_numpy().astype(np.float64)
    order = np.lexsort([*x.T, y])  # the same model whatever order the rows came in
    return fit(x[order], y[order])


def scorer(docs: DataFrame, model: Gam):
    """A function of a text column to its score. Null counts as empty; an empty text has a score too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(features(text)))

    return lambda c: score(c if isinstance(c, Column) else F.col(c))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    The score reads nothing but the whole text. Repeated rows are scored each. Without
    labels of both kinds the score is a constant. An empty table gives an empty
    result; other columns are not read.
    """
    score = scorer(docs, train(docs, labels, id=id, text=text))
    return docs.select(F.col(id), held_out(id).alias("held_out"), score(text).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
