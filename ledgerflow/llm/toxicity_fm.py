"""Toxicity by a factorization machine over hashed terms.

Terms are runs of letters and digits, lower-cased, and their beginnings of four to
six bytes (stems, in languages that inflect), hashed; a text is the set of its terms. Beside a weight each term has a vector, and every pair
of terms adds the product of theirs, so that an insult together with the mention of a
group can weigh more than either alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import wordhash as W
from .labelled import held_out, sample

SAMPLE, BITS, FACTORS, LEAST, EPOCHS, BATCH, RATE = 12_000, 30, 8, 15, 8, 256, 0.05
STEMS, SURE = (4, 5, 6), 6.0
BLOCK = 1024  # columns of a block of pairs


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text, one after another, and where each text's begin."""
    flat, count = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for a, z, data, at in W.slices(column):
        w = W.words(data, at, W.NOT_ALNUM, lower=True)
        doc = np.repeat(np.arange(z - a), np.diff(w.bounds))
        both = [doc << BITS | (w.hash >> np.uint64(64 - BITS)).astype(np.int64)]
        low = W.LOWER[data].astype(np.uint64) + np.uint64(1)
        for size in STEMS:
            long = np.flatnonzero(w.end - w.start > size)
            stem = np.zeros(len(long), np.uint64)
            for k in range(size):
                stem = stem << np.uint64(9) | low[w.start[long] + k]
            both.append(doc[long] << BITS | (W.mix(stem + np.uint64(size)) >> np.uint64(64 - BITS)).astype(np.int64))
        both = np.unique(np.concatenate(both))
        flat.append(both & ((1 << BITS) - 1))
        count.append(np.bincount(both >> BITS, minlength=z - a))
    return np.concatenate(flat), np.cumsum(np.concatenate(count))


@dataclass
class Machine:
    base: float
    term: np.ndarray  # sorted hashes of the terms that it knows
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, flat: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(first) - 1
        if not len(self.term) or not len(flat):
            return np.full(n, self.base)
        at = np.minimum(np.searchsorted(self.term, flat), len(self.term) - 1)
        known = self.term[at] == flat
        doc, at = np.repeat(np.arange(n), np.diff(first))[known], at[known]
        out = self.base + np.bincount(doc, self.weight[at], n)
        for k in range(self.factor.shape[1]):
            v = self.factor[at, k]
            out += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*terms(column)), -40, 40)))


@dataclass
class Screen:
    """The columns of a 0/1 matrix of texts and terms, texts of one label first, to be multiplied in pairs of blocks."""

    edge: np.ndarray  # where each column's rows begin
    row: np.ndarray
    expected: np.ndarray  # of the label, by text
    have: int  # texts of the label
    least: float

    def blocks(self) -> int:
        return -(-(len(self.edge) - 1) // BLOCK)

    def pairs(self) -> int:
        return self.blocks() * (self.blocks() + 1) // 2

    def dense(self, k: int) -> np.ndarray:
        x = np.zeros((len(self.expected), BLOCK), np.float32)
        edge = self.edge[k * BLOCK:(k + 1) * BLOCK + 1]
        x[self.row[edge[0]:edge[-1]], np.repeat(np.arange(len(edge) - 1), np.diff(edge))] = 1
        return x

    def sure(self, numbers: range) -> Iterator[np.ndarray]:
        """The columns that are in a sure pair, of some pairs of blocks by number."""
        ends = np.cumsum(np.arange(self.blocks(), 0, -1))
        held, x = -1, np.zeros(0)
        for number in numbers:
            k = int(np.searchsorted(ends, number, "right"))
            m = self.blocks() - int(ends[k] - number)
            if k != held:
                held, x = k, self.dense(k)
                weighted = np.ascontiguousarray((x * self.expected[:, None]).T)
            z = self.dense(m) if m > k else x
            hit, want = x[:self.have].T @ z[:self.have], weighted @ z
            i, j = np.nonzero((hit >= self.least) & (hit > want))
            ok = (i < j) if m == k else slice(None)
            i, j = i[ok], j[ok]
            h, e = hit[i, j].astype(np.float64), want[i, j].astype(np.float64)
            ok = 2 * h * np.log(h / e) >= SURE ** 2  # it can't be more
            i, j, h, e = i[ok], j[ok], h[ok], e[ok]
            for q in range(0, len(i), 512):
                u, v, hq, eq = i[q:q + 512], j[q:q + 512], h[q:q + 512], e[q:q + 512]
                rest = (x[self.have:, u] * z[self.have:, v]).sum(0, dtype=np.float64)
                ratio = 2 * (hq * np.log(hq / eq) + rest * np.log(np.maximum(rest, 1e-9) / np.maximum(hq + rest - eq, 1e-9)))
                sure = ratio >= SURE ** 2
                if sure.any():
                    yield np.unique(np.concatenate([k * BLOCK + u[sure], m * BLOCK + v[sure]]))


def _here(screen: Screen) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *screen.sure(range(screen.pairs()))])


def on_spark(spark: SparkSession) -> Callable[[Screen], np.ndarray]:
    """Screens pairs of blocks in tasks; what is broadcast, the sample's terms, is bounded by the sample."""
    def run(screen: Screen) -> np.ndarray:
        n = screen.pairs()
        if not n:
            return np.zeros(0, np.int64)
        held = spark.sparkContext.broadcast(screen)

        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own = b.column(0).to_numpy()
                if len(own):
                    for cols in held.value.sure(range(int(own[0]), int(own[-1]) + 1)):
                        yield pa.RecordBatch.from_arrays([pa.array(cols)], names=["c"])

        rows = spark.range(0, n, 1, min(n, 48)).mapInArrow(some, "c long").distinct().collect()  # terms of the sample
        held.unpersist()
        return np.array(sorted(r[0] for r in rows), np.int64)
    return run


def paired(at: np.ndarray, doc: np.ndarray, y: np.ndarray, n: int, raw: np.ndarray, run: Callable[[Screen], np.ndarray] = _here) -> np.ndarray:
    """Whether each of ``n`` terms is in a pair whose texts have one label surely more often than ``raw`` and the
    whole's share say: a likelihood ratio of ``SURE`` squared. No pair is left out: one that reaches it needs
    ``least`` texts of that label, so do both its terms."""
    found, count = np.zeros(n, bool), np.bincount(at, minlength=n)
    ones = np.bincount(at[y[doc] == 1], minlength=n)
    texts = np.random.default_rng(1).integers(1, 1 << 62, len(y))
    mark = np.zeros(n, np.int64)
    np.add.at(mark, at, texts[doc])
    _, first, same = np.unique(mark, return_index=True, return_inverse=True)  # terms of the same texts are one
    for label in (1, 0):
        share = y.mean() if label else 1 - y.mean()
        least = SURE ** 2 / (-2 * np.log(share))
        own = (ones if label else count - ones)[first]
        who = np.flatnonzero(own >= least)
        expected = np.maximum(1 / (1 + np.exp(-np.clip(raw if label else -raw, -40, 40))), share).astype(np.float32)
        rows = np.argsort(y != label, kind="stable")
        place = np.empty(len(y), np.int32)
        place[rows] = np.arange(len(y), dtype=np.int32)
        col = np.full(n, -1, np.int32)
        col[first[who]] = np.arange(len(who), dtype=np.int32)
        keep = col[at] >= 0
        c, d = col[at[keep]], place[doc[keep]]
        order = np.argsort(c, kind="stable")
        edge = np.concatenate([[0], np.cumsum(np.bincount(c, minlength=len(who)))])
        cols = run(Screen(edge, d[order], expected[rows], int((y == label).sum()), float(least)))
        found[first[who[cols]]] = True
    return found[first][same]


def fit(flat: np.ndarray, first: np.ndarray, y: np.ndarray, least: int = LEAST, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 3, run: Callable[[Screen], np.ndarray] = _here) -> Machine:
    """Adaptive gradient descent on the log loss.

    First of terms whose share of label 1 surely differs from the whole's, by ``SURE`` standard deviations in
    ``least`` texts or more or by a likelihood ratio in any number: the small weights of thousands of common words would else outweigh a
    telling few. Then, if there are pairs of any terms whose labels that leaves surely unexplained, again with their
    terms, which may tell nothing alone. With no rows or one class only, the machine is a constant.
    """
    p = (y.sum() + 0.5) / (len(y) + 1.0)
    term, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    at = at.astype(np.int32)
    doc = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(first))
    ones = np.bincount(at[y[doc] == 1], minlength=len(term))
    if not len(y) or y.min() == y.max():
        return _descend(term[:0], flat, first, y, factors, epochs, seed)
    alone = (n >= least) & (np.abs(ones - n * p) >= SURE * np.sqrt(n * p * (1 - p)))
    rest = n - ones
    alone |= 2 * (ones * np.log(np.maximum(ones, 1) / (n * p)) + rest * np.log(np.maximum(rest, 1) / (n * (1 - p)))) >= SURE ** 2
    machine = _descend(term[alone], flat, first, y, factors, epochs, seed)
    raw = [machine.raw(flat[first[k]:first[min(k + 1024, len(y))]], first[k:k + 1025] - first[k]) for k in range(0, len(y), 1024)]
    together = paired(at, doc, y, len(term), np.concatenate(raw), run)
    if not (together & ~alone).any():
        return machine
    return _descend(term[alone | together], flat, first, y, factors, epochs, seed)


def _descend(term: np.ndarray, flat: np.ndarray, first: np.ndarray, y: np.ndarray, factors: int, epochs: int, seed: int) -> Machine:
    """A machine of the given terms."""
    p = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(p / (1 - p)))
    if not len(term):
        return Machine(base, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)))
    rng = np.random.default_rng(seed)
    at = np.minimum(np.searchsorted(term, flat), len(term) - 1)
    known = term[at] == flat
    doc = np.repeat(np.arange(len(y)), np.diff(first))[known]
    at = at[known]
    begin = np.searchsorted(doc, np.arange(len(y) + 1))
    w, v = np.zeros(len(term), np.float32), rng.normal(0, 0.01, (len(term), factors)).astype(np.float32)
    gw, gv, g0 = np.full(len(term), 1e-6, np.float32), np.full(v.shape, 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), BATCH):
            rows = order[k:k + BATCH]
            size = begin[rows + 1] - begin[rows]
            own = np.concatenate([at[begin[r]:begin[r + 1]] for r in rows])
            if not len(own):
                continue
            of = np.repeat(np.arange(len(rows)), size)
            seen = np.zeros(len(term), bool)
            seen[own] = True
            used = np.flatnonzero(seen)
            col = (np.cumsum(seen) - 1)[own]
            x = np.zeros((len(rows), len(used)), np.float32)
            x[of, col] = 1
            vs = v[used]
            s = x @ vs
            z = np.float32(base) + x @ w[used] + 0.5 * ((s * s).sum(1) - x @ (vs * vs).sum(1))
            err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[rows]).astype(np.float32)
            m = len(rows)
            dw = x.T @ err / m + 1e-4 * w[used]
            dv = (x.T @ (err[:, None] * s) - (x.T @ err)[:, None] * vs) / m + 1e-3 * vs
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= RATE * 4 * dw / np.sqrt(gw[used])
            v[used] -= RATE * dv / np.sqrt(gv[used])
            d0 = float(err.mean())
            g0 += d0 * d0
            base -= RATE * d0 / np.sqrt(g0)
    return Machine(float(base), term, w, v)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = SAMPLE, id: str = "doc_id", text: str = "text") -> Machine:
    """Learns from about ``most`` labelled rows at most (documented bound), none held out."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, first = terms(b.column(0))
            sums = np.concatenate([[0], np.cumsum(W.mix(flat.astype(np.uint64)))])
            mark = (sums[first[1:]] - sums[first[:-1]]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat, pa.int32())), b.column(1), pa.array(mark)], names=["x", "y", "mark"])

    # by label and a hash of the terms, so that the order, and the machine, don't hang on the partitions
    got = sample(docs, labels, label, most, id, text).mapInArrow(own, "x array<int>, y int, mark long").sort("y", "mark").toArrow()
    y = got["y"].to_numpy().astype(np.float64)
    flat = np.concatenate([np.zeros(0, np.int32), *[c.flatten().to_numpy() for c in got["x"].chunks]])
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *[pc.list_value_length(c).to_numpy() for c in got["x"].chunks]]))]).astype(np.int64)
    del got
    return fit(flat, first, y, run=on_spark(docs.sparkSession))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    The score reads nothing but the whole text; null counts as empty, and an empty
    text has a score too. Repeated rows are scored each. Without labels of both kinds the
    score is a constant. An empty table gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id=id, text=text))

    @F.arrow_udf("double")
    def score(t: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(t))

    return docs.select(F.col(id), held_out(id).alias("held_out"), score(text).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
