"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its
minimum and its maximum, so 128 hash evaluations make 256 values. 51 bands of
five values propose candidates (a pair of similarity 0.75 shares no band with
probability 1e-6). Documents that share band keys, directly or by way of
others, form a candidate cluster. Inside a cluster the full shingle sets are
compared block against block; a block pair returns the edges of a spanning
forest of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import NULL_ID, bitmap, components, cut, groups, in_bitmap, spanning

WORDS, PERMUTATIONS, BANDS, ROWS = 5, 128, 51, 5
BLOCK_MIN, BLOCK_MAX = 128, 2048
_rng = np.random.default_rng(0x6D696E6D6178)
_A = _rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)[:, None]
_C = _rng.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text, lower-cased A to Z."""
    for a, z, data, at in W.slices(column):
        w = W.words(data, at, lower=True)
        g, _, first = w.grams(WORDS)
        whole, _ = w.whole()
        n = np.diff(w.bounds)
        for i in range(z - a):
            if n[i] >= WORDS:
                yield a + i, np.unique(g[first[i]:first[i + 1]])
            else:
                yield a + i, whole[i:i + (n[i] > 0)]


def signature(s: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the upper 32 bits under each permutation."""
    low, high = np.full((PERMUTATIONS, 1), 2**32 - 1, np.uint32), np.zeros((PERMUTATIONS, 1), np.uint32)
    h = (s >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(h), 512):
        x = _A * h[None, k:k + 512] + _B
        np.minimum(low, x.min(1, keepdims=True), out=low)
        np.maximum(high, x.max(1, keepdims=True), out=high)
    return np.concatenate([low[:, 0], high[:, 0]]).astype(np.uint64)


def band_keys(sig: np.ndarray) -> np.ndarray:
    v = sig[:BANDS * ROWS].reshape(BANDS, ROWS)
    return W.mix((v * _C).sum(1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, h1, h2, keys, at = [], [], [], [], [0]
        for _, s in shingle_sets(b.column(1)):
            n.append(len(s))
            h1.append(W.mix(s + np.uint64(3)).sum(dtype=np.uint64))
            h2.append(W.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
            if len(s):
                keys.append(band_keys(signature(s)))
            at.append(at[-1] + BANDS * (len(s) > 0))
        flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(np.array(h1, np.uint64).view(np.int64)), pa.array(np.array(h2, np.uint64).view(np.int64)),
             pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))], names=["id", "n", "h1", "h2", "keys"])


def _links(a: list[np.ndarray], b: list[np.ndarray], same: bool) -> np.ndarray:
    """Which sets of a and b have 100 * intersection >= 75 * union; exact, by products of 0/1 matrices."""
    na, nb = (np.array([len(s) for s in x], np.int64) for x in (a, b))
    values = np.concatenate([*a, *b])
    row = np.repeat(np.arange(len(a) + len(b)), np.concatenate([na, nb]))
    u, col = np.unique(values, return_inverse=True)
    left = np.bincount(col[row < len(a)], minlength=len(u)) > 0
    right = np.bincount(col[row >= len(a)], minlength=len(u)) > 0
    common = left & right
    if same:
        common = np.bincount(col[row < len(a)], minlength=len(u)) > 1
    place = np.cumsum(common) - 1
    keep = common[col]
    row, col, width = row[keep], place[col[keep]], int(common.sum())
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    inter = np.zeros((len(a), len(b)))
    step = max(64, (8 << 20) // (len(a) + len(b)))
    for k in range(0, width, step):
        i, j = np.searchsorted(col, [k, k + step])
        m = np.zeros((len(a) + len(b), min(step, width - k)), np.float32)
        m[row[i:j], col[i:j] - k] = 1
        inter += m[:len(a)] @ m[len(a):].T
    if same:
        np.fill_diagonal(inter, 0)
    return 100 * inter >= 75 * (na[:, None] + nb[None, :] - inter)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (_, i, j), t in groups(batches, ["cluster", "i", "j"]):
        ids, blk = t["id"].to_numpy(), t["blk"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in t["s"].chunks for x in c]
        a, b = (np.flatnonzero(blk == k) for k in (i, j))
        if not len(a) or not len(b):
            continue
        x, y = [sets[k] for k in a], [sets[k] for k in b]
        e = spanning(_links(x, y, i == j), ids[a], ids[b])
        if e:
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in e], pa.int64()), pa.array([p[1] for p in e], pa.int64())], names=["u", "v"])


def minmax_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", bits: int = 26) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    A text's set holds its distinct shingles of five words (fewer words: the
    whole sequence); texts are linked from similarity 0.75 on. Null and empty
    texts, and those of separators only, have an empty set and no link. A null
    id orders first and comes back null. Rows with the same id are each judged
    by their own text. Other columns are not read. An empty table gives an
    empty result. ``bits``: size of the bitmap that keeps texts without
    candidates out of the verifying shuffle; it bounds the broadcast.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text).alias("text"))
    signed = cut(rows.mapInArrow(_sign, "id long, n long, h1 long, h2 long, keys array<long>"), "minmax")
    # documents with equal sets form a class; its smallest id stands for it
    reps = cut(signed.where("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("rep")), "reps")  # so that the join may split a large class
    member = cut(signed.join(reps, ["h1", "h2"], "left")
                 .select("id", "n", F.coalesce("rep", "id").alias("rep"), F.when(F.col("id") == F.col("rep"), F.col("keys")).alias("keys")), "class")
    keyed = member.where("keys is not null").select("id", F.explode("keys").alias("key"))
    shared = cut(keyed.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("key", "first"), "shared")
    edges = keyed.join(shared, "key").where("id <> first").select(F.col("id").alias("u"), F.col("first").alias("v"))
    clusters = cut(components(edges).select(F.col("node").alias("id"), F.col("component").alias("cluster")), "clusters")
    sizes = cut(clusters.groupBy("cluster").agg(F.count("*").alias("size")), "sizes")
    # the full sets, of the texts in clusters only; the bitmap is no more than a filter
    there = spark.sparkContext.broadcast(bitmap(clusters.select(F.xxhash64("id").alias("h")), "h", bits))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(in_bitmap(there.value, bits, b.column(2).to_numpy().view(np.uint64))))
            s = [x.tobytes() for _, x in shingle_sets(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.binary())], names=["id", "s"])

    full = rows.select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(sets, "id long, s binary")
    block = F.greatest(F.lit(BLOCK_MIN), F.least(F.lit(BLOCK_MAX), (4 * F.sqrt("size")).cast("long")))
    blocks = F.ceil(F.col("size") / block)
    placed = (clusters.join(sizes, "cluster").join(full, "id")
              .select("cluster", "id", "s", blocks.alias("blocks"), F.pmod(F.xxhash64("id", F.lit(7)), blocks).alias("blk"))
              .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("cluster", "id", "s", "blk", F.least("blk", "k").alias("i"), F.greatest("blk", "k").alias("j")))
    links = placed.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(_verify, "u long, v long")
    found = components(cut(links, "links"))
    out = member.select("id", "n", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("c", F.coalesce("component", "rep"))
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(real("id").alias(id), F.col("n").alias("n_shingles"), real("c").alias("component_id"), (F.col("id") == F.col("c")).alias("kept"))
