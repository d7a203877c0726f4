"""Near-duplicate vectors by product quantisation.

Coarse centroids give inverted lists; what a vector differs from its own
centroid by is coded in subspaces. A vector stays in its own list with all its
components, and its code (one byte a subspace, its error, its list) is sent to
every list it probes. There the distance of each resident to each code is
summed from tables, and a code whose distance less its coding error exceeds
the reach is out: that bound loses nothing. Only vectors that some resident may
be linked with are fetched, and their exact cosine, in double precision, decides.

A pair meets if either vector probes the other's list. The number of lists
probed is measured, not set: on the sample, partners are made at exactly the
threshold, in random directions, and so many lists are probed that ``recall``
of them meet. ``probes=0`` probes every list that can hold a partner at all (by
the plane halfway between two centroids) and so finds every pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, components, cut, groups, spanning

SAMPLE, SUBSPACES, CODES, BLOCK, RECALL = 20_000, 8, 64, 1024, 0.998
EPS = 1e-6


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([((c * c).sum(1) - 2 * y @ c.T).argmin(1) for y in np.array_split(x, len(x) // 4096 + 1)])
        n = np.bincount(near, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
        if (n == 0).any():
            c[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
    return c


class Codec:
    """Coarse centroids, codebooks of the residuals' subspaces, and how many lists are probed (0: all that the bound allows)."""

    def __init__(self, sample: np.ndarray, lists: int, cosine: float, recall: float = RECALL, probes: int | None = None, subspaces: int = SUBSPACES, codes: int = CODES, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.reach = float(np.sqrt(2 - 2 * cosine)) + EPS
        self.coarse = np.unique(_kmeans(sample, lists, 8, rng), axis=0)
        self.size = (self.coarse**2).sum(1)
        self.apart = np.sqrt(np.maximum(self.size[:, None] + self.size - 2 * self.coarse @ self.coarse.T, 0))
        res = sample - self.coarse[self.order(sample)[:, 0]]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
        self.books = [_kmeans(res[:, p], codes, 6, rng) for p in self.parts]
        self.probes = self._enough(sample[:4096], cosine, recall, rng) if probes is None else probes

    def order(self, x: np.ndarray) -> np.ndarray:
        """Lists by their centroid's distance, the vector's own first."""
        return np.argsort(self.size - 2 * x @ self.coarse.T, 1, kind="stable")

    def _enough(self, x: np.ndarray, cosine: float, recall: float, rng: np.random.Generator) -> int:
        """Lists to probe so that ``recall`` of partners at the threshold meet, one probing the other's list."""
        side = rng.normal(size=x.shape)
        side -= (side * x).sum(1, keepdims=True) * x
        y = _unit(cosine * x + np.sqrt(1 - cosine**2) * _unit(side + 1e-12))
        a, b = self.order(x), self.order(y)
        rank = np.minimum((a == b[:, :1]).argmax(1), (b == a[:, :1]).argmax(1))
        return int(np.quantile(rank, recall, method="higher")) + 1

    def probed(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists each vector probes, its own first."""
        order = self.order(x)
        if self.probes:
            return list(order[:, :self.probes])
        d = self.size - 2 * x @ self.coarse.T
        ok = d - d.min(1)[:, None] <= 2 * self.reach * self.apart[order[:, 0]] + EPS
        return [o[k[o]] for o, k in zip(order, ok, strict=True)]

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the residuals, the distance to what a code stands for, and the squared length of that."""
        res = x - self.coarse[own]
        codes = np.stack([((b * b).sum(1) - 2 * res[:, p] @ b.T).argmin(1) for p, b in zip(self.parts, self.books, strict=True)], 1)
        back = np.concatenate([b[codes[:, k]] for k, b in enumerate(self.books)], 1)
        return codes.astype(np.uint8), np.sqrt(((res - back) ** 2).sum(1)), ((self.coarse[own] + back) ** 2).sum(1)

    def lookup(self, x: np.ndarray, codes: np.ndarray, own: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Distances of vectors to codes, from one table a subspace and one of the centroids."""
        dot = (x @ self.coarse.T)[:, own]
        for k, (p, b) in enumerate(zip(self.parts, self.books, strict=True)):
            dot += (x[:, p] @ b.T)[:, codes[:, k]]
        return np.sqrt(np.maximum((x * x).sum(1)[:, None] + length - 2 * dot, 0))


def pq_dedup(vectors: DataFrame, id: str = "vec_id", column: str = "embedding", cosine: float = 0.9, lists: int | None = None,
             sample: int = SAMPLE, block: int = BLOCK, recall: float = RECALL, probes: int | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors that are null, empty, zero or hold null or non-finite values link
    with nothing, and so do those whose length no other vector has. Equal
    vectors are linked. A null id orders first and comes back null; rows that
    share an id, null or not, are vectors of their own.
    An empty table gives an empty result; other columns are not read.

    ``sample`` vectors at most fit the codec (all are indexed and are queries);
    ``lists`` is twice the square root of the number of distinct vectors, an
    eighth of the sample at most, unless given. A list of many residents is split into blocks of
    ``block``, each a row group of its own. ``recall`` and ``probes``: see above.
    """
    spark = vectors.sparkSession
    e = F.col(column).cast("array<double>")
    ok = (F.size(e) > 0) & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.coalesce(F.col(id).cast("long"), F.lit(NULL_ID)).alias("id"), F.when(F.coalesce(ok, F.lit(False)), e).alias("e"))
    rows = rows.withColumn("e", F.transform("e", lambda x: x + F.lit(0.0)))  # -0.0 as 0.0
    # one node stands for equal vectors; its weight is their number
    classes = cut(rows.where("e is not null").groupBy("e").agg(F.min("id").alias("least"), F.count("*").alias("w"))
                  .withColumn("node", F.monotonically_increasing_id()), "vectors")
    dims = [r[0] for r in classes.select(F.size("e").alias("d")).distinct().sort("d").collect()]
    edges, counts = [], []
    for d in dims:  # lengths that occur: one, as a rule
        own = classes.where(F.size("e") == d)
        n = own.count()
        part = own.where(F.pmod(F.xxhash64("e"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, sample / max(n, 1))))).select("e")
        got = np.array([r[0] for r in part.limit(2 * sample).collect()], np.float64).reshape(-1, d)
        if not len(got):
            got = np.array([own.first()["e"]], np.float64)
        codec = spark.sparkContext.broadcast(Codec(_unit(got), lists or max(1, min(int(2 * n**0.5), len(got) // 8)), cosine, recall, probes))
        coded = cut(own.select("e", "node", "w").mapInArrow(_code(codec), "node long, w long, e binary, lists array<int>, codes binary, error double, length double"), "codes")
        sizes = {r[0]: r[1] for r in coded.groupBy(F.col("lists")[0].alias("list")).count().collect()}  # a row a list
        blocks = spark.sparkContext.broadcast({c: -(-s // block) for c, s in sizes.items()})
        spread = F.pmod(F.xxhash64("node"), F.lit(1 << 20)).cast("int")
        home = F.col("lists")[0]
        parts_of = F.create_map(*[F.lit(x) for c, s in sizes.items() if s > block for x in (c, -(-s // block))]) if any(s > block for s in sizes.values()) else None
        split = F.coalesce(parts_of[home], F.lit(1)) if parts_of is not None else F.lit(1)
        residents = coded.select(home.alias("list"), (spread % split).alias("i"), F.lit(0).alias("kind"), "node", "w", "e", "lists", F.lit(None).cast("binary").alias("codes"),
                                 F.lit(None).cast("double").alias("error"), F.lit(None).cast("double").alias("length"))
        sent = coded.mapInArrow(_send(blocks), "list int, i int, node long, own int, codes binary, error double, length double")
        sent = sent.select("list", "i", F.lit(1).alias("kind"), "node", F.lit(None).cast("long").alias("w"), F.lit(None).cast("binary").alias("e"), F.array("own").alias("lists"), "codes", "error", "length")
        dealt = residents.unionByName(sent).repartition("list", "i").sortWithinPartitions("list", "i", "kind")
        near = cut(dealt.mapInArrow(_near(codec), "list int, i int, node long"), "near")
        there = near.select("list", "i").distinct()
        hosts = residents.select("list", "i", "kind", "node", "w", "e", "lists").join(there, ["list", "i"], "left_semi")
        guests = near.join(coded.select("node", "w", "e", "lists"), "node").select("list", "i", F.lit(1).alias("kind"), "node", "w", "e", "lists")
        met = hosts.unionByName(guests).repartition("list", "i").sortWithinPartitions("list", "i", "kind")
        out = cut(met.mapInArrow(_compare(cosine), "u long, v long, n long"), "links")
        edges.append(out.where("v is not null").select("u", "v"))
        counts.append(out.where("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links")))
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    if not dims:
        return rows.select(real("id").alias(id), F.lit(0).cast("long").alias("n_links"), real("id").alias("component_id"), F.lit(True).alias("kept"))
    e, c = edges[0], counts[0]
    for x, y in zip(edges[1:], counts[1:], strict=True):
        e, c = e.unionByName(x), c.unionByName(y)
    found = cut(components(e).join(classes.select("node", "least"), "node"), "components")
    smallest = found.groupBy("component").agg(F.min("least").alias("smallest"))
    linked = found.join(smallest, "component").select("node", "smallest")
    node = (classes.join(c, "node", "left").join(linked, "node", "left")
            .select("e", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("smallest", "least").alias("c")))
    out = rows.join(node, "e", "left").withColumn("c", F.coalesce("c", "id"))
    return out.select(real("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), real("c").alias("component_id"), (F.col("id") == F.col("c")).alias("kept"))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return _unit(column.flatten().to_numpy().reshape(len(column), -1))


def _doubles(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), width or -1)


def _code(codec):
    """Unit vectors with the lists they probe and their codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 2048):
                part = b.slice(k, 2048)
                x = _matrix(part.column(0))
                lists = codec.value.probed(x)
                codes, error, length = codec.value.encode(x, np.array([y[0] for y in lists], np.int64))
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([y.tobytes() for y in x], pa.binary()), pa.array(lists, pa.list_(pa.int32())),
                                                  pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(length)],
                                                 names=["node", "w", "e", "lists", "codes", "error", "length"])
    return run


def _send(blocks):
    """A code to every block of the lists its vector probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                to = [(r, c, i) for r, lists in enumerate(part["lists"].to_pylist()) for c in lists for i in range(blocks.value.get(c, 0))]
                if not to:
                    continue
                r, c, i = zip(*to, strict=True)
                t = pa.array(r)
                own = pa.array([x[0] for x in part["lists"].to_pylist()], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(i, pa.int32()), part["node"].take(t), own.take(t), part["codes"].take(t), part["error"].take(t), part["length"].take(t)],
                                                 names=["list", "i", "node", "own", "codes", "error", "length"])
    return run


def _near(codec):
    """The codes that some resident of a block may be linked with, by table look-ups. Holds a block's residents and its codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (c, i), t in groups(batches, ["list", "i"]):
            kind = t["kind"].to_numpy()
            m = int((kind == 0).sum())
            if not m or m == len(kind):
                continue
            x, here = _doubles(t["e"].slice(0, m)), t["node"].slice(0, m).to_numpy()
            for k in range(m, len(kind), BLOCK):
                part = t.slice(k, BLOCK)
                codes = np.frombuffer(b"".join(part["codes"].to_pylist()), np.uint8).reshape(part.num_rows, -1)
                own = part["lists"].combine_chunks().flatten().to_numpy()
                node = part["node"].to_numpy()
                d = codec.value.lookup(x, codes, own, part["length"].to_numpy())
                hit = ((d <= codec.value.reach + EPS + part["error"].to_numpy()) & (here[:, None] != node)).any(0)
                if hit.any():
                    n = int(hit.sum())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, c), pa.int32()), pa.array(np.full(n, i), pa.int32()), pa.array(node[hit])], names=["list", "i", "node"])
    return run


def _compare(cosine):
    """Links between a block's residents and the vectors fetched for it: weights a node, and edges that connect the same.

    A resident counts the guest. The guest counts the resident only if the
    resident doesn't probe the guest's list: else the two meet there as well.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (c, _), t in groups(batches, ["list", "i"]):
            m = int((t["kind"].to_numpy() == 0).sum())
            x, here, w = _doubles(t["e"].slice(0, m)), t["node"].slice(0, m).to_numpy(), t["w"].slice(0, m).to_numpy()
            lists = t["lists"].slice(0, m).to_pylist()
            for k in range(m, t.num_rows, BLOCK):
                part = t.slice(k, BLOCK)
                y, node, v = _doubles(part["e"]), part["node"].to_numpy(), part["w"].to_numpy()
                s = x @ y.T
                links = s >= cosine - 1e-9
                for r, z in zip(*np.nonzero(links & (s < cosine + 1e-9)), strict=True):  # at the border: the plain sum decides
                    links[r, z] = float(x[r] @ y[z]) >= cosine
                links &= here[:, None] != node
                if not links.any():
                    continue
                homes = [g[0] for g in part["lists"].to_pylist()]
                at = {h: n for n, h in enumerate(sorted(set(homes)))}
                probes = np.zeros((m, len(at)), bool)
                for r, g in enumerate(lists):
                    probes[r, [at[h] for h in g if h in at]] = True
                alone = links & ~probes[:, [at[h] for h in homes]]
                for nodes, n in ((here, links @ v), (node, alone.T @ w)):
                    hit = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[hit]), pa.nulls(len(hit), pa.int64()), pa.array(n[hit].astype(np.int64))], names=["u", "v", "n"])
                e = spanning(links, here, node)
                yield pa.RecordBatch.from_arrays([pa.array([q[0] for q in e], pa.int64()), pa.array([q[1] for q in e], pa.int64()), pa.nulls(len(e), pa.int64())], names=["u", "v", "n"])
    return run
