"""Centroid clustering of integer vectors by equal-average equal-variance nearest-centroid search.

Centroids are sorted by the sum of their components. A vector starts at its
own sum and goes outwards: it ends as soon as the sums alone put every further
centroid beyond the best distance, leaves out centroids which sums and
deviations put beyond it, and takes the exact integer distance of the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

DIM, K, ROUNDS, SCALE = 64, 16, 3, 64
MOST = 1 << 27  # larger components: squared distances would leave 64 bits
BATCH = 4096


class Centroids:
    """Numbered integer centroids, prepared for the search."""

    def __init__(self, rows: list[list[int]]):
        self.rows = np.array(rows, np.int64)
        s, w = _moments(self.rows)
        self.order = np.lexsort((np.arange(len(s)), s))
        self.sums, self.deviations = s[self.order], np.sqrt(w[self.order])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid (ties: the smaller number), and how many distances were taken."""
        d, k = x.shape[1], len(self.sums)
        s, w = _moments(x)
        dev = np.sqrt(w)
        best = np.full(len(x), np.iinfo(np.int64).max)
        number = np.full(len(x), k)
        up = np.searchsorted(self.sums, s)  # the next place to try above, and below
        down = up - 1
        taken = 0
        live = np.arange(len(x))
        while len(live):
            u, v = up[live], down[live]
            above = np.where(u < k, self.sums[np.minimum(u, k - 1)].astype(np.float64) - s[live], np.inf)
            below = np.where(v >= 0, s[live] - self.sums[np.maximum(v, 0)].astype(np.float64), np.inf)
            place = np.where(above <= below, u, v)
            gap = np.minimum(above, below)
            most = best[live] * float(d) * (1 + 1e-6) + 1e-3  # a margin for the rounding of the bounds; ties stay in
            within = (gap < np.inf) & (gap * gap <= most)
            live, place, gap, most, higher = live[within], place[within], gap[within], most[within], (above <= below)[within]
            up[live[higher]] += 1
            down[live[~higher]] -= 1
            close = gap * gap + (dev[live] - self.deviations[place]) ** 2 * (1 - 1e-9) <= most
            at, c = live[close], self.order[place[close]]
            taken += len(at)
            dist = ((x[at] - self.rows[c]) ** 2).sum(1)
            better = (dist < best[at]) | ((dist == best[at]) & (c < number[at]))
            best[at[better]], number[at[better]] = dist[better], c[better]
        return number, best, taken


def _moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of components, and the squared deviation from their mean times their number (as floats for large values)."""
    s = x.sum(1)
    mean = s / x.shape[1]
    return s, ((x - mean[:, None]) ** 2).sum(1) * x.shape[1]


def usable(embedding: Column, dim: int = DIM, scale: int = SCALE) -> Column:
    """Whether a vector has ``dim`` components, none null or non-finite (or too large for 64-bit distances)."""
    return F.coalesce((F.size(embedding) == dim) & F.forall(embedding, lambda x: F.coalesce(F.abs(x.cast("double") * scale) < MOST, F.lit(False))), F.lit(False))


def clusters(vectors: DataFrame, id: str = "vec_id", column: str = "embedding", dim: int = DIM, k: int = K, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector kept.

    Kept are vectors of ``dim`` components, none null or non-finite; each
    becomes floor(scale * x). Components of 2^27 and more in absolute value
    (after scaling) are left out like non-finite ones: their squared distances
    do not fit a long. The first ``k`` kept vectors by the hex SHA-256 of
    ``1:<id>`` start as centroids 0, 1, ...; null ids come last, equal ids go
    by their components. Fewer kept vectors than ``k`` give fewer centroids,
    none an empty result. Repeated rows count and come back once each. Other
    columns are not read. An inertia that exceeds a long is null.

    Each round is one pass over the vectors: a task sends one row of sums a
    cluster, so what is shuffled does not grow with the vectors, and the driver
    holds ``k`` centroids. Nothing is ordered or grouped by a key of the data.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(column).alias("e")).where(usable(F.col("e"), dim, scale))
    whole = F.transform("e", lambda x: F.floor(x.cast("double") * scale))
    first = rows.select(F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256).alias("h"), whole.alias("x")).orderBy(F.col("h").asc_nulls_last(), "x").limit(k)
    centres = [list(r["x"]) for r in first.collect()]  # k rows
    if not centres:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string").withColumnRenamed("vec_id", id)
    whole_rows = rows.select("id", whole.alias("x"))
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(Centroids(centres))  # k vectors
        parts = whole_rows.select("x").mapInArrow(_sums(held), "cluster int, n long, s array<long>")
        flat = parts.select("cluster", "n", F.posexplode("s").alias("at", "v")).groupBy("cluster", "at")
        for c, at, s, n in flat.agg(F.sum("v"), F.sum("n")).collect():  # k * dim rows
            centres[c][at] = s // n
        held.unpersist()
    held = spark.sparkContext.broadcast(Centroids(centres))
    out = cut(whole_rows.mapInArrow(_assign(held), "id long, cluster int, distance long"), "assigned")
    per = {r["cluster"]: r["i"] for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("i")).collect()}  # k rows
    fits = lambda v: F.lit(int(v) if v < 1 << 63 else None).cast("long")
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    return out.select(F.col("id").alias(id), "cluster", "distance", of([fits(per.get(c, 0)) for c in range(len(centres))]).alias("cluster_inertia"),
                      fits(sum(per.values())).alias("inertia"),
                      of([F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centres]).alias("centroid_sha256"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for k in range(0, b.num_rows, BATCH):
            part = b.slice(k, BATCH)
            x = part.column(part.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False)
            yield part, x.astype(np.int64, copy=False).reshape(part.num_rows, -1)


def _sums(held: Broadcast):
    """Sums and sizes of the clusters of one task's vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Centroids = held.value
        total, n = np.zeros_like(c.rows), np.zeros(len(c.rows), np.int64)
        for _, x in _blocks(batches):
            near, _, _ = c.nearest(x)
            np.add.at(total, near, x)
            n += np.bincount(near, minlength=len(n))
        full = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(n[full]), pa.array(total[full].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "s"])
    return run


def _assign(held: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _blocks(batches):
            near, dist, _ = held.value.nearest(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(near, pa.int32()), pa.array(dist)], names=["id", "cluster", "distance"])
    return run


def _round_sql(k: int) -> str:
    """One assignment to the centroids ``c<k>`` and the centroids that follow from it."""
    return f"""
a{k} AS (SELECT rn, min(struct_pack(d := d, c := c)) AS best FROM (
  SELECT v.rn, c.c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(v.x, c.x)]) AS d FROM v CROSS JOIN c{k} c) GROUP BY rn),
n{k} AS (SELECT c, pos, sum(x) AS s, count(*) AS n FROM (
  SELECT a.best.c AS c, generate_subscripts(v.x, 1) AS pos, unnest(v.x) AS x FROM a{k} a JOIN v USING (rn)) GROUP BY c, pos),
c{k + 1} AS MATERIALIZED (SELECT c, coalesce(m.x, o.x) AS x FROM c{k} o LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS x FROM n{k} GROUP BY c) m USING (c))"""


CLUSTERS_SQL = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id, [CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT) for x in embedding] AS x FROM embeddings
  WHERE len(embedding) = {DIM} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {DIM}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), x) - 1 AS c, x FROM (SELECT vec_id, x FROM v ORDER BY sha256(concat('1:', vec_id)), x LIMIT {K})),
{",".join(_round_sql(k) for k in range(ROUNDS))},
{_round_sql(ROUNDS).split("n3 AS")[0].rstrip().rstrip(",")},
f AS (SELECT v.vec_id, a.best.c AS c, CAST(a.best.d AS BIGINT) AS d FROM a{ROUNDS} a JOIN v USING (rn))
SELECT vec_id, CAST(f.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM f JOIN c{ROUNDS} c ON f.c = c.c
"""
