"""Shared pieces: lineage cuts, bounded bitmaps, connected components, group streaming."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import ensure_checkpoint_dir

NULL_ID = -(2**63)  # a null id orders before every other


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but compressed and with real sizes
    for the planner; a lost executor costs nothing that was written.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerflow-llm/{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bitmap(df: DataFrame, hashed: str, bits: int) -> np.ndarray:
    """Bit set of the low ``bits`` bits of a 64-bit hash column, as bytes.

    2**bits / 8 bytes whatever the data, so it may be broadcast. A filter by
    it never loses a member; the share of strangers it lets through grows as
    it fills, which costs time, not results.
    """
    low = F.col(hashed).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (df.select(F.shiftright(low, 15).alias("b"), low.bitwiseAND(F.lit(32767)).alias("p"))
            .groupBy("b").agg(F.expr("bitmap_construct_agg(p)").alias("m")).collect())
    out = np.zeros(max(4096, 1 << (bits - 3)), np.uint8)
    for r in rows:
        out[r["b"] * 4096:(r["b"] + 1) * 4096] = np.frombuffer(r["m"], np.uint8)
    return out


def in_bitmap(bits_of: np.ndarray, bits: int, hashed: np.ndarray) -> np.ndarray:
    p = hashed.astype(np.uint64) & np.uint64((1 << bits) - 1)
    return (bits_of[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of an undirected graph, component = smallest node reachable.

    ``edges`` has long columns ``u, v``. Alternating large-star and small-star
    rounds; each is one aggregate (combined map-side) and one join whose
    skewed side Spark may split, the aggregate being written first. A round's edges are written to the shared
    folder. Runs until every node but the roots has one edge, to a root: no
    limit on rounds.
    """
    hi, lo = F.greatest("u", "v"), F.least("u", "v")
    e = cut(edges.where("u <> v").select(hi.alias("u"), lo.alias("v")).distinct(), "edges")
    while True:
        m = cut(e.groupBy("u").agg(F.min("v").alias("m")), "least")  # written, so that the join may split a hub
        large = (e.join(m.select(F.col("u").alias("k"), "m"), e.v == F.col("k"), "left")
                 .select("u", F.coalesce("m", "v").alias("v")).distinct())
        large = cut(large, "large-star")
        m = cut(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        both = large.join(m, "u")
        small = both.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = cut(small.where("u <> v").distinct(), "small-star")
        ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"))))
        node = e.select(ends.alias("x")).groupBy("x.node").agg(F.sum("x.up").alias("up"), F.min("x.up").alias("low"))
        if node.where("up > 1 or (up = 1 and low = 0)").isEmpty():  # two edges up, or one and a node below
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.unionByName(roots)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys in a sorted partition, one table each; holds one run at a time."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        cut_at = np.zeros(b.num_rows, bool)
        for c in cols:
            cut_at[1:] |= c[1:] != c[:-1]
        starts = np.concatenate([[0], np.flatnonzero(cut_at), [b.num_rows]])
        for a, z in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(c[a] for c in cols)
            if last is not None and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(a, z - a))
    if held:
        yield last, pa.Table.from_batches(held)


def spanning(links: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges (id, smallest id reachable) that connect what the matrix ``links`` (rows a, columns b) connects."""
    big = np.iinfo(np.int64).max
    la, lb = a.copy(), b.copy()
    r, c = np.nonzero(links)
    if not len(r):
        return []
    while True:
        na, nb = la.copy(), lb.copy()
        np.minimum.at(na, r, lb[c])
        np.minimum.at(nb, c, na[r])
        # the two sides may name the same row: keep their labels together
        low = dict.fromkeys(a.tolist(), big)
        if set(low) & set(b.tolist()):
            for i, x in [*zip(a.tolist(), na.tolist(), strict=True), *zip(b.tolist(), nb.tolist(), strict=True)]:
                low[i] = min(low.get(i, big), x)
            na = np.array([low[i] for i in a.tolist()], np.int64)
            nb = np.array([low[i] for i in b.tolist()], np.int64)
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    return list({(i, x) for i, x in [*zip(a.tolist(), la.tolist(), strict=True), *zip(b.tolist(), lb.tolist(), strict=True)] if i != x})
