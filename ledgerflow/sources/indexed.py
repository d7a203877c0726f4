"""Keyed parts with a key index and commit markers.

A table is a folder of parts, one a batch. Each part has an index: its keys are
dealt by hash into pieces, and a piece holds the least and greatest key and a
Bloom filter. A batch reads only the parts that may hold one of its keys, and
only their key column. A part counts once its marker is there, which is written last: a batch
cut off halfway is written anew, one that is marked is not applied again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .files import path_exists, write_text

PIECES, BITS_A_KEY, HASHES = 64, 12, 6


class IndexedTable:
    """``root/data/<part>``, ``root/index/<part>``, ``root/commits/<part>``."""

    def __init__(self, spark: SparkSession, root: str, key: str, pieces: int = PIECES):
        self.spark, self.root, self.key, self.pieces = spark, root.rstrip("/"), key, pieces

    def markers(self) -> list[dict]:
        """What was committed, in order: one small record a batch."""
        if not path_exists(self.spark, f"{self.root}/commits/*"):
            return []
        rows = self.spark.read.text(f"{self.root}/commits", wholetext=True).collect()
        return sorted((json.loads(r[0]) for r in rows), key=lambda m: m["seq"])

    def marker(self, batch: str) -> dict | None:
        return next((m for m in self.markers() if m["batch"] == batch), None)

    def read(self, parts: list[str] | None = None) -> DataFrame | None:
        """The rows of all committed parts, or of those named; None if there are none."""
        own = [m["part"] for m in self.markers() if m["rows"]] if parts is None else parts
        return self.spark.read.parquet(*[f"{self.root}/data/{p}" for p in own]) if own else None

    def _hashed(self, keys: DataFrame) -> DataFrame:
        h = F.xxhash64(F.col(self.key).cast("string"))
        return keys.select(F.pmod(h, F.lit(self.pieces)).cast("int").alias("piece"), h.alias("h"), F.col(self.key).alias("k"))

    def may_hold(self, keys: DataFrame) -> list[str]:
        """Committed parts that may hold one of the keys; each part that does is among them."""
        own = [m["part"] for m in self.markers() if m["rows"]]
        if not own:
            return []
        asked = self._hashed(keys.where(F.col(self.key).isNotNull()))
        bounds = asked.groupBy("piece").agg(F.min("k").alias("from"), F.max("k").alias("to"))
        index = self.spark.read.parquet(*[f"{self.root}/index/{p}" for p in own])
        near = (index.join(bounds, "piece").where((F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from")))
                .select("piece", F.lit(0).alias("kind"), "part", "bits", F.lit(None).cast("long").alias("h")))
        asked = asked.select("piece", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("part"), F.lit(None).cast("binary").alias("bits"), "h").distinct()
        found = near.unionByName(asked).repartition("piece").sortWithinPartitions("piece", "kind").mapInArrow(_test, "part string")
        return sorted(r[0] for r in found.distinct().collect())  # parts at most

    @staticmethod
    def part_of(batch: str) -> str:
        return "batch=" + re.sub("[^A-Za-z0-9.-]", "_", batch)

    def append(self, rows: DataFrame, batch: str, **more) -> dict:
        """Writes a batch's rows and their index, then its marker with ``more`` in it."""
        part = self.part_of(batch)
        rows.write.mode("overwrite").parquet(f"{self.root}/data/{part}")
        done = self.spark.read.schema(rows.schema).parquet(f"{self.root}/data/{part}")
        hashed = self._hashed(done.where(F.col(self.key).isNotNull()))
        bounds = hashed.groupBy("piece").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("keys"))
        bits = hashed.select("piece", "h").repartition("piece").sortWithinPartitions("piece").mapInArrow(_filters, "piece int, bits binary")
        bits.join(bounds, "piece").withColumn("part", F.lit(part)).write.mode("overwrite").parquet(f"{self.root}/index/{part}")
        record = {"batch": batch, "part": part, "seq": len(self.markers()), "rows": done.count(), **more}
        write_text(self.spark, f"{self.root}/commits/{part}", json.dumps(record))
        return record


def merge_indexed(spark: SparkSession, root: str, src: DataFrame, key: str, batch: str, order_cols: list[str] | None = None) -> dict:
    """Inserts the rows whose key is not there yet, and opens only the parts that may hold one.

    ``batch`` names the batch, e.g. a stream's query id and batch id: one that
    is marked is not applied again and its record comes back with ``replayed``.
    Of the rows of one key the smallest by ``order_cols``, then all columns, stays. Rows without a key are left out and counted.
    """
    ensure_checkpoint_dir(spark)
    table = IndexedTable(spark, root, key)
    if (done := table.marker(batch)) is not None:
        return {**done, "replayed": True}
    rest = [c for c in src.columns if c != key]
    order = [*(order_cols or []), *[c for c in rest if c not in (order_cols or [])]]
    one = (src.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("_r"), F.count(F.lit(1)).alias("_copies"))
           .select(key, *[F.col(f"_r.{c}").alias(c) for c in order], "_copies").checkpoint(eager=True))
    counts = one.agg(F.count(F.lit(1)), F.coalesce(F.sum("_copies"), F.lit(0))).first()
    parts = table.may_hold(one.select(key))
    new = one.select(*src.columns)
    if parts:
        new = new.join(table.read(parts).select(key), key, "left_anti").select(*src.columns)
    record = table.append(new, batch, attempted=int(counts[1]), opened=parts)
    return {**record, "loaded": record["rows"], "skipped": record["attempted"] - record["rows"], "null_keys": src.where(F.col(key).isNull()).count(), "replayed": False}


def _places(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Places of hashes in a filter of ``size`` bits, a power of two."""
    u = h.astype(np.uint64)
    step = (u >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        x = u * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k) * step
        yield (x ^ (x >> np.uint64(29))) & np.uint64(size - 1)


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A Bloom filter of each piece's hashes; holds the hashes of one piece."""
    def build(piece: int, held: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(held)
        size = 1 << max(10, int(len(h) * BITS_A_KEY - 1).bit_length())
        bits = np.zeros(size, np.uint8)
        for p in _places(h, size):
            bits[p] = 1
        return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["piece", "bits"])

    held: list[np.ndarray] = []
    last = None
    for b in batches:
        pieces, h = b.column(0).to_numpy(), b.column(1).to_numpy()
        for piece in np.unique(pieces):  # sorted
            if last is not None and piece != last:
                yield build(last, held)
                held = []
            last = int(piece)
            held.append(h[pieces == piece])
    if held:
        yield build(last, held)


def _test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts whose filter of a piece holds one of the piece's hashes; holds the filters of one piece, and tests a part until it is found."""
    filters: dict[str, np.ndarray] = {}
    found: set[str] = set()
    last = None
    for b in batches:
        t = pa.Table.from_batches([b])
        for piece, kind in sorted({(p, k) for p, k in zip(t["piece"].to_pylist(), t["kind"].to_pylist(), strict=True)}):
            rows = t.filter(pa.compute.and_(pa.compute.equal(t["piece"], piece), pa.compute.equal(t["kind"], kind)))
            if piece != last:
                filters, last = {}, piece
            if kind == 0:
                filters |= {p: np.unpackbits(np.frombuffer(x, np.uint8)) for p, x in zip(rows["part"].to_pylist(), rows["bits"].to_pylist(), strict=True) if p not in found}
                continue
            h = rows["h"].to_numpy()
            for p, bits in filters.items():
                if p not in found and np.logical_and.reduce([bits[x] == 1 for x in _places(h, len(bits))]).any():
                    found.add(p)
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found))], names=["part"])
