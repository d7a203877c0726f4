"""Merkle fixity audit of WARC files: where do two replicas differ?

Records are hashed; a file's offsets are cut into ranges of 64 KB, each
hashed over its records in order, 16 ranges to a node above, and so on to a
root a file. Only files whose roots differ are looked into, and below a node only
the children that differ, down to the records. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

RANGE, FANOUT, LEVELS = 65_536, 16, 4


def _hash(parts: str, order: str):
    """SHA-256 of the parts in order, joined by commas; as many as a range or a node has."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(parts).alias("p"))))
    return F.sha2(F.array_join(F.transform(rows, lambda x: x["p"]), ","), 256)


def index(records: DataFrame, file: str, key: str, body: str) -> DataFrame:
    """``file, key, offset, length, copies, body``: the place of each record in its file.

    Records lie in order of key (null first), then of content; equal ones one after another.
    A file is to hold a bounded number of different records.
    """
    from pyspark.sql import Window

    rows = records.groupBy(F.col(file).alias("file"), F.col(key).alias("key"), F.col(body).alias("body")).agg(F.count("*").alias("copies"))
    size = F.octet_length("body").cast("long")
    own = rows.withColumn("digest", F.sha2("body", 256)).withColumn("length", size)
    before = Window.partitionBy("file").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return own.withColumn("offset", F.coalesce(F.sum(F.col("length") * F.col("copies")).over(before), F.lit(0)).cast("long"))


class Audit:
    """Trees of two replicas, both given as ``file, offset, digest`` and ``copies``.

    ``roots``: a row a file with both roots; ``damage``: a row for each place whose
    records differ, with ``status`` altered, missing (in the second) or extra;
    ``visited``: how many nodes were compared in each file.
    A null file is a file of its own. Two empty replicas give empty results.
    """

    def __init__(self, first: DataFrame, second: DataFrame, span: int = RANGE, fanout: int = FANOUT, levels: int = LEVELS):
        cols = ["file", "offset", "digest", "copies"]
        rows = first.select(F.lit("a").alias("replica"), *cols).unionByName(second.select(F.lit("b").alias("replica"), *cols))
        rows = cut(rows.groupBy("replica", F.coalesce(F.col("file").cast("string"), F.lit("")).alias("file"), "offset", "digest").agg(F.sum("copies").alias("copies")), "records")
        rows = rows.withColumn("node", F.floor(F.col("offset") / span)).withColumn("entry", F.concat_ws(":", "offset", "digest", "copies"))
        level = cut(rows.groupBy("replica", "file", "node").agg(_hash("entry", "entry").alias("hash")), "ranges")
        tree = [level]
        for _ in range(levels):
            level = level.select("replica", "file", F.floor(F.col("node") / fanout).alias("node"), F.col("node").alias("child"), "hash").groupBy("replica", "file", "node").agg(_hash("hash", "child").alias("hash"))
            tree.append(level)
        top = tree[-1].groupBy("replica", "file").agg(_hash("hash", "node").alias("hash"))
        self.roots = cut(self._pairs(top, ["file"]), "roots")
        bad = self.roots.where("not (a <=> b)").select("file")
        parent = None
        seen = []
        for level in reversed(tree):
            if parent is None:
                part = level.join(bad, "file", "left_semi")
            else:
                part = level.withColumn("parent", F.floor(F.col("node") / fanout)).join(bad, ["file", "parent"], "left_semi")
            pairs = cut(self._pairs(part, ["file", "node"]), "nodes")
            seen.append(pairs.select("file"))
            bad = pairs.where("not (a <=> b)").select("file", F.col("node").alias("parent"))
            parent = "parent"
        nodes = seen[0]
        for x in seen[1:]:
            nodes = nodes.unionByName(x)
        self.visited = nodes.groupBy("file").agg(F.count("*").alias("visited"))
        places = rows.join(bad.withColumnRenamed("parent", "node"), ["file", "node"], "left_semi").groupBy("replica", "file", "offset").agg(_hash("entry", "entry").alias("hash"))
        status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("altered")
        self.damage = self._pairs(places, ["file", "offset"]).where("not (a <=> b)").select("file", "offset", status.alias("status"))

    @staticmethod
    def _pairs(level: DataFrame, keys: list[str]) -> DataFrame:
        return level.groupBy(*keys).agg(F.max(F.when(F.col("replica") == "a", F.col("hash"))).alias("a"), F.max(F.when(F.col("replica") == "b", F.col("hash"))).alias("b"))

    def summary(self) -> DataFrame:
        """``file, root, replica_root, visited, altered, missing, extra, damaged`` (offsets in order)."""
        d = self.damage.groupBy("file").agg(*[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in ("altered", "missing", "extra")],
                                            F.array_join(F.sort_array(F.collect_list("offset")), ",").alias("damaged"))
        zero = F.lit(0).cast("long")
        return (self.roots.join(self.visited, "file", "left").join(d, "file", "left")
                .select("file", F.col("a").alias("root"), F.col("b").alias("replica_root"), *[F.coalesce(c, zero).alias(c) for c in ("visited", "altered", "missing", "extra")],
                        F.coalesce("damaged", F.lit("")).alias("damaged")))
