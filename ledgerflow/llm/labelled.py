"""Bounded samples of labelled documents, the part that no classifier learns from left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id: str) -> Column:
    """Whether crc32 of the id's text is 0 modulo 5; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % FOLDS == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``text, y`` of about ``most`` labelled documents that aren't held out (all, if there are fewer).

    Chosen by a hash of the id. A document with several labels counts as 1 if
    any is; labels other than 0 and 1, and null ones, are ignored.
    """
    spark = docs.sparkSession
    known = (labels.select(F.col(id).cast("long").alias("i"), F.col(label).cast("int").alias("y")).where("i is not null and y in (0, 1)")
             .where(~held_out("i")).groupBy("i").agg(F.max("y").alias("y")))
    n = known.count()
    share = int((1 << 30) * min(1.0, most / max(n, 1)))
    chosen = known.where(F.pmod(F.xxhash64("i", F.lit(11)), F.lit(1 << 30)) < F.lit(share)).toArrow()
    chosen = spark.createDataFrame(chosen.slice(0, 2 * most)) if chosen.num_rows else spark.createDataFrame([], "i long, y int")
    return (docs.select(F.col(id).cast("long").alias("i"), F.col(text).alias("text"))
            .join(F.broadcast(chosen), "i").select("text", "y"))  # at most 2 * most rows of 12 bytes
