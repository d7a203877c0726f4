"""Idempotent loads without a table format (S9-S11): insert-only merge and
incremental keyed replace on Parquet."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .files import delete_path, path_exists, write_text


def merge_insert_only(spark: SparkSession, target_path: str, src: DataFrame, key: str,
                      order_cols: list[str] | None = None) -> dict[str, int]:
    """MERGE ... WHEN NOT MATCHED THEN INSERT on Parquet.

    Source rows are de-duplicated on the key (deterministically: the smallest
    row by ``order_cols`` then all columns), keys already in the target are
    skipped (left anti join), the rest appended.  The de-duplicated batch and
    the new rows are checkpointed to the session checkpoint folder, so the
    counts are exact and a lost executor never re-derives a different batch.
    Replaying the same source loads 0 rows. A row without a key can match
    nothing and would come in again with every replay, so it is left out
    and counted in ``null_keys``.
    """
    ensure_checkpoint_dir(spark)
    cols = src.columns
    rest = [c for c in cols if c != key]
    order = list(order_cols or []) + [c for c in rest if c not in (order_cols or [])]
    null_keys = src.where(F.col(key).isNull()).count()
    d = (src.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("_r"), F.count(F.lit(1)).alias("_copies"))
         .select(key, *[F.col(f"_r.{c}").alias(c) for c in order], "_copies").checkpoint(eager=True))
    attempted = int(d.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0])
    new = d.drop("_copies").select(*cols)
    if path_exists(spark, target_path):
        new = new.join(spark.read.parquet(target_path).select(key), key, "left_anti").select(*cols)
    new = new.checkpoint(eager=True)
    loaded = new.count()
    if loaded:
        new.write.mode("append").parquet(target_path)
    return {"attempted": attempted, "loaded": loaded, "skipped": attempted - loaded, "null_keys": null_keys}


def _finish_moves(spark: SparkSession, target_path: str, watermark: str, schema) -> None:
    """Deletes the folders noted before an overwrite that went through; a note of one that did not is dropped."""
    note_path = f"{target_path.rstrip(chr(47))}.moves"
    if not path_exists(spark, note_path):
        return
    note = json.loads(spark.read.text(note_path, wholetext=True).first()[0])
    rows = spark.read.schema(schema).parquet(target_path)
    if note["folders"] and not rows.where(F.col(watermark).cast("string") == F.lit(note["upto"])).isEmpty():
        for folder in note["folders"]:
            delete_path(spark, folder, uri=True)
    delete_path(spark, note_path)


def incremental_upsert(spark: SparkSession, target_path: str, src: DataFrame, key: str, watermark: str,
                       partition_col: str) -> dict[str, int]:
    """Incremental model: take source rows with ``watermark`` > max(target
    watermark), upsert on ``key``.  Of several new rows of a key the latest by
    the watermark stays (ties: the greatest row); rows without a key are left out.
    The partitions rewritten (dynamic partition overwrite) are those of the new rows and
    those that hold older rows of the same keys, so a key that moves leaves
    nothing behind.  The merged rows are first checkpointed, so the overwrite never reads
    the path it replaces."""
    ensure_checkpoint_dir(spark)
    rest = [c for c in src.columns if c not in (key, watermark)]
    pick = F.max(F.struct(watermark, *rest))

    def one_per_key(df: DataFrame) -> DataFrame:
        return (df.where(F.col(key).isNotNull()).groupBy(key).agg(pick.alias("_r"))
                .select(key, "_r.*").select(*src.columns))

    _finish_moves(spark, target_path, watermark, src.schema)
    if not path_exists(spark, target_path):
        new = one_per_key(src).checkpoint(eager=True)
        new.write.mode("overwrite").partitionBy(partition_col).parquet(target_path)
        return {"new_rows": new.count(), "replaced_rows": 0}
    tgt = spark.read.schema(src.schema).parquet(target_path)  # partition values keep their type: 01 stays a string
    hi = tgt.agg(F.max(watermark)).scalar()
    new = one_per_key(src.where(F.col(watermark) > hi)).checkpoint(eager=True)
    n_new = new.count()
    if n_new == 0:
        return {"new_rows": 0, "replaced_rows": 0}
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder")
    stale = tgt.withColumn("_folder", folder).join(new.select(key), key, "left_semi").select(key, partition_col, "_folder").checkpoint(eager=True)
    part = F.col(partition_col).cast("string")
    touched = new.select(part.alias("_p")).unionByName(stale.select(part.alias("_p"))).distinct().checkpoint(eager=True)
    keep = tgt.join(touched, part.eqNullSafe(F.col("_p")), "left_semi").join(new.select(key), key, "left_anti")
    merged = keep.select(*src.columns).unionByName(new).checkpoint(eager=True)
    # partitions that lose all rows: a dynamic overwrite does not touch them. Their folders, as the files are
    # listed, are noted before it, so that a run cut off in between is made good by the next.
    left = merged.select(part.alias("_p")).distinct()
    emptied = stale.join(left, part.eqNullSafe(F.col("_p")), "left_anti").select("_folder").distinct()
    note = {"folders": [r[0] for r in emptied.collect()], "upto": str(new.agg(F.max(F.col(watermark).cast("string"))).first()[0])}
    write_text(spark, f"{target_path.rstrip(chr(47))}.moves", json.dumps(note))
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_col).parquet(target_path))
    _finish_moves(spark, target_path, watermark, src.schema)
    return {"new_rows": n_new, "replaced_rows": stale.count()}
