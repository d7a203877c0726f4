"""File sources and sinks."""

from __future__ import annotations

import re

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_bronze_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Raw CSV with header, every column a string (no inference)."""
    return spark.read.schema(string_schema(columns)).option("header", True).option("mode", "PERMISSIVE").csv(path)


def with_ingest_metadata(df: DataFrame, run_id: str, run_ts: str) -> DataFrame:
    """Ingestion timestamp (the run's, not the wall clock), source file, run id.
    ``_metadata.file_path`` exists only on file scans; other frames get NULL."""
    src = F.col("_metadata.file_path") if _has_metadata(df) else F.lit(None).cast("string")
    return (df.withColumn("ingestion_timestamp", F.lit(run_ts).cast("string"))
            .withColumn("source_file", src)
            .withColumn("pipeline_run_id", F.lit(run_id)))


def _has_metadata(df: DataFrame) -> bool:
    try:
        df.select("_metadata.file_path")
        return True
    except Exception:
        return False


def write_partitioned(df: DataFrame, path: str, partition_col: str, fmt: str = "parquet") -> None:
    """S3: overwrite only the partitions present in ``df`` (dynamic mode set on
    this write, whatever the session default), never append."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).format(fmt).save(path))


def read_partition(spark: SparkSession, path: str, partition_col: str, value) -> DataFrame:
    """Partition-pruned read (the plan shows PartitionFilters)."""
    return spark.read.parquet(path).where(F.col(partition_col) == F.lit(value))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does anything match ``path`` (globs allowed)?  One filesystem glob
    call on the driver -- no file listing job, however large the prefix."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def delete_path(spark: SparkSession, path: str, uri: bool = False) -> None:
    """``uri``: the path is one as Spark's file metadata shows it, with signs escaped."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)) if uri else jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as one file that is there whole or not at all: written aside, then renamed."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(aside, target):
        fs.delete(target, False)
        if not fs.rename(aside, target):
            raise OSError(f"could not write {path}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType,
                 corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Many JSON files, each one object or an array of objects; unreadable
    records land in ``corrupt_col``.  Returns (rows, per-file counts)."""
    full = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType(), True)]) if corrupt_col not in schema.names else schema
    df = (spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", corrupt_col).json(path)
          .withColumn("_source_file", F.col("_metadata.file_path")))
    stats = df.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(corrupt_col).isNotNull()).alias("corrupt_rows"))
    return df, stats


def write_json_hourly(df: DataFrame, path: str, ts_col: str) -> None:
    """JSON Lines under yyyy/MM/dd/HH partition folders."""
    ts = F.col(ts_col).cast("timestamp")
    out = (df.withColumn("yyyy", F.date_format(ts, "yyyy")).withColumn("MM", F.date_format(ts, "MM"))
           .withColumn("dd", F.date_format(ts, "dd")).withColumn("HH", F.date_format(ts, "HH")))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("yyyy", "MM", "dd", "HH").json(path))


def write_quarantine(df: DataFrame, path: str, reason: str, source: str, run_ts: str,
                     run_id: str | None = None) -> str:
    """Add reason / source / time and write CSV under dt=<date>/run=<source>-<id>;
    empty input -> SKIPPED.  Runs accumulate, each source of a run in its own partition;
    replaying a source of a run rewrites only that partition, so a retry never
    duplicates quarantined rows and two sources of one time keep both."""
    if df.isEmpty():
        return "SKIPPED"
    run = f"{re.sub('[^A-Za-z0-9.]', '_', source)}-{run_id or run_ts.replace(' ', 'T').replace(':', '')}"
    out = (df.withColumn("_quarantine_reason", F.coalesce(F.col("_quarantine_reason"), F.lit(reason))
                         if "_quarantine_reason" in df.columns else F.lit(reason))
           .withColumn("_quarantine_source", F.lit(source))
           .withColumn("_quarantine_at", F.to_timestamp(F.lit(run_ts)))
           .withColumn("dt", F.to_date(F.lit(run_ts)))
           .withColumn("run", F.lit(run)))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
        .partitionBy("dt", "run").csv(path))
    return "WRITTEN"


def _zero_byte_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Zero-length files per folder.  Spark's file sources drop empty files
    when planning splits, so these come from a streamed filesystem listing
    (metadata only; only the rare empty files are kept)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(p, True)
    out: dict[str, int] = {}
    while it.hasNext():
        st = it.next()
        if st.getLen() == 0:
            folder = st.getPath().getParent().toString()
            out[folder] = out.get(folder, 0) + 1
    return out


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files grouped by folder: count, bytes, zero-byte files.  Non-empty
    files are listed and aggregated by Spark (content is never read: only
    path/length/modificationTime are selected)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path) \
             .select("path", "length", "modificationTime")
    folder = F.regexp_replace(F.col("path"), r"/[^/]*$", "")
    agg = f.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("_files"), F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("last_modified"))
    zeros = _zero_byte_files(spark, path)
    z = spark.createDataFrame(list(zeros.items()), "folder string, zero_byte_files long")
    j = agg.join(z, "folder", "full_outer")
    return j.select("folder",
                    (F.coalesce("_files", F.lit(0)) + F.coalesce("zero_byte_files", F.lit(0))).alias("files"),
                    F.coalesce("bytes", F.lit(0)).alias("bytes"),
                    F.coalesce("zero_byte_files", F.lit(0)).alias("zero_byte_files"), "last_modified")


class StageCounter:
    """Row counts per stage collected with ``DataFrame.observe`` during the
    write jobs themselves (no extra ``count()`` passes)."""

    def __init__(self) -> None:
        self.obs: dict[str, Observation] = {}

    def tap(self, df: DataFrame, stage: str) -> DataFrame:
        o = Observation(f"{stage}_{uuid.uuid4().hex[:8]}")  # names are unique per session
        self.obs[stage] = o
        return df.observe(o, F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        return {k: int(v.get.get("rows", 0)) for k, v in self.obs.items()}


def write_run_metadata(spark: SparkSession, path: str, record: dict) -> None:
    """One JSON record per run (name, date, id, status, error, times, counts)."""
    spark.createDataFrame([(json.dumps(record, default=str),)], "value string") \
         .coalesce(1).write.mode("append").text(path)


def write_partner_feed(df: DataFrame, partners: DataFrame, path: str, key: str = "merchant_id") -> None:
    """One output folder per partner (partner map joined by key; whether
    the map is broadcast is the planner's choice)."""
    out = df.join(partners.select(key, "partner_id"), key, "inner")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("partner_id").parquet(path))


def read_table_format(spark: SparkSession, path: str, fmt: str = "delta",
                      fallback: str | None = "parquet") -> tuple[DataFrame, str]:
    """Read a layer through a table-format reader (e.g. ``delta``) when its
    data source is on the classpath; otherwise the same call reads ``fallback``
    files at that path.  Returns (frame, format actually used)."""
    try:
        return spark.read.format(fmt).load(path), fmt
    except Exception as e:  # DATA_SOURCE_NOT_FOUND when the connector jar is absent
        if fallback is None or "DATA_SOURCE_NOT_FOUND" not in str(e) and "Failed to find data source" not in str(e):
            raise
        return spark.read.format(fallback).load(path), fallback
