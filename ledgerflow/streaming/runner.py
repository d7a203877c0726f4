"""Structured Streaming runners (X1, X5, X7, X8): file sources, availableNow
triggers, foreachBatch idempotent loading.  Checkpoints live under the
session's checkpoint folder (shared storage on a cluster)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File-stream ingest with the contract schema; JSON keeps unreadable
    records in ``_corrupt_record``."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def checkpoint_location(spark: SparkSession, name: str, sink: str = "") -> str:
    """The same for the same stream and sink, so that a restart resumes where it stopped."""
    tail = f"-{hashlib.sha256(sink.encode()).hexdigest()[:12]}" if sink else ""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}{tail}"


def run_available_now(df: DataFrame, sink_path: str, name: str, mode: str = "append",
                      fmt: str = "parquet") -> dict:
    """Drain everything available now into a file sink; returns the last progress
    (incl. ``numRowsDroppedByWatermark`` of stateful operators: X8)."""
    spark = df.sparkSession
    q = (df.writeStream.format(fmt).outputMode(mode).option("path", sink_path)
         .option("checkpointLocation", checkpoint_location(spark, name, sink_path))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    progress = q.lastProgress or {}
    return progress


def dropped_by_watermark(progress: dict) -> int:
    return sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in progress.get("stateOperators", []))


def loader(target_path: str, quarantine_path: str, key: str, run_ts: str, log: list | None = None):
    """foreachBatch body: repair -> route -> quarantine -> insert-only merge.

    Idempotent per batch: the merge skips keys already in the target, so a
    micro-batch replayed after a failure loads nothing twice."""
    from ..operators.recovery import recover

    def body(batch: DataFrame, batch_id: int) -> None:
        stats = recover(batch.sparkSession, batch, target_path, f"{quarantine_path}/batch={batch_id}", key,
                        run_ts, source_name=f"stream-batch-{batch_id}")
        if log is not None:
            log.append({"batch_id": batch_id, **stats})
    return body


def run_foreach_batch(df: DataFrame, body, name: str, sink: str = "") -> None:
    """Drains what is there; ``name`` and ``sink`` (where the body writes) name the checkpoint of the stream."""
    spark = df.sparkSession
    q = (df.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint_location(spark, name, sink))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def divergence_sink_check(source_counts: DataFrame, sink_path: str, ts: str, step: str = "10 minutes",
                          threshold_pct: float = 5.0) -> DataFrame:
    """Closed-window source counts (a drained stream result) vs the sink table."""
    spark = source_counts.sparkSession
    sink = spark.read.parquet(sink_path)
    t = sink.groupBy(F.window(F.col(ts).cast("timestamp"), step).start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("sink_rows"))
    j = source_counts.join(t, "window_start", "left").withColumn("sink_rows", F.coalesce("sink_rows", F.lit(0)))
    pct = F.round((F.col("events") - F.col("sink_rows")) * 100.0 / F.col("events"), 4)
    return j.withColumn("divergence_pct", pct).withColumn("alarm", F.col("divergence_pct") > threshold_pct)
