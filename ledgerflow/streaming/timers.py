"""Streams that speak when nothing comes (R6, W7), that join (X7, R5) and that account for late rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources.indexed import IndexedTable
from .runner import run_foreach_batch

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class ZeroLoad(StatefulProcessor):
    """Alarms of one source: a bucket without rows whose predecessor had none either.

    State is the next bucket to judge and how many before it were empty. Rows come as
    counted buckets, closed by the watermark; a timer stands at the end of the
    next bucket, so that the alarm is raised by time alone when no row comes.
    """

    def __init__(self, step_ms: int, periods: int):
        self.step, self.periods = step_ms, periods

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("next", "next long, empty long")

    def _judge(self, key, upto: int, loaded: bool) -> list[tuple]:
        """Buckets before ``upto`` are empty; the one at ``upto`` has rows if ``loaded``."""
        at, empty = self.state.get() if self.state.exists() else (upto, 0)
        out = []
        while at < upto:
            empty += 1
            if empty >= self.periods:
                out.append((key[0], pd.Timestamp(at, unit="ms"), empty))
            at += self.step
        if loaded and at == upto:
            at, empty = at + self.step, 0
        self.state.update((at, empty))
        return out

    def _wait(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
        self.handle.registerTimer(self.state.get()[0] + self.step)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        buckets = sorted({int(t.timestamp() * 1000) for part in rows for t in part["bucket"]})
        out = [x for b in buckets for x in self._judge(key, b, True)]
        self._wait()
        yield _alarms(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        out = self._judge(key, (now // self.step) * self.step, False)
        self._wait()
        yield _alarms(out)

    def close(self) -> None:
        pass


def _alarms(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({"source": pd.Series([r[0] for r in rows], dtype=object), "bucket": pd.Series([r[1] for r in rows], dtype="datetime64[ns]"),
                         "empty_buckets": pd.Series([r[2] for r in rows], dtype="int64")})


def zero_load_stream(loaded: DataFrame, source: str, ts: str, step: str = "5 minutes", delay: str = "10 minutes", periods: int = 2) -> DataFrame:
    """R6/W7 on a stream: ``source, bucket, empty_buckets`` of each alarm, from a source's first bucket up to the watermark.

    Rows are first counted per source and bucket, so that the timers' state sees one row a bucket.
    The session needs the RocksDB state store (``use_rocksdb``)."""
    step_ms = int(pd.Timedelta(step).total_seconds() * 1000)
    counted = (loaded.select(F.col(source).cast("string").alias("source"), F.col(ts).cast("timestamp").alias("ts")).withWatermark("ts", delay)
               .groupBy("source", F.window("ts", step)).count().select("source", F.col("window.start").alias("bucket"), F.window_time("window").alias("closed")))
    return counted.groupBy("source").transformWithStateInPandas(
        statefulProcessor=ZeroLoad(step_ms, periods), outputStructType="source string, bucket timestamp, empty_buckets long", outputMode="append", timeMode="EventTime")


def use_rocksdb(spark: SparkSession) -> None:
    """Timers need a state store with column families; a setting that the cluster made is left as it is."""
    if "RocksDB" not in spark.conf.get(PROVIDER, ""):
        spark.conf.set(PROVIDER, ROCKS)


def divergence_stream(source: DataFrame, sink: DataFrame, ts: str, step: str = "10 minutes", delay: str = "10 minutes", threshold_pct: float = 5.0) -> DataFrame:
    """X7/R5 on two streams: counts of both sides per bucket, left outer joined on the bucket.

    Both sides are watermarked, so a bucket comes out once its end is past on both, with the
    sink's count or without; nothing is held beyond that. Buckets without source rows don't breach."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(ts).cast("timestamp").alias("ts")).withWatermark("ts", delay).groupBy(F.window("ts", step)).agg(F.count(F.lit(1)).alias(name))

    s, t = counted(source, "source_rows"), counted(sink, "target_rows").withColumnRenamed("window", "w")
    j = s.join(t, F.col("window") == F.col("w"), "left_outer").withColumn("target_rows", F.coalesce("target_rows", F.lit(0)))
    gap = F.round((F.col("source_rows") - F.col("target_rows")) * 100.0 / F.col("source_rows"), 4)
    return j.select(F.col("window.start").alias("bucket"), "source_rows", "target_rows", gap.alias("divergence_pct"), (gap > threshold_pct).alias("alarm"))


class LateLedger:
    """Window counts of a stream, and every row that came too late for them kept aside.

    The watermark of a micro-batch is the latest event of the batches before it, less the
    delay, as in Structured Streaming. A row whose window ends at or before it would be dropped
    silently there; here it goes to the ledger. Each batch is committed by one marker with its counts, so
    ``rows in = counted + late`` holds over restarts and replays.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, ts: str, size: str = "5 minutes", delay: str = "10 minutes"):
        self.spark, self.root, self.key, self.ts, self.size = spark, root.rstrip("/"), key, ts, size
        self.delay_us = int(pd.Timedelta(delay).total_seconds() * 1_000_000)
        self.table = IndexedTable(spark, self.root, key)

    def _body(self, batch: DataFrame, batch_id: int) -> None:
        name = f"batch/{batch_id}"
        if self.table.marker(name) is not None:
            return
        known = [m["latest_us"] for m in self.table.markers() if m["latest_us"] is not None]
        watermark = F.lit(max(known) - self.delay_us if known else None).cast("long")
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        rows = batch.withColumn("_w", F.window(F.col(self.ts).cast("timestamp"), self.size))
        rows = rows.withColumn("_late", F.coalesce(F.unix_micros("_w.end") <= watermark, F.lit(False)) | F.col("_w").isNull()).checkpoint(eager=True)
        n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("_late").alias("late"), F.max(us).alias("latest")).first()
        part = self.table.part_of(name)
        (rows.where(~F.col("_late")).groupBy(F.col("_w.start").alias("window_start")).agg(F.count(F.lit(1)).alias("events"))
         .write.mode("overwrite").parquet(f"{self.root}/windows/{part}"))
        self.table.append(rows.where("_late").drop("_w", "_late"), name, rows_in=n["n"], late=n["late"], counted=n["n"] - n["late"], latest_us=n["latest"])

    def run(self, stream: DataFrame, name: str) -> None:
        """Takes in what is there; a restart goes on where the stream stopped."""
        run_foreach_batch(stream, self._body, name, self.root)

    def windows(self) -> DataFrame:
        """Counts by window of the rows in time: a sum of the batches' partial counts."""
        paths = [f"{self.root}/windows/{m['part']}" for m in self.table.markers()]
        return self.spark.read.schema("window_start timestamp, events long").parquet(*paths).groupBy("window_start").agg(F.sum("events").alias("events"))

    def late(self) -> DataFrame | None:
        return self.table.read()

    def totals(self) -> tuple[int, int, int]:
        """Rows in, counted and late."""
        return tuple(sum(m[k] for m in self.table.markers()) for k in ("rows_in", "counted", "late"))
