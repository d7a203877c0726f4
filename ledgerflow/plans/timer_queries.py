"""Queries that run a stream over the event files to their end and read what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import derived, ledger
from ..sources.tables import read_table
from ..streaming import timers
from ..streaming.runner import run_available_now
from .oracle import with_ctes
from .recovery_queries import LOADED
from .registry import register


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files as a stream; a pattern, so that the table may be one file or a folder."""
    raw = spark.readStream.schema(read_table(spark, sf_dir, "events").schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(spark: SparkSession, out: DataFrame, name: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerflow-streams/{name}-{uuid.uuid4().hex}"
    run_available_now(out, path, name)
    return spark.read.schema(out.schema).parquet(path)


@register("r6_zero_load_stream", ids=("R6", "R7", "W7", "X8"), sql=with_ctes("ev", LOADED + """
, wm AS (SELECT time_bucket(INTERVAL 5 MINUTE, MAX(ts) - INTERVAL 10 MINUTE) AS upto FROM loaded),
c AS (SELECT event_type AS source, time_bucket(INTERVAL 5 MINUTE, ts) AS bucket FROM loaded GROUP BY 1, 2),
first AS (SELECT source, MIN(bucket) AS f FROM c, wm WHERE bucket < upto GROUP BY 1),
spine AS (SELECT source, UNNEST(generate_series(f, upto - INTERVAL 5 MINUTE, INTERVAL 5 MINUTE)) AS bucket FROM first, wm),
j AS (SELECT s.source, s.bucket, c.bucket IS NULL AS empty FROM spine s LEFT JOIN c ON s.source = c.source AND s.bucket = c.bucket),
r AS (SELECT *, SUM(CASE WHEN empty THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY bucket) AS run FROM j),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source, run ORDER BY bucket) - 1 AS empty_buckets FROM r)
SELECT source, bucket, empty_buckets FROM n WHERE empty AND empty_buckets >= 2"""))
def q_zero_load_stream(spark, sf):
    timers.use_rocksdb(spark)
    return _drained(spark, timers.zero_load_stream(derived.loaded_events(event_stream(spark, sf)), "event_type", "ts"), "zero-load")


@register("x7_divergence_stream", ids=("X7", "R5"), sql=with_ctes("ev", LOADED + """
, wm AS (SELECT LEAST((SELECT MAX(ts) FROM ev), (SELECT MAX(ts) FROM loaded)) - INTERVAL 10 MINUTE AS upto),
s AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS bucket, COUNT(*) AS source_rows FROM ev GROUP BY 1),
t AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS bucket, COUNT(*) AS target_rows FROM loaded GROUP BY 1)
SELECT s.bucket, s.source_rows, COALESCE(t.target_rows, 0) AS target_rows,
       ROUND((s.source_rows - COALESCE(t.target_rows, 0)) * 100.0 / s.source_rows, 4) AS divergence_pct,
       ROUND((s.source_rows - COALESCE(t.target_rows, 0)) * 100.0 / s.source_rows, 4) > 5.0 AS alarm
FROM s LEFT JOIN t ON s.bucket = t.bucket, wm WHERE s.bucket + INTERVAL 10 MINUTE <= wm.upto"""))
def q_divergence_stream(spark, sf):
    ev = event_stream(spark, sf)
    return _drained(spark, timers.divergence_stream(ev, derived.loaded_events(event_stream(spark, sf)), "ts"), "divergence")


SECOND_DROP = "2024-01-20 00:00:00"


@register("x8_late_ledger", ids=("X8", "X5", "X2"), sql=with_ctes("ev", f"""
, d AS (SELECT *, CASE WHEN ts >= TIMESTAMP '{SECOND_DROP}' OR event_id % 50 = 0 THEN 2 ELSE 1 END AS delivery FROM ev),
wm AS (SELECT MAX(ts) - INTERVAL 10 MINUTE AS upto FROM d WHERE delivery = 1),
x AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, delivery = 2 AND time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= upto AS late FROM d, wm)
SELECT window_start, COUNT(*) FILTER (NOT late) AS events, COUNT(*) FILTER (late) AS late FROM x GROUP BY 1"""))
def q_late_ledger(spark, sf):
    """Two deliveries of the events, the stream stopped in between; every 50th event of the first span comes with the second."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerflow-late/{uuid.uuid4().hex}"
    ev = ledger.events(spark, sf)
    second = (F.col("ts") >= F.lit(SECOND_DROP).cast("timestamp")) | (F.col("event_id") % 50 == 0)
    for rows in (ev.where(~second), ev.where(second)):
        rows.write.mode("append").parquet(f"{root}/in")
        timers.LateLedger(spark, f"{root}/ledger", "event_id", "ts", "1 hour").run(spark.readStream.schema(ev.schema).parquet(f"{root}/in"), "late-ledger")
    done = timers.LateLedger(spark, f"{root}/ledger", "event_id", "ts", "1 hour")
    w = F.window("ts", "1 hour").start
    late = done.late() if done.late() is not None else ev.limit(0)
    both = done.windows().withColumn("late", F.lit(0)).unionByName(late.groupBy(w.alias("window_start")).agg(F.count("*").alias("late")).withColumn("events", F.lit(0)))
    return both.groupBy("window_start").agg(F.sum("events").alias("events"), F.sum("late").alias("late"))
