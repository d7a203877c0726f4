"""Stream operators (X2-X4, X6, X8, X9).  Each works on a streaming or a
batch DataFrame, so every stream has a batch twin to compare against."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_event_time(df: DataFrame, ts: str = "ts", delay: str | None = "10 minutes") -> DataFrame:
    """Event time as TIMESTAMP with a watermark (X8: rows later than ``delay``
    behind the max seen event time are dropped by stateful operators)."""
    out = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return out.withWatermark(ts, delay) if delay and out.isStreaming else out


def tumbling(df: DataFrame, ts: str, size: str, by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Tumbling window counts and value sums."""
    g = df.groupBy(F.window(ts, size).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum(value), 2).alias("value_sum"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                    "events", "value_sum")


def sliding(df: DataFrame, ts: str, size: str, slide: str, by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Sliding windows. Batch frames are summed by slide first (``_sliding_sums``); a stream's
    rows are copied into their size/slide windows, as its state is one aggregate."""
    if not df.isStreaming:
        return _sliding_sums(df, ts, size, slide, by, value)
    g = df.groupBy(F.window(ts, size, slide).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum(value), 2).alias("value_sum"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                    "events", "value_sum")


def _sliding_sums(df: DataFrame, ts: str, size: str, slide: str, by: Sequence[str], value: str) -> DataFrame:
    """Sliding windows of a batch frame, without shuffling a copy of a bucket for each of its windows.

    A window starts in one block of ``size``, so it holds buckets of that block and the next: each bucket goes to two
    blocks. In a block of a key the windows' content only changes where a bucket comes in or drops out;
    it is summed there (no subtraction, floats lose nothing), and then stands for all windows up to the next change."""
    width, step = df.sparkSession.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {size}), unix_micros(timestamp_micros(0) + INTERVAL {slide})").first()
    back = (width - 1) // step * step  # from a bucket to the first window that holds it
    per = df.groupBy(F.window(ts, slide).start.alias("_b"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("v"))
    time, of = per.schema["_b"].dataType, per.schema["v"].dataType
    us = F.unix_micros(F.col("_b").cast("timestamp"))
    own = F.col("_us") - F.pmod(F.col("_us"), F.lit(width))
    per = per.select(*by, us.alias("_us"), "n", "v").select(*by, F.explode(F.array(own, own - width)).alias("_block"), F.struct(F.col("_us").alias("b"), "n", "v").alias("x"))
    last = F.col("_block") + width - 1
    last = last - F.pmod(last, F.lit(step))
    per = per.where(F.col("x.b") - back <= last).groupBy("_block", *by).agg(F.collect_list("x").alias("x"))
    first = F.col("_block") + F.pmod(-F.col("_block"), F.lit(step))
    turns = F.concat(F.array(first), F.transform("x", lambda x: x["b"] - back), F.transform("x", lambda x: x["b"] + step))
    per = per.withColumn("x", F.array_sort("x")).withColumn("_at", F.array_sort(F.array_distinct(F.filter(turns, lambda s: (s >= first) & (s <= last)))))
    none = lambda s: F.struct(s.alias("s"), F.lit(0).cast("long").alias("n"), F.lit(None).cast(of).alias("v"))

    def add(a, x):
        held = (x["b"] - back <= a["s"]) & (a["s"] <= x["b"])
        v = F.coalesce((a["v"] + x["v"]).cast(of), a["v"], x["v"])
        return F.when(held, F.struct(a["s"].alias("s"), (a["n"] + x["n"]).alias("n"), v.alias("v"))).otherwise(a)

    sums = F.transform("_at", lambda s, k: F.struct(F.aggregate("x", none(s), add).alias("w"), F.coalesce(F.get("_at", k + 1) - step, last).alias("until")))
    runs = per.select(*by, F.inline(sums)).where("w.n > 0")
    g = runs.select(*by, F.explode(F.sequence("w.s", "until", F.lit(step))).alias("s"), F.col("w.n").alias("events"), F.round("w.v", 2).alias("value_sum"))
    at = lambda c: F.timestamp_micros(c).cast(time)
    return g.select(at(F.col("s")).alias("window_start"), at(F.col("s") + width).alias("window_end"), *by, "events", "value_sum")


def dedup_replays(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Drop replayed duplicates; streaming keeps keys only within the watermark."""
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark([key])
    from ..operators.silver import keep_first
    return keep_first(df, key, [ts])


def sessions(df: DataFrame, ts: str, gap: str, by: Sequence[str], value: str = "value") -> DataFrame:
    """X9 (our addition): session windows per key.

    Streams use ``session_window`` state.  Batch frames go through
    ``sessions_blocked``, which never sorts one key's whole history in a task.
    """
    if not df.isStreaming:
        return sessions_blocked(df, ts, gap, by, value)
    g = df.groupBy(F.session_window(ts, gap).alias("s"), *by).agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum(value), 2).alias("value_sum"))
    return g.select(*by, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "events", "value_sum")


def enrich_static(stream: DataFrame, dim: DataFrame, key_left: str, key_right: str,
                  attrs: Sequence[str]) -> DataFrame:
    """Stream-static left join to a dimension (the static side is re-read
    per micro-batch; hint broadcast only when it is size-checked by the caller)."""
    d = dim.select(F.col(key_right).alias(key_left), *attrs)
    return stream.join(d, key_left, "left")


def sessions_blocked(df: DataFrame, ts: str, gap: str, by: Sequence[str], value: str = "value",
                     block: str = "hour") -> DataFrame:
    """Batch sessions (same result as ``session_window``), skew-safe.

    1. Rows are sessionised inside (key, time block): a window per block, so a
       key holding a third of all rows is spread over its days.
    2. One summary row per (key, block) (first/last time, internal breaks) is
       ordered per key -- bounded by the calendar, not by rows -- to find which
       block boundaries start a new session and each block's session offset.
    3. Global session number = block offset + local number; the final
       aggregate is a hash aggregate (map-side combined).
    """
    gap_us = F.expr(f"INTERVAL {gap}")
    keys = list(by)
    t = df.withColumn(ts, F.col(ts).cast("timestamp")).withColumn("_blk", F.date_trunc(block, ts))
    wb = Window.partitionBy(*keys, "_blk").orderBy(ts)
    prev = F.lag(ts).over(wb)
    # same rule as session_window: a row joins the session when it starts at or
    # before the session's end (previous row + gap)
    t = t.withColumn("_brk", F.when(prev.isNull() | (F.col(ts) > prev + gap_us), 1).otherwise(0))
    t = t.withColumn("_local", F.sum("_brk").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
    summ = t.groupBy(*keys, "_blk").agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"),
                                        F.max("_local").alias("_n_local"))
    wk = Window.partitionBy(*keys).orderBy("_blk")
    starts_new = F.when(F.lag("_last").over(wk).isNull() | (F.col("_first") > F.lag("_last").over(wk) + gap_us),
                        1).otherwise(0)
    summ = summ.withColumn("_new", starts_new)
    # sessions completed before this block: all local sessions of earlier blocks,
    # minus one for every earlier block whose first session continued its predecessor
    summ = summ.withColumn("_cont", 1 - F.col("_new"))
    run = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_offset", F.coalesce(F.sum("_n_local").over(run), F.lit(0))
                           - F.coalesce(F.sum("_cont").over(run), F.lit(0)) - F.col("_cont"))
    j = t.join(summ.select(*keys, "_blk", "_offset"), [*keys, "_blk"], "inner")
    j = j.withColumn("_sid", F.col("_offset") + F.col("_local"))
    g = j.groupBy(*keys, "_sid").agg(F.min(ts).alias("session_start"), F.max(ts).alias("_last_ts"),
                                     F.count(F.lit(1)).alias("events"), F.round(F.sum(value), 2).alias("value_sum"))
    return g.select(*keys, "session_start", (F.col("_last_ts") + gap_us).alias("session_end"), "events", "value_sum")
