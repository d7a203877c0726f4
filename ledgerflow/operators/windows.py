"""Window operators: lag over aggregates (W1), rolling time frames (W4),
consecutive-period tests (W7), time spines and top-k per group (T4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_lag_change(daily: DataFrame, order_col: str, value_col: str,
                    change_col: str, growth_col: str) -> DataFrame:
    """Day-on-day change and growth % of an already aggregated series.

    The input has one row per period (bounded by the calendar, not by data
    volume), so the un-partitioned ordered window runs on a small frame.
    """
    w = Window.orderBy(order_col)
    prev = F.lag(value_col).over(w)
    return (daily.withColumn("_prev", prev)
            .withColumn(change_col, F.col(value_col) - F.col("_prev"))
            .withColumn(growth_col, F.round(F.try_divide(F.col(value_col) - F.col("_prev"),
                                                          F.col("_prev")) * 100, 2))
            .drop("_prev"))


def rolling_sum(df: DataFrame, key: str, ts: str, value: str, width_seconds: int,
                out_col: str, fine_seconds: int = 60) -> DataFrame:
    """Per-row sum of ``value`` over (ts - width, ts] within ``key``.

    Two levels, without subtracting (so floats lose nothing): a frame is the own
    ``fine`` block's rows up to ``ts``, the whole blocks before it, and those rows of the block one
    width back that are younger than ``ts - width``. Whole blocks are summed once,
    combined map-side, and a range frame over these sums (one row a key and block) gives the middle.
    The other two are running sums inside a block, the last over copies of the
    rows moved on by the width. So a key, or one width of a key, that
    holds most rows spreads over its fine blocks; each row appears twice and the cost is linear.
    Rows without a time form one frame per key. ``fine`` must divide the width.
    """
    if width_seconds % fine_seconds:
        raise ValueError("fine_seconds must divide width_seconds")
    width_us, fine_us = F.lit(width_seconds * 1_000_000), F.lit(fine_seconds * 1_000_000)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    own = df.withColumn("_us", us).withColumn("_own", F.lit(1))
    halo = own.where(F.col("_us").isNotNull()).withColumn("_us", F.col("_us") + width_us).withColumn("_own", F.lit(0))
    both = own.unionByName(halo).withColumn("_blk", F.floor(F.col("_us") / fine_us))
    block = Window.partitionBy(key, "_blk")
    front = block.orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # own rows first among equal times: a row exactly ``width`` old is outside the frame
    back = block.orderBy(F.desc("_us"), F.desc("_own")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = F.sum(F.when(F.col("_own") == 1, F.col(value))).over(front)
    b = F.sum(F.when(F.col("_own") == 0, F.col(value))).over(back)
    rows = both.withColumn("_a", a).withColumn("_b", b).where(F.col("_own") == 1)
    whole = (df.select(F.col(key).alias("_k"), F.floor(us / fine_us).alias("_m"), F.col(value).alias("_v")).where("_m is not null")
             .groupBy("_k", "_m").agg(F.sum("_v").alias("_s")))
    middle = Window.partitionBy("_k").orderBy("_m").rangeBetween(1 - width_seconds // fine_seconds, -1)
    whole = whole.withColumn("_c", F.sum("_s").over(middle)).drop("_s")
    j = rows.join(whole, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_blk") == F.col("_m")), "left")
    parts = [F.col("_a"), F.col("_b"), F.col("_c")]
    some = F.coalesce(*parts).isNotNull()
    total = sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0)))
    return (j.withColumn(out_col, F.when(some, total)).drop("_us", "_blk", "_own", "_a", "_b", "_c", "_k", "_m"))


def time_spine(df: DataFrame, ts: str, step: str, start: Column | None = None,
               end: Column | None = None, col_name: str = "bucket") -> DataFrame:
    """Gap-free bucket spine from min to max bucket (bounded by time, not rows).
    With both bounds given, ``df`` is not read."""
    def steps(bounds: DataFrame) -> DataFrame:
        return bounds.select(F.explode(F.sequence("lo", "hi", F.expr(f"interval {step}"))).alias(col_name))

    if start is not None and end is not None:
        return steps(df.sparkSession.range(1).select(start.alias("lo"), end.alias("hi")))
    trunc_unit = {"1 minute": "minute", "1 hour": "hour", "1 day": "day"}.get(step)
    if trunc_unit:
        b = F.date_trunc(trunc_unit, F.col(ts).cast("timestamp"))
    else:
        b = F.window(F.col(ts).cast("timestamp"), step).start
    bounds = df.agg(F.min(b).alias("lo"), F.max(b).alias("hi"))
    if start is not None:
        bounds = bounds.withColumn("lo", start)
    if end is not None:
        bounds = bounds.withColumn("hi", end)
    return steps(bounds)


def consecutive_breach(series: DataFrame, order_col: str, breach: Column, periods: int,
                       out_col: str = "alarm", partition: Sequence[str] = ()) -> DataFrame:
    """Alarm when the breach condition holds for ``periods`` consecutive rows."""
    w = Window.partitionBy(*partition).orderBy(order_col) if partition else Window.orderBy(order_col)
    flagged = series.withColumn("_b", breach.cast("int"))
    run = F.lit(True)
    for k in range(1, periods):
        run = run & (F.coalesce(F.lag("_b", k).over(w), F.lit(0)) == 1)
    return flagged.withColumn(out_col, (F.col("_b") == 1) & run).drop("_b")


def top_values_per_column(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """T4: top-k most frequent values per column (ties broken by value).

    Unpivot -> count per (column, value), combined map-side.  Ranking all
    distinct values of a high-cardinality column in one window partition
    would be one task, so the k-th largest count is found first from the
    count-of-counts histogram (at most sqrt(2N) rows per column), and only
    values at or above it are ranked.
    """
    long = df.select(*[F.col(c).cast("string") for c in columns]).unpivot(
        [], list(columns), "column_name", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("value_count"))
    return top_k_by_count(counts, "column_name", "value", "value_count", k, "value_rank")


def top_k_by_count(counts: DataFrame, group: str, item: str, count_col: str, k: int,
                   rank_col: str, salt_buckets: int = 256) -> DataFrame:
    """Exact top-k items per group from a (group, item, count) frame."""
    hist = counts.groupBy(group, count_col).agg(F.count(F.lit(1)).alias("_n"))
    cw = (Window.partitionBy(group).orderBy(F.desc(count_col))
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    thr = (hist.withColumn("_cum", F.sum("_n").over(cw)).where(F.col("_cum") >= k)
           .groupBy(group).agg(F.max(count_col).alias("_thr")))
    cand = counts.join(thr, group, "left").where(F.col(count_col) >= F.coalesce(F.col("_thr"), F.lit(0)))
    # Many items can tie at the threshold count: rank inside salted sub-groups
    # first (the top-k of a group is contained in the union of its sub-groups'
    # top-k), so no window partition holds more than a slice of the ties.
    salt = F.pmod(F.xxhash64(F.col(item)), F.lit(salt_buckets))
    cand = cand.withColumn("_salt", salt).withColumn("_p", F.row_number().over(
        Window.partitionBy(group, "_salt").orderBy(F.desc(count_col), F.asc(item)))).where(F.col("_p") <= k)
    w = Window.partitionBy(group).orderBy(F.desc(count_col), F.asc(item))
    return (cand.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
            .drop("_thr", "_salt", "_p"))
