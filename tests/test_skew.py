"""Hot-key inputs (one key holds a third of all rows): skew-safe operators give
brute-force results, and their plans combine map-side where claimed."""

import datetime as dt
import random
import time

import pandas as pd
from pyspark.sql import functions as F

from ledgerflow.operators import quality as Q
from ledgerflow.operators import silver, windows
from ledgerflow.streaming import ops


def hot_frame(spark, n=3000):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "HOT" if i % 3 == 0 else f"K{rnd.randint(0, 400)}"
        rows.append((key, i, base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 3)), float(rnd.randint(1, 50))))
    return spark.createDataFrame(rows, "k string, seq long, ts timestamp, value double").repartition(6)


def test_keep_latest_hot_key(spark):
    df = hot_frame(spark)
    got = {r.k: r.seq for r in silver.keep_latest(df, "k", ["ts", "seq"]).collect()}
    pdf = df.toPandas().sort_values(["ts", "seq"]).groupby("k").tail(1)
    assert got == dict(zip(pdf.k, pdf.seq))
    plan = silver.keep_latest(df, "k", ["ts", "seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan                      # combined before the shuffle


def test_duplicate_flags_hot_and_null_keys(spark):
    df = hot_frame(spark).withColumn("k", F.when(F.col("seq") % 7 == 0, F.lit(None)).otherwise(F.col("k")))
    flagged = Q.with_duplicate_flags(df, ["k"]).select("seq", "__dup_k").toPandas()
    pdf = df.toPandas()
    dup = pdf.k.duplicated(keep=False)                 # pandas treats NULLs as equal keys, as the rule says
    assert dict(zip(flagged.seq, flagged["__dup_k"])) == dict(zip(pdf.seq, dup))


def test_rolling_sum_hot_key(spark):
    df = hot_frame(spark)
    got = {r.seq: r.v for r in windows.rolling_sum(df, "k", "ts", "value", 4 * 3600, "v").collect()}
    pdf = df.toPandas()
    for _, r in pdf.sample(60, random_state=1).iterrows():
        m = pdf[(pdf.k == r.k) & (pdf.ts > r.ts - pd.Timedelta(hours=4)) & (pdf.ts <= r.ts)]
        assert abs(got[r.seq] - m.value.sum()) < 1e-9


def test_rolling_sum_edges(spark):
    t = dt.datetime
    rows = [("a", 1, t(2024, 1, 1, 0, 0), 1.0), ("a", 2, t(2024, 1, 1, 4, 0), 2.0), ("a", 3, t(2024, 1, 1, 3, 59, 59), 4.0),
            ("a", 4, t(2024, 1, 1, 4, 0), 8.0), ("a", 5, None, 16.0), ("a", 6, None, 32.0), ("a", 7, t(2024, 1, 1, 6, 0), None),
            ("b", 8, t(2024, 1, 1, 6, 0), None), (None, 9, t(2024, 1, 1, 6, 0), 3.0)]
    df = spark.createDataFrame(rows, "k string, seq long, ts timestamp, value double")
    got = {r.seq: r.v for r in windows.rolling_sum(df, "k", "ts", "value", 4 * 3600, "v").collect()}
    assert got == {1: 1.0, 2: 14.0, 3: 5.0, 4: 14.0, 5: 48.0, 6: 48.0, 7: 14.0, 8: None, 9: 3.0}


def test_rolling_sum_one_key_is_linear(spark):
    """All rows of one key in one block; a quadratic frame takes minutes here."""
    n = 200_000
    df = spark.range(n).select(F.lit("k").alias("k"), "id", (F.lit(1704067200) + F.col("id") % 14000).cast("timestamp").alias("ts"), F.lit(1.0).alias("value"))
    start = time.monotonic()
    top = windows.rolling_sum(df, "k", "ts", "value", 4 * 3600, "v").agg(F.max("v")).first()[0]
    assert top == n and time.monotonic() - start < 60


def test_sessions_hot_key(spark):
    df = hot_frame(spark)
    got = sorted(map(tuple, ops.sessions_blocked(df, "ts", "30 minutes", ["k"]).collect()))
    ref = df.groupBy(F.session_window("ts", "30 minutes").alias("s"), "k").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("value_sum")).select(
        "k", F.col("s.start"), F.col("s.end"), "events", "value_sum")
    assert got == sorted(map(tuple, ref.collect()))


def test_top_k_many_ties(spark):
    rows = [("c", f"v{i:04d}") for i in range(2000)] + [("c", "zz")] * 3
    df = spark.createDataFrame(rows, "g string, item string")
    counts = df.groupBy("g", "item").agg(F.count(F.lit(1)).alias("n"))
    got = [r.item for r in windows.top_k_by_count(counts, "g", "item", "n", 5, "rk").orderBy("rk").collect()]
    assert got == ["zz", "v0000", "v0001", "v0002", "v0003"]
