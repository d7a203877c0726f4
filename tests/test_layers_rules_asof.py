"""As-of joins, layer differences, rule tables and rolling sums against brute force; a hot key over many tasks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.asof import asof_join
from ledgerflow.operators.layers import layer_diff
from ledgerflow.operators.recovery import error_fingerprints
from ledgerflow.operators.rules import RULE_SCHEMA, RULES, evaluate, rule_summary, rule_table
from ledgerflow.operators.windows import rolling_sum
from ledgerflow.streaming import ops

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof(spark, direction):
    r = random.Random(2)
    at = lambda: r.choice([None, *[T0 + timedelta(minutes=r.randrange(5000)) for _ in range(12)]])
    left = [(k, r.choice(["a", "a", "b", None]), at()) for k in range(400)]
    right = [(r.randrange(9), r.choice(["a", "a", "c", None]), at()) for _ in range(150)]
    left.append((999, "c", T0 - timedelta(days=400)))
    out = asof_join(spark.createDataFrame(left, "k long, u string, ts timestamp"), spark.createDataFrame(right, "v long, u string, ts timestamp"), "ts", "ts", ["u"], direction)
    got = {x.k: x.match and (x.match.ts, x.match.v) for x in out.collect()}
    for k, u, t in left:
        near = [(b, v) for v, w, b in right if u is not None and w == u and b is not None and t is not None and (b <= t if direction == "backward" else b >= t)]
        assert got[k] == (None if not near else max(near) if direction == "backward" else min(near))
    assert len(got) == len(left)
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_layer_diff(spark):
    a = [("1", 5, "x"), ("2", 5, None), ("3", 6, "x"), ("3", 6, "x"), ("3", 2, "y"), (None, 1, "x"), ("4", None, None)]
    b = [("1", 5, "x"), ("2", 5, "z"), ("3", 7, "x"), ("9", 1, "q"), ("9", 1, "q"), ("4", None, None)]
    schema = "id string, v long, s string"
    got = {(r.measure, r.column_name): (r.rows, r.share) for r in layer_diff(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), "id", ["v", "s"]).collect()}
    assert got == {("left_keys", None): (4, None), ("right_keys", None): (5, None), ("dropped", None): (0, 0.0), ("added", None): (1, 0.2), ("changed", None): (2, 0.5), ("same", None): (2, 0.5),
                   ("left_copies", None): (2, None), ("right_copies", None): (1, None), ("left_null_keys", None): (1, None), ("right_null_keys", None): (0, None),
                   ("drifted", "v"): (1, 0.25), ("drifted", "s"): (1, 0.25)}
    none = layer_diff(spark.createDataFrame([], schema), spark.createDataFrame([], schema), "id", ["v"])
    assert {r.rows for r in none.collect()} == {0}


def test_rules(spark):
    values = {"freshness_hours": [3, 24, 25], "quality_pct": [100, 99.9, 99.87, 80], "daily_row_count": [16, 17, 18, 20, 24, 26], "runtime_minutes": [5, 110, 121],
              "row_count_change_pct": [0, -21, 20, 20.5], "merchant_failure_pct": [30, 30.01], "unknown_method_rows": [0, 4]}
    m = spark.createDataFrame([(k, f"s{v}", float(v)) for k, vs in values.items() for v in vs], "metric string, subject string, value double")
    got = {r.rule: (r.subjects, r.fired) for r in rule_summary(evaluate(m, rule_table(spark))).collect()}
    assert got == {"data_freshness_breached": (3, 1), "quality_threshold_breached": (4, 2), "row_count_out_of_bounds": (6, 2), "runtime_approaching_limit": (3, 1), "quality_slightly_below_threshold": (4, 1),
                   "merchant_failure_rate_spike": (2, 1), "new_payment_method_detected": (2, 1), "row_count_near_bounds": (6, 3), "data_freshness_slo": (3, 1), "quality_threshold_slo": (4, 2),
                   "row_count_slo": (4, 2), "pipeline_runtime_slo": (3, 1)}
    assert all(0 < f < n for n, f in got.values()) and len(RULES) == 12  # each fires and stays silent somewhere
    own = spark.createDataFrame([("ALERT", "INFO", "mine", "none", "gt", None, 1.0), ("ALERT", "INFO", "odd", "runtime_minutes", "??", None, 1.0), ("ALERT", "INFO", "lost", "gone", "lt", 1.0, None)], RULE_SCHEMA)
    seen = {(r.rule, r.subject): r.fired for r in evaluate(m.unionByName(spark.createDataFrame([("gone", "x", None)], m.schema)), own).collect()}
    assert seen[("mine", None)] is None and seen[("odd", "s5")] is None and seen[("lost", "x")] is True


def test_last_fix_that_worked(spark):
    log = spark.createDataFrame([("E at /a/b.py:3", "x = 1", "old", 1, True), ("E at /a/c.py:9", "x = 1", "bad", 2, False), ("F", "y", "no", 3, False)], "e string, c string, fix string, at long, ok boolean")
    got = {r.occurrences: (r.last_seen, r.last_fix) for r in error_fingerprints(log, "e", "c", "fix", "at", "ok").collect()}
    assert got == {2: (2, "old"), 1: (3, None)}


def test_rolling_two_levels(spark):
    r = random.Random(9)
    rows = [(r.choice(["hot", "hot", "b", None]), T0 + timedelta(seconds=r.randrange(8 * 3600), microseconds=r.choice([0, 500000])), r.randrange(1, 100)) for _ in range(1500)]
    rows += [("hot", T0 + timedelta(hours=4), 1), ("hot", T0, 10**6), ("hot", None, 3), ("hot", None, 4)]
    df = spark.createDataFrame([(*x, n) for n, x in enumerate(rows)], "k string, ts timestamp, v long, n long")
    got = {x.n: x.s for x in rolling_sum(df, "k", "ts", "v", 4 * 3600, "s").collect()}
    for n, (k, t, _) in enumerate(rows):
        if t is not None:
            assert got[n] == sum(v for k2, u, v in rows if k2 == k and u is not None and t - timedelta(hours=4) < u <= t)
    assert got[len(rows) - 1] == 7 == got[len(rows) - 2]


def test_one_block_spreads(spark):
    hot = spark.range(200_000).select(F.lit("k").alias("k"), (F.lit(T0).cast("timestamp") + F.expr("make_interval(0,0,0,0,0,0,id % 14400)")).alias("ts"), F.lit(1).alias("v"))
    out = rolling_sum(hot, "k", "ts", "v", 4 * 3600, "s")
    assert out.agg(F.max("s")).first()[0] == 200_000
    sizes = [len(p) for p in out.select("v").rdd.glom().collect()]
    assert sum(x > 0 for x in sizes) > 1 and max(sizes) < 150_000  # one key, one window, many tasks


def test_sliding_sums_buckets(spark):
    r = random.Random(1)
    rows = [(r.randrange(3), T0 + timedelta(minutes=r.randrange(600)), float(r.randrange(50))) for _ in range(500)]
    df = spark.createDataFrame(rows, "u long, ts timestamp, value double")
    got = {(x.u, x.window_start): (x.events, x.value_sum) for x in ops.sliding(df, "ts", "1 hour", "5 minutes", ["u"]).collect()}
    for (u, w), (n, s) in got.items():
        inside = [v for a, t, v in rows if a == u and w <= t < w + timedelta(hours=1)]
        assert (n, s) == (len(inside), sum(inside))
    assert sum(n for n, _ in got.values()) == 12 * 500
