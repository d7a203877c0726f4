"""Fixture tests: decision accuracy, PII surface, producer check,
custom order, unions, schema set ops, hourly JSON sink, late rows."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.exprs import ordinal
from ledgerflow.operators import governance as G
from ledgerflow.operators import quality as Q
from ledgerflow.operators import recovery as R
from ledgerflow.operators import schema as S
from ledgerflow.sources import files
from ledgerflow.streaming import ops, runner


def test_decision_accuracy(spark):
    df = spark.createDataFrame([("PASS", "PASS", 10, 100), ("QUARANTINE", "PASS", 20, 150), ("FLAG", "FLAG", 5, 50)],
                               "expected string, decision string, latency_ms long, tokens long")
    r = Q.decision_accuracy(df).first()
    assert (r.accuracy, r.decisions, r.total_latency_ms, r.total_tokens) == (0.6667, 3, 35, 300)


def test_pii_surface_and_producer(spark):
    a = spark.createDataFrame([("Asha Rao", "a1@x.example.com")], "full_name string, email string")
    b = spark.createDataFrame([("10.1.2.3",)], "ip string")
    s = {(r.table_name, r.column_name): r.pii_type for r in G.pii_surface({"a": a, "b": b}).collect()}
    assert s == {("a", "full_name"): "full_name", ("a", "email"): "email_address", ("b", "ip"): "ip_address"}
    batch = spark.createDataFrame([("T1", "CornerShop")], "transaction_id string, merchant_nm string")
    v = R.verify_producer(batch, ["transaction_id", "merchant_name"], ["merchant_nm"])
    assert not v["ok"] and v["missing"] == ["merchant_name"] and v["forbidden_present"] == ["merchant_nm"]


def test_custom_order_union_and_column_sets(spark):
    df = spark.createDataFrame([("LOW",), ("CRITICAL",), ("MEDIUM",), ("HIGH",)], "sev string")
    got = [r.sev for r in df.orderBy(ordinal("sev", ["CRITICAL", "HIGH", "MEDIUM", "LOW"])).collect()]
    assert got == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    clean = spark.createDataFrame([("T1", 1.0)], "id string, amount double")
    dirty = spark.createDataFrame([(2.0, "T2", "x")], "amount double, id string, note string")
    u = clean.unionByName(dirty, allowMissingColumns=True)                 # U2
    assert u.count() == 2 and set(u.columns) == {"id", "amount", "note"}
    d = S.detect_drift(clean.schema, dirty.schema)                          # U3 on metadata
    assert set(d.new) == {"note"} and not d.removed


def test_hourly_json_sink(spark, tmp_dir):
    df = spark.createDataFrame([("T1", "2024-01-15 10:05:00"), ("T2", "2024-01-15 11:00:00")], "id string, ts string")
    files.write_json_hourly(df.withColumn("ts", F.to_timestamp("ts")), f"{tmp_dir}/j", "ts")
    assert os.path.isdir(f"{tmp_dir}/j/yyyy=2024/MM=01/dd=15/HH=10")
    assert spark.read.json(f"{tmp_dir}/j").count() == 2


def test_late_rows_dropped_by_watermark(spark, tmp_dir):
    import datetime as dt
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    b1 = spark.createDataFrame([(1, base, 1.0), (2, base + dt.timedelta(minutes=30), 1.0)], "event_id long, ts timestamp, value double")
    b1.write.parquet(f"{tmp_dir}/ev/b1")
    stream = spark.readStream.schema(b1.schema).parquet(f"{tmp_dir}/ev/*")
    agg = ops.tumbling(ops.with_event_time(stream, "ts", "10 minutes"), "ts", "5 minutes")
    ckpt = runner.checkpoint_location(spark, "late-test")

    def run():
        q = (agg.writeStream.format("parquet").outputMode("append").option("path", f"{tmp_dir}/sink")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        return q.recentProgress

    run()
    late = spark.createDataFrame([(3, base - dt.timedelta(minutes=5), 1.0)], "event_id long, ts timestamp, value double")
    late.write.parquet(f"{tmp_dir}/ev/b2")
    progress = run()
    dropped = sum(runner.dropped_by_watermark(p) for p in progress)
    assert dropped == 1                                   # X8: the late row is counted, not aggregated


def test_blocked_sessions_equal_session_window(spark):
    import datetime as dt
    import random
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1, 23, 0, 0)
    rows, eid = [], 0
    for user in (1, 2, 3):
        t = base
        for _ in range(400 if user == 1 else 40):              # user 1 is the hot key
            t += dt.timedelta(minutes=rnd.choice([1, 5, 12, 29, 31, 45, 90]))
            eid += 1
            rows.append((eid, user, t, float(rnd.randint(1, 9))))
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, value double")
    got = sorted(map(tuple, ops.sessions_blocked(df, "ts", "30 minutes", ["user_id"]).collect()))
    ref = df.groupBy(F.session_window("ts", "30 minutes").alias("s"), "user_id").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("value_sum")).select(
        "user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events", "value_sum")
    assert got == sorted(map(tuple, ref.collect()))
    assert any(r[2] - r[1] > dt.timedelta(hours=1) for r in got)     # sessions cross block edges
