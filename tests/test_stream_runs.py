"""Streams run for real, stopped and gone on with, against their batch twins on closed windows."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import recovery as R
from ledgerflow.sources import derived, ledger
from ledgerflow.streaming import ops, timers
from ledgerflow.streaming.runner import run_available_now

from .conftest import SF_SMALL

CUT = "2024-01-16 03:00:00"


@pytest.fixture(scope="module")
def ev(spark):
    timers.use_rocksdb(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield ledger.events(spark, SF_SMALL).cache()
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def drops(ev):
    at = F.lit(CUT).cast("timestamp")
    return [ev.where(F.col("ts") < at), ev.where(F.col("ts") >= at)]


def run(spark, ev, folder, name, make):
    """Two deliveries, a run after each from the same checkpoint."""
    for rows in drops(ev):
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(ev.schema).parquet(f"{folder}/in")
        out = make(stream)
        run_available_now(out, f"{folder}/out", f"{name}-{folder[-6:]}")
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


def rows(df):
    return sorted(map(str, df.collect()))


def test_zero_load_by_timers(spark, ev, tmp_dir):
    loaded = derived.loaded_events(ev)
    got = run(spark, loaded, tmp_dir, "zero", lambda s: timers.zero_load_stream(s.withColumn("source", F.lit("sink")), "source", "ts"))
    first, last = loaded.agg(F.min("ts"), F.max("ts")).first()
    end = last.timestamp() - 600 - (last.timestamp() - 600) % 300
    start = F.from_unixtime(F.lit(first.timestamp() - first.timestamp() % 300))
    want = R.zero_load_alarm(loaded, "ts", "2024-01-01 00:00:00", "2024-01-31 00:00:00").where("alarm").where(F.col("bucket") >= start.cast("timestamp") + F.expr("interval 10 minutes"))
    want = want.where(F.unix_timestamp("bucket") < end)
    assert rows(got.select("bucket")) == rows(want.select("bucket")) and got.count() > 10
    assert got.select("bucket").distinct().count() == got.count()  # once each, over the restart


def test_divergence_of_two_streams(spark, ev, tmp_dir):
    got = run(spark, ev, tmp_dir, "div", lambda s: timers.divergence_stream(s, derived.loaded_events(s), "ts"))
    upto = F.lit(ev.agg(F.max("ts")).first()[0]) - F.expr("interval 20 minutes")
    want = R.divergence_alarm(ev, derived.loaded_events(ev), "ts").where(F.col("bucket") <= upto)
    assert rows(got.select(*want.columns)) == rows(want) and got.where("target_rows = 0").count() > 0


@pytest.mark.parametrize("name", ["tumbling", "sliding", "sessions", "enriched", "dedup"])
def test_stream_equals_twin(spark, ev, tmp_dir, name):
    people = ledger.customers(spark, SF_SMALL)
    timed = lambda df: ops.with_event_time(df)
    make = {"tumbling": lambda df: ops.tumbling(timed(df), "ts", "1 hour"),
            "sliding": lambda df: ops.sliding(timed(df), "ts", "1 hour", "15 minutes", ["event_type"]),
            "sessions": lambda df: ops.sessions(timed(df), "ts", "30 minutes", ["user_id"]),
            "enriched": lambda df: ops.tumbling(ops.enrich_static(timed(df), people, "user_id", "customer_id", ["customer_tier"]), "ts", "1 hour", by=["customer_tier"]),
            "dedup": lambda df: ops.dedup_replays(timed(df).unionByName(timed(df)), "event_id", "ts").select("event_id", "ts")}[name]
    got, want = run(spark, ev, tmp_dir, name, make), make(ev)
    upto = F.lit(ev.agg(F.max("ts")).first()[0]) - F.expr("interval 10 minutes")
    closed = {"sessions": "session_end", "dedup": None}.get(name, "window_end")
    if closed:
        got, want = got.where(F.col(closed) <= upto), want.where(F.col(closed) <= upto)
    assert rows(got.select(*want.columns)) == rows(want) and want.count() > 0


def test_late_ledger(spark, ev, tmp_dir):
    slow = F.col("event_id") % 7 == 0
    led = timers.LateLedger(spark, f"{tmp_dir}/ledger", "event_id", "ts")
    for part in (drops(ev)[0].where(~slow), drops(ev)[1].unionByName(drops(ev)[0].where(slow))):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        led.run(spark.readStream.schema(ev.schema).parquet(f"{tmp_dir}/in"), "late")
    n, counted, late = led.totals()
    assert n == ev.count() == counted + late and late == led.late().count() > 0
    assert led.windows().agg(F.sum("events")).first()[0] == counted
    upto = F.lit(drops(ev)[0].where(~slow).agg(F.max("ts")).first()[0]) - F.expr("interval 10 minutes")
    want = drops(ev)[0].where(slow).where(F.window("ts", "5 minutes").end <= upto)
    assert rows(led.late().select("event_id")) == rows(want.select("event_id"))
    led._body(ev, 1)  # a batch that is delivered again
    assert led.totals() == (n, counted, late)
