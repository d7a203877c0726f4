"""Loads in batches: equal to a rebuild, only touched files read, replays and crashes change nothing."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import gold
from ledgerflow.operators.incremental import PARTIALS, LedgerState
from ledgerflow.operators.silver import LEDGER_DEDUP_ORDER, keep_latest, silver_filter
from ledgerflow.sources import indexed
from ledgerflow.sources.indexed import IndexedTable, merge_indexed

TXN = "transaction_id string, amount double, status string, merchant_id long, customer_id long, transaction_date date, payment_method string, src_seq long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if a is None else float(a), *r) for i, a, *r in rows], TXN).withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def rows(seed, n, ids, first=date(2024, 1, 1), days=90):
    r = random.Random(seed)
    return [(f"T{r.randrange(ids)}", r.choice([10.5, 20.25, 3, -1, None]), r.choice(["COMPLETED", "FAILED", None]), r.randrange(4), r.choice([1, 2, 3, None]),
             r.choice([first + timedelta(days=r.randrange(days)), None]) if r.random() < 0.9 else None, r.choice(["UPI", "CARD"]), k) for k in range(n)]


def ltv(df):
    done = keep_latest(silver_filter(df), "transaction_id", LEDGER_DEDUP_ORDER)
    return sorted(map(tuple, gold.customer_ltv(done).collect()), key=str), done


def test_batches_equal_rebuild(spark, tmp_dir):
    batches = [rows(1, 300, 120), rows(2, 200, 160), rows(3, 60, 160, date(2024, 2, 10), 5)]  # ids come back, move dates, arrive late
    state = LedgerState(spark, f"{tmp_dir}/state")
    seen = []
    for k, b in enumerate(batches):
        df = frame(spark, b)
        state.apply(df, f"run {k}")
        assert state.apply(df, f"run {k}")["replayed"]
        seen += b
        want, done = ltv(frame(spark, seen))
        got = state.customer_ltv().select("customer_id", "total_spent", "total_txns", "avg_txn_value", "first_txn_date", "last_txn_date", "preferred_payment_method")
        assert sorted(map(tuple, got.collect()), key=str) == want
        days = done.groupBy("merchant_id", F.col("transaction_date").alias("report_date")).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "COMPLETED").alias("c"))
        assert {(r.merchant_id, r.report_date, r.txn_count) for r in state.merchant_days().collect()} == {(r.merchant_id, r.report_date, r.n) for r in days.collect()}


def test_only_touched_files_are_read(spark, tmp_dir):
    state = LedgerState(spark, f"{tmp_dir}/state")
    state.apply(frame(spark, [(f"A{k}", 5, "COMPLETED", 1, k % 3, date(2024, 1 + k % 12, 1), "UPI", k) for k in range(600)]), "a")
    state.apply(frame(spark, [(f"B{k}", 5, "COMPLETED", 1, k % 3, date(2024, 1 + k % 12, 1), "UPI", k) for k in range(600)]), "b")
    moved = frame(spark, [("B5", 9, "COMPLETED", 1, 1, date(2024, 7, 2), "UPI", 9999)])
    won, parts = state.winners(moved)
    assert parts == ["batch=b"] and all("/data/batch=b/" in f or "rdd-" in f for f in won.inputFiles())
    record = state.apply(moved, "c")
    assert record["spans"]["customer_days"] == ["2024-06", "2024-07"]  # the date it left and the one it came to
    files = state.partial(PARTIALS[0], ["2024-06"]).inputFiles()
    assert files and all("/batch=c/span=2024-06/" in f for f in files)
    assert state.customer_ltv().agg(F.sum("total_spent")).first()[0] == 1200 * 5 + 4
    assert state.apply(frame(spark, [("B5", 9, "FAILED", 1, 1, date(2024, 1, 2), "UPI", 1)]), "late")["spans"]["customer_days"] == []  # an older version


def test_indexed_merge(spark, tmp_dir, monkeypatch):
    schema = "id string, v long"
    make = lambda a, z, v=0: spark.createDataFrame([(f"k{k:07d}", v) for k in range(a, z)], schema)
    root = f"{tmp_dir}/t"
    for k in range(4):
        merge_indexed(spark, root, make(1000 * k, 1000 * k + 1000), "id", f"q/{k}")
    out = merge_indexed(spark, root, make(1500, 1700, 1).unionByName(spark.createDataFrame([(None, 1), ("zz", 7), ("zz", 5)], schema)), "id", "q/9")
    assert out["opened"] == ["batch=q_1"]  # the others can't hold these keys
    assert (out["attempted"], out["loaded"], out["skipped"], out["null_keys"]) == (202, 1, 201, 1)
    t = IndexedTable(spark, root, "id")
    assert {p.rsplit("/", 2)[-2] for p in t.read(out["opened"]).inputFiles()} == {"batch=q_1"}
    assert t.read().count() == 4001 and t.read().where("id = 'zz'").first().v == 5
    assert merge_indexed(spark, root, make(0, 50000), "id", "q/9")["replayed"] and t.read().count() == 4001

    real = indexed.write_text  # a crash after the rows and before the marker
    monkeypatch.setattr(indexed, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merge_indexed(spark, root, make(3900, 4100), "id", "q/10")
    assert t.read().count() == 4001
    monkeypatch.setattr(indexed, "write_text", real)
    assert merge_indexed(spark, root, make(3900, 4100), "id", "q/10")["loaded"] == 100
    assert t.read().count() == 4101 == t.read().select("id").distinct().count()


def test_index_never_loses_a_part(spark, tmp_dir):
    t = IndexedTable(spark, f"{tmp_dir}/t", "id", pieces=4)
    r = random.Random(5)
    held = [sorted(r.sample(range(10**9), 500)) for _ in range(5)]
    for k, ids in enumerate(held):
        t.append(spark.createDataFrame([(i,) for i in ids], "id long"), f"b{k}")
    for k, ids in enumerate(held):
        found = t.may_hold(spark.createDataFrame([(ids[0],), (ids[-1],)], "id long"))
        assert f"batch=b{k}" in found and len(found) < 5
    assert t.may_hold(spark.createDataFrame([], "id long")) == []
