"""More fixture tests: schema guard, claims, contract compile, change correlation,
fingerprints, file streams, stream-vs-sink divergence, partner feeds."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import quality as Q
from ledgerflow.operators import recovery as R
from ledgerflow.operators import schema as S
from ledgerflow.sources import files
from ledgerflow.streaming import ops, runner


def test_require_columns(spark):
    df = spark.createDataFrame([("T1",)], "transaction_id string")
    with pytest.raises(ValueError, match="amount"):
        Q.require_columns(df, ["transaction_id", "amount"])


def test_claim_check(spark):
    claims = spark.createDataFrame([("revenue", 100.0), ("failure_rate", 10.0), ("growth", 50.0)],
                                   "metric string, claimed_value double")
    actual = spark.createDataFrame([("revenue", 100.5, 1000), ("failure_rate", 12.0, 1000), ("growth", 50.0, 4)],
                                   "metric string, actual_value double, n long")
    got = {r.metric: r.verdict for r in Q.claim_check(claims, actual).collect()}
    assert got == {"revenue": "VERIFIED", "failure_rate": "WRONG", "growth": "MISLEADING"}


def test_contract_compiles_to_checks(spark):
    contract = {"transaction_id": {"required": True}, "status": {"required": True, "values": ["completed", "failed"]},
                "transaction_date": {"regex": r"\d{4}-\d{2}-\d{2}$"}, "amount": {"type": "double", "min": 0}}
    checks = S.contract_checks(contract)
    df = spark.createDataFrame([("T1", "completed", "2024-01-01", "5"), ("T2", "done", "01-01-2024", "-1")],
                               "transaction_id string, status string, transaction_date string, amount string")
    res = {(r.check_name, r.column_name): r.failed_row_count for r in Q.run_suite(df, checks).collect()}
    assert res[("expect_column_values_to_be_in_set", "status")] == 1
    assert res[("expect_column_values_to_match_regex", "transaction_date")] == 1
    assert res[("expect_column_values_to_be_between", "amount")] == 1


def test_change_correlation_and_fingerprints(spark):
    t = dt.datetime
    alarms = spark.createDataFrame([(t(2024, 1, 1, 10, 0), False), (t(2024, 1, 1, 10, 5), True), (t(2024, 1, 1, 10, 10), True)],
                                   "bucket timestamp, alarm boolean")
    changes = spark.createDataFrame([("v2", t(2024, 1, 1, 10, 2))], "version string, changed_at timestamp")
    r = R.change_correlation(alarms, changes).first()
    assert r.anomaly_start == t(2024, 1, 1, 10, 5)
    log = spark.createDataFrame([
        ("KeyError: 'amount' at /home/a/x.py:12", "df['amount']", "fill 0", t(2024, 1, 1)),
        ("KeyError: 'amount' at /home/b/y.py:99", "df['amount']", "rename col", t(2024, 1, 2)),
        ("ValueError: bad date", "to_date(x)", "coerce", t(2024, 1, 3))],
        "exception string, code string, fix string, ts timestamp")
    fp = R.error_fingerprints(log, "exception", "code", "fix", "ts").collect()
    counts = sorted(r.occurrences for r in fp)
    assert counts == [1, 2] and all(len(r.fingerprint) == 12 for r in fp)
    assert {r.last_fix for r in fp if r.occurrences == 2} == {"rename col"}
    keys = spark.createDataFrame([(f"KeyError: {k} at line {n}", "d[k]", "f", t(2024, 1, n)) for k, n in ((12, 1), (12, 2), (13, 3))],
                                 "exception string, code string, fix string, ts timestamp")
    fp = R.error_fingerprints(keys, "exception", "code", "fix", "ts").collect()
    assert sorted(r.occurrences for r in fp) == [1, 2]       # the key tells errors apart, the line doesn't


def test_file_stream_and_sink_divergence(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    base = dt.datetime(2024, 1, 1, 10, 0)
    rows = [{"transaction_id": f"T{i}", "ts": (base + dt.timedelta(minutes=i)).isoformat(), "value": 1.0}
            for i in range(30)]
    with open(f"{tmp_dir}/in/a.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n{broken\n")
    schema = T.StructType([T.StructField("transaction_id", T.StringType()), T.StructField("ts", T.TimestampType()),
                           T.StructField("value", T.DoubleType())])
    s = runner.file_stream(spark, f"{tmp_dir}/in", schema)
    out = runner.run_available_now(s.where(F.col("transaction_id").isNotNull()).drop("_corrupt_record"),
                                   f"{tmp_dir}/raw", "x1-test")
    assert spark.read.parquet(f"{tmp_dir}/raw").count() == 30
    src = ops.tumbling(spark.read.parquet(f"{tmp_dir}/raw"), "ts", "10 minutes")
    spark.read.parquet(f"{tmp_dir}/raw").where("ts < '2024-01-01 10:10:00'").write.parquet(f"{tmp_dir}/sink")
    d = {r.window_start: r.alarm for r in runner.divergence_sink_check(src, f"{tmp_dir}/sink", "ts").collect()}
    assert d[base] is False and d[base + dt.timedelta(minutes=10)] is True


def test_partner_feed_folders(spark, tmp_dir):
    df = spark.createDataFrame([("T1", "M1"), ("T2", "M2")], "transaction_id string, merchant_id string")
    partners = spark.createDataFrame([("M1", "P-A"), ("M2", "P-B")], "merchant_id string, partner_id string")
    files.write_partner_feed(df, partners, f"{tmp_dir}/feed")
    assert sorted(os.listdir(f"{tmp_dir}/feed"))[:2] == ["partner_id=P-A", "partner_id=P-B"]


def test_table_format_reader_falls_back(spark, tmp_dir):
    spark.createDataFrame([("T1", 1.0)], "id string, amount double").write.parquet(f"{tmp_dir}/silver")
    df, used = files.read_table_format(spark, f"{tmp_dir}/silver", "delta")
    assert df.count() == 1 and used in ("delta", "parquet")


def test_quarantine_runs_accumulate_and_replays_replace(spark, tmp_dir):
    bad = spark.createDataFrame([("T1", "neg")], "id string, _quarantine_reason string")
    assert files.write_quarantine(bad, f"{tmp_dir}/q", "x", "src", "2024-01-15 10:00:00") == "WRITTEN"
    assert files.write_quarantine(bad, f"{tmp_dir}/q", "x", "src", "2024-01-15 10:00:00") == "WRITTEN"  # replay
    assert files.write_quarantine(bad, f"{tmp_dir}/q", "x", "src", "2024-01-15 11:00:00") == "WRITTEN"  # next run
    assert files.write_quarantine(bad.limit(0), f"{tmp_dir}/q", "x", "src", "2024-01-15 12:00:00") == "SKIPPED"
    assert spark.read.option("header", True).csv(f"{tmp_dir}/q").count() == 2
