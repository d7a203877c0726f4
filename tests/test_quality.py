"""Quality operators on hand-typed fixtures (F3 contract, F4/F7/F10 rules) + median."""

import random

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.operators import quality as Q


def test_contract_day2_orders(spark):
    rows = [("O1", "C1", 100.0, "COMPLETED"), ("O2", "C2", 250.0, "PENDING"), ("O2", "C3", 80.0, "FAILED"),
            ("O4", None, -50.0, "COMPLETED"), ("O5", "C5", 40.0, "UNKNOWN")]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, amount double, status string")
    checks = [Q.Check("row_count_between", None, {"lo": 1}),
              Q.Check("missing_count_max", "order_id", {"max": 0}),
              Q.Check("duplicate_values_max", "order_id", {"max": 0}),
              Q.Check("missing_count_max", "customer_id", {"max": 0}),
              Q.Check("min_at_least", "amount", {"lo": 0}),
              Q.Check("invalid_count_max", "status", {"values": ("COMPLETED", "PENDING", "FAILED"), "max": 0})]
    res = [(r.check_name, r.column_name, r.observed_value, r.passed) for r in Q.run_suite(df, checks).collect()]
    got = {(a, b): (c, d) for a, b, c, d in res}
    assert got[("row_count_between", None)] == (5.0, True)
    assert got[("missing_count_max", "order_id")] == (0.0, True)
    assert got[("duplicate_values_max", "order_id")] == (1.0, False)
    assert got[("missing_count_max", "customer_id")] == (1.0, False)
    assert got[("min_at_least", "amount")] == (-50.0, False)
    assert got[("invalid_count_max", "status")] == (1.0, False)
    assert sum(1 for *_, p in res if p) == 2


def test_row_checks_and_quarantine(spark):
    rows = [("T1", "100", "INR"), ("", "50", "INR"), ("T3", "abc", "USD"), ("T3", "20", "EUR"),
            (None, "10", "INR"), (None, "5", None)]
    df = spark.createDataFrame(rows, "id string, amount string, currency string")
    checks = [Q.not_null("id"), Q.unique("id"), Q.between("amount", 0, 60, severity="warning"),
              Q.in_set("currency", ("INR", "USD")), Q.not_null("missing_col")]
    res = {(r.check_name, r.column_name): r for r in Q.run_suite(df, checks).collect()}
    assert res[("expect_column_values_to_not_be_null", "id")].failed_row_count == 3      # blank counts as null
    assert res[("expect_column_values_to_be_unique", "id")].failed_row_count == 4        # T3 x2 + two NULLs
    assert res[("expect_column_values_to_be_between", "amount")].failed_row_count == 2   # 100 and 'abc'
    assert res[("expect_column_values_to_be_in_set", "currency")].failed_row_count == 2  # EUR and NULL
    assert res[("expect_column_values_to_not_be_null", "missing_col")].error is not None
    clean, bad = Q.quarantine_split(df, checks, "2024-01-01 00:00:00")
    assert clean.count() + bad.count() == df.count()
    reasons = {r.id: r._quarantine_reason for r in bad.where("id = 'T3'").collect()}
    assert "expect_column_values_to_be_unique:id" in reasons["T3"]


def test_exact_median_matches_numpy(spark):
    rnd = random.Random(7)
    for n in (1, 2, 7, 1000, 25001):
        vals = [round(rnd.uniform(-1000, 1000), 2) for _ in range(n)] + [5.0] * (n // 3)
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        med, cnt = Q.exact_median(df, "x", buckets=16, direct_max=50)
        assert cnt == len(vals)
        assert abs(med - float(np.median(vals))) < 1e-9


def test_impossible_rows_verdict(spark):
    import datetime as dt
    from decimal import Decimal as Dc
    day = dt.date(2023, 3, 2)
    rows = [("far-off", Dc("61.10"), "PENDING", "S-1", dt.date(2090, 1, 1), "UPI"),
            ("nobody", Dc("7.77"), "COMPLETED", "S-9", day, "UPI"),
            ("huge", Dc("990000.00"), "COMPLETED", "S-1", day, "UPI"),
            ("fine", Dc("880000.00"), "COMPLETED", "S-1", day, "CREDIT_CARD"),
            ("empty", Dc("0.00"), "COMPLETED", "S-1", day, "UPI"),
            ("odd-state", Dc("3.50"), "LIMBO", "S-1", day, "UPI")]
    t = spark.createDataFrame(rows, "transaction_id string, amount decimal(18,2), status string, merchant_id string, "
                                    "transaction_date date, payment_method string")
    m = spark.createDataFrame([("S-1",)], "merchant_id string")
    f = Q.impossible_rows(t, m, "2024-06-01")
    v = Q.verdict(f).first()
    assert (v.issues, v.critical, v.verdict) == (5, 4, "NOT SAFE")


def test_classify_issue_labelled_rows(spark):
    rows = [("TXN1", "CornerShop", "1,234.56", "INR", "2024-01-02", "COMPLETED"),
            ("", "CornerShop", "10", "INR", "2024-01-02", "COMPLETED"),
            ("TXN3", "CornerShop", "-5", "INR", "2024-01-02", "COMPLETED"),
            ("TXN4", "CornerShop", "10", "IND", "2024-01-02", "COMPLETED"),
            ("TXN5", "CornerShop", "10", "INR", "99-99-9999", "COMPLETED"),
            ("TXN6", "CornerShop", "10", "INR", "2024/06/02", "COMPLETED"),
            ("TXN7", "CornerShop", "10", "INR", "2024-01-02", "Completed"),
            ("TXN8", "", "10", "INR", "2024-01-02", "COMPLETED"),
            ("TXN9", "CornerShop", "0", "INR", "2024-01-02", "COMPLETED")]
    df = spark.createDataFrame(rows, "transaction_id string, merchant_name string, amount string, currency string, "
                                     "transaction_date string, status string")
    got = {r.transaction_id: (r.issue_found, r.severity, r.auto_fixable) for r in Q.classify_issue(df).collect()}
    assert got["TXN1"] == ("comma in amount", "M", True)
    assert got[""] == ("blank transaction_id", "H", False)
    assert got["TXN3"] == ("negative amount", "H", False)
    assert got["TXN4"] == ("currency alias", "M", True)
    assert got["TXN5"] == ("invalid date", "H", True)
    assert got["TXN6"] == ("non-standard date format", "M", True)
    assert got["TXN7"] == ("status casing", "L", True)
    assert got["TXN8"] == ("blank merchant_name", "M", False)
    assert got["TXN9"] == ("zero amount", "M", False)


def test_row_decisions(spark):
    rows = [("1", 100.0, "INR", "2024-01-02", None), ("2", -5.0, "INR", "2024-01-02", None),
            ("3", 900000.0, "INR", "2024-01-02", "annual contract"), ("4", 10.0, "XYZ", "2024-01-02", None),
            ("5", 10.0, "INR", "2026-07-01", None), ("6", 900000.0, "INR", "2024-01-02", None)]
    df = spark.createDataFrame(rows, "id string, amount double, currency string, transaction_date string, note string")
    got = {r.id: r.decision for r in Q.row_decision(df, "2026-06-01").collect()}
    assert got == {"1": "PASS", "2": "QUARANTINE", "3": "PASS", "4": "QUARANTINE", "5": "QUARANTINE", "6": "FLAG"}


def test_scorecard_and_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 3.0)], "transaction_id string, amount double")
    sc = Q.scorecard(df, "2024-01-01", ["transaction_id", "amount"], "transaction_id", ["transaction_id", "amount"]).first()
    assert abs(sc.null_rate - 1 / 3) < 1e-6 and abs(sc.duplicate_rate - 1 / 3) < 1e-6
    assert sc.pipeline_status == "SUCCESS" and sc.schema_alert is False
    prof = {r.column_name: r for r in Q.profile(df).collect()}
    assert prof["amount"].inferred_type == "numeric" and prof["amount"].null_count == 1
    assert prof["transaction_id"].unique_count == 2 and prof["transaction_id"].uniqueness_pct == 66.7


def test_auto_fix_fills_median(spark):
    df = spark.createDataFrame([("1", "10", "2024-01-01"), ("2", "", "2024-13-01"), ("3", "30", " 2024-01-03")],
                               "id string, amount string, transaction_date string")
    out = {r.id: r for r in Q.auto_fix(df).collect()}
    assert float(out["2"].amount) == 20.0 and "null_amount_filled_with_median" in out["2"]._fixes
    assert out["2"].transaction_date == "INVALID_DATE"
