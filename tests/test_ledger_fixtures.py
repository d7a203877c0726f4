"""Hand-typed ledger fixtures (F1 shape): silver rules, enrichment, gold marts, invariants."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.operators import gold, marts, silver

D = dt.date
TXN_SCHEMA = ("transaction_id string, amount decimal(18,2), status string, merchant_id string, "
              "customer_id string, transaction_date date, payment_method string, src_seq long")


def txn_rows():
    rows = [
        ("P-10", "19.99", "COMPLETED", "S-1", "K-7", D(2023, 3, 2), "UPI", 1),
        ("P-11", "640.00", "COMPLETED", "S-1", "K-7", D(2023, 3, 2), "CREDIT_CARD", 2),
        ("P-12", "5.25", "FAILED", "S-2", "K-8", D(2023, 3, 2), "UPI", 3),
        ("P-13", "5.25", "COMPLETED", "S-2", "K-8", D(2023, 3, 3), "UPI", 4),
        ("P-13", "5.25", "COMPLETED", "S-2", "K-8", D(2023, 3, 1), "UPI", 5),           # older duplicate
        ("P-14", "77.40", "PENDING", "S-2", "K-9", D(2023, 3, 3), "UPI", 6),
        ("P-18", "10.01", "COMPLETED", "S-1", "K-7", D(2023, 3, 3), "CREDIT_CARD", 7),
        ("P-15", "-3.00", "COMPLETED", "S-3", "K-8", D(2023, 3, 4), "UPI", 8),          # negative
        (None, "8.00", "COMPLETED", "S-3", "K-9", D(2023, 3, 4), "UPI", 9),             # null id
        ("P-16", "0.00", "COMPLETED", "S-3", "K-9", D(2023, 3, 4), "UPI", 10),          # zero completed
        ("P-17", "31.00", "COMPLETED", "S-9", "K-8", D(2023, 3, 5), "UPI", 11),         # unmatched merchant
    ]
    return [(a, Decimal(b), *rest) for a, b, *rest in rows]


def merchants(spark):
    return spark.createDataFrame(
        [("S-1", "Lamp Works", "Home", "Lyon"), ("S-2", "Blue Kiosk", "Press", "Porto"), ("S-3", "North Tackle", "Sport", "Oslo")],
        "merchant_id string, merchant_name string, category string, city string")


def test_silver_rules(spark):
    t = spark.createDataFrame(txn_rows(), TXN_SCHEMA)
    s = silver.build_silver(t, merchants(spark))
    rows = {r.transaction_id: r for r in s.collect()}
    assert len(rows) == 8                                   # null id, negative, duplicate removed
    assert None not in rows and "P-15" not in rows
    assert rows["P-13"].transaction_date == D(2023, 3, 3)  # latest kept
    assert rows["P-17"].quality_flag == "UNMATCHED" and rows["P-17"].merchant_name is None
    assert rows["P-10"].merchant_name == "Lamp Works" and rows["P-10"].quality_flag == "CLEAN"


def test_keep_latest_is_partition_independent(spark):
    t = spark.createDataFrame(txn_rows(), TXN_SCHEMA)
    a = silver.keep_latest(t.where("transaction_id is not null"), "transaction_id", list(silver.LEDGER_DEDUP_ORDER))
    b = silver.keep_latest(t.where("transaction_id is not null").repartition(5, "src_seq"), "transaction_id",
                           list(silver.LEDGER_DEDUP_ORDER))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_gold_rules(spark):
    t = spark.createDataFrame(txn_rows(), TXN_SCHEMA)
    s = silver.build_silver(t, merchants(spark))
    perf = {r.merchant_id: r for r in gold.merchant_performance(s, by_date=False).collect()}
    assert abs(perf["S-2"].failure_rate_pct - 100 / 3) < 0.01 and perf["S-2"].total_revenue == 5.25
    assert perf["S-1"].total_revenue == 670.0 and perf["S-1"].txn_count == 3 and perf["S-3"].total_revenue == 0.0
    daily = {r.report_date: r for r in gold.daily_summary(s).collect()}
    assert daily[D(2023, 3, 2)].unique_customers == 2
    ltv = {r.customer_id: r for r in gold.customer_ltv(s).collect()}
    assert ltv["K-7"].total_spent == 670.0 and ltv["K-7"].preferred_payment_method == "CREDIT_CARD"
    # invariant: sum of merchant revenue == sum of daily revenue
    a = gold.merchant_performance(s, by_date=True).agg(F.sum("total_revenue")).first()[0]
    b = gold.daily_summary(s).agg(F.sum("total_revenue")).first()[0]
    assert abs(a - b) < 1e-9


def test_risk_score_rules(spark):
    rows = [("T1", Decimal("50.00"), "M9"), ("T2", Decimal("30.00"), "M9"), ("T3", Decimal("48.00"), "M9"),
            ("T4", Decimal("1748.00"), "M4")]
    df = spark.createDataFrame(rows, "transaction_id string, amount decimal(18,2), merchant_id string")
    out = {r.merchant_id: r for r in marts.merchant_risk_score(df, df.limit(0)).collect()}
    assert out["M9"].risk_score == 60 and out["M9"].decision == "INVESTIGATE"   # 3 txns -> 20, avg < 200 -> 40
    assert out["M4"].risk_score == 0 and out["M4"].decision == "CLEAR"


def test_customer_spend_keeps_zero_order_customers(spark):
    cust = spark.createDataFrame([(1, "A", "T1"), (2, "B", "T2")], "customer_id long, customer_name string, customer_tier string")
    s = spark.createDataFrame([(1, Decimal("10.00"), "COMPLETED"), (1, Decimal("5.00"), "FAILED")],
                              "customer_id long, amount decimal(18,2), status string")
    out = {r.customer_id: r for r in marts.customer_spend(cust, s, None).collect()}
    assert out[2].lifetime_value == 0.0 and out[2].total_orders == 0
    assert out[1].lifetime_value == 10.0 and out[1].total_orders == 1


def test_test_merchant_filter_like_and_literal(spark):
    df = spark.createDataFrame([("T1", "TEST_1"), ("T2", "TESTX1"), ("T3", "TEST"), ("T4", "M001")],
                               "transaction_id string, merchant_id string").withColumn("status", F.lit("A")) \
              .withColumn("payment_method", F.lit("UPI"))
    like = {r.transaction_id for r in marts.stage_transactions(df).collect()}
    lit = {r.transaction_id for r in marts.stage_transactions(df, literal=True).collect()}
    assert like == {"T3", "T4"}            # LIKE: '_' matches any char, so TESTX1 is dropped too
    assert lit == {"T2", "T3", "T4"}       # literal prefix 'TEST_'
