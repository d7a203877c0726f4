"""PII scan / masking / guard (F6, F11) and schema drift / migrations."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import governance as G
from ledgerflow.operators import schema as S


def customers_pii(spark):
    rows = [(f"CUST{i:03d}", name, f"{name.split()[0].lower()}{i}@mail.example.com", f"+9198765{i:05d}",
             f"ABCDE{i:04d}F", f"{123456789000 + i}", "Pune")
            for i, name in enumerate(["Asha Rao", "Vikram Shah", "Neha Iyer", "Ravi Kumar"])]
    return spark.createDataFrame(rows, "customer_id string, full_name string, email_address string, "
                                       "phone_number string, pan_number string, account_number string, city string")


def test_pii_scan_all_columns(spark):
    res = {r.column_name: r for r in G.pii_scan(customers_pii(spark)).collect()}
    assert res["full_name"].pii_type == "full_name" and res["full_name"].match_rate == 1.0
    assert res["email_address"].pii_type == "email_address"
    assert res["phone_number"].pii_type == "phone_number"
    assert res["pan_number"].pii_type == "pan_number"
    # 12 digits match the national-id and the account pattern at 1.0: priority decides
    assert res["account_number"].pii_type == "aadhaar_number"
    assert "city" not in res and "customer_id" not in res
    tier = G.dataset_tier(G.pii_scan(customers_pii(spark))).first()
    assert tier.dataset_classification == "Restricted"


def test_masks_never_leak(spark):
    df = customers_pii(spark)
    plan = {"full_name": "full_name", "email_address": "email_address", "phone_number": "phone_number",
            "pan_number": "pan_number", "account_number": "account_number"}
    raw = {r.customer_id: r for r in df.collect()}
    masked = {r.customer_id: r for r in G.mask(df, plan, "salt").collect()}
    for k, r in masked.items():
        for c in plan:
            assert getattr(r, c) != getattr(raw[k], c)
        assert r.email_address.endswith("@mail.example.com")
        assert r.phone_number.endswith(raw[k].phone_number[-4:])
        assert len(r.pan_number) == 10 and r.pan_number[:5].isalpha() and r.pan_number[5:9].isdigit()


def test_redaction(spark):
    df = spark.createDataFrame([("mail a.b@x.example.com card 4111 1111 1111 1111 ip 10.0.0.1",)], "text string")
    r = df.select(G.redact_text("text").alias("t"), *G.pii_hits("text")).first()
    assert "a.b@" not in r.t and "4111" not in r.t and "10.0.0.1" not in r.t
    assert r.n_email_address == 1 and r.n_credit_card == 1 and r.n_ip_address == 1


def test_statement_guard(spark):
    log = spark.createDataFrame([("DROP TABLE silver_transactions",), ("DELETE FROM silver_transactions",),
                                 (None,), ("SELECT * FROM unknown_tbl WHERE x = 1",),
                                 ("SELECT status, COUNT(*) FROM silver_transactions GROUP BY status",)], "sql string")
    got = [r.allowed for r in G.statement_guard(log, "sql", ["silver_transactions"]).collect()]
    assert got == [False, False, False, False, True]


def test_name_hints():
    hits = dict(G.name_hints(["cust_nm", "mob_no", "acct_no", "emp_id", "loc_cd", "dob_dt", "pncd"]))
    assert hits["mob_no"] == "phone_number" and hits["acct_no"] == "account_number"
    assert hits["dob_dt"] == "date_of_birth" and "emp_id" not in hits


def test_drift_three_new_columns():
    base = T.StructType([T.StructField(c, T.StringType()) for c in
                         ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date",
                          "payment_method", "ingestion_timestamp", "source_file", "pipeline_run_id"]])
    actual = T.StructType(base.fields + [T.StructField("payment_gateway", T.StringType()),
                                         T.StructField("discount_amount", T.FloatType()),
                                         T.StructField("refund_flag", T.BooleanType())])
    d = S.detect_drift(base, actual)
    assert len(d.new) == 3 and not d.removed and not d.changed
    assert S.classify_drift(d) == ("LOW", "ADD")
    d2 = S.detect_drift(actual, base)
    assert S.classify_drift(d2) == ("BREAKING", "HALT")
    d3 = S.detect_drift(T.StructType([T.StructField("a", T.IntegerType())]), T.StructType([T.StructField("a", T.LongType())]))
    assert S.classify_drift(d3) == ("HIGH", "FLAG")
    d4 = S.detect_drift(base, T.StructType(base.fields + [T.StructField("fee", T.DoubleType(), False)]))
    assert S.classify_drift(d4) == ("HIGH", "FLAG")


def test_drift_decision_per_column(spark):
    old = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("gone", T.StringType())])
    new = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType()), T.StructField("note", T.StringType()),
                        T.StructField("fee", T.DecimalType(10, 2)), T.StructField("key", T.StringType(), False)])
    got = {c: action for c, (action, _) in S.decide_columns(S.detect_drift(old, new)).items()}
    assert got == {"a": "ADD_TO_SCHEMA", "b": "FLAG_ANOMALY", "note": "ADD_TO_SCHEMA", "fee": "FLAG_ANOMALY", "key": "FLAG_ANOMALY", "gone": "HALT"}
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id int, fee double")
    rows = S.apply_decisions(df, {"fee": ("FLAG_ANOMALY", "new and numeric"), "id": ("DROP_SILENTLY", "unused")})
    assert sorted(map(tuple, rows.collect()), key=str) == [(2.0, True), (None, False)]
    with pytest.raises(ValueError, match="gone"):
        S.apply_decisions(df, {"gone": ("HALT", "removed")})


def test_migrations_and_silent_break(spark):
    v1 = spark.createDataFrame([("T1", 1.0, "COMPLETED", "M1", "2024-01-01")],
                               "transaction_id string, amount double, status string, merchant_id string, transaction_date string")
    v2 = S.migrate(v1, [("add", "customer_id", "string"), ("add", "payment_method", "string")])
    v3 = S.migrate(v2, [("rename", "customer_id", "user_id"), ("drop", "payment_method")])
    assert "user_id" in v3.columns and "payment_method" not in v3.columns
    broken = S.broken_consumers({"upi_share": {"payment_method", "amount"}, "daily": {"amount"}}, v3.schema)
    assert broken == {"upi_share": {"payment_method"}}


def test_repair_record(spark):
    df = spark.createDataFrame([("T1", "CornerShop", "15-01-2024"), ("T2", None, "2024-01-16")],
                               "transaction_id string, merchant_nm string, transaction_date string")
    out = {r.transaction_id: r for r in S.repair_record(df).collect()}
    assert out["T1"].merchant_name == "CornerShop" and out["T1"].transaction_date == "2024-01-15"
    assert out["T1"]._fixed_date and not out["T2"]._fixed_date


def test_conform_and_cast_repair(spark):
    df = spark.createDataFrame([("1", "x", "9")], "a string, extra string, b string")
    target = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()),
                           T.StructField("c", T.StringType())])
    out = S.conform(df, target)
    assert out.columns == ["a", "b", "c"] and out.first().c is None
    rep = S.cast_repair(spark.createDataFrame([("1.5",), ("bad",)], "v string"), "v")
    assert [r.v for r in rep.collect()] == [1.5, 0.0]


@pytest.mark.parametrize("text,expected", [
    ("pay 123456789012345678 now", "pay [ACCOUNT_NUMBER] now"), ("acc 00112233445.", "acc [ACCOUNT_NUMBER]."), ("123456789", "[ACCOUNT_NUMBER]"),
    ("1234567890", "[ACCOUNT_NUMBER]"), ("9876543210", "[PHONE_NUMBER]"), ("4111 1111 1111 1111", "[CREDIT_CARD]"),
    ("4111111111111111", "[CREDIT_CARD]"), ("123412341234", "[AADHAAR_NUMBER]"), ("nr 12345678", "nr 12345678"), ("", ""), (None, None)])
def test_redaction_of_digit_runs(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    got = df.select(G.redact_text("text").alias("t"), *G.pii_hits("text")).first()
    assert got.t == expected
    if text is not None:
        assert got.n_account_number == ("[ACCOUNT_NUMBER]" in expected)
