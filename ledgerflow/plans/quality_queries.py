"""Registered data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import count_when, pct_or_zero
from ..operators import quality as Q
from ..operators.layers import layer_diff
from ..sources import derived, ledger
from .ledger_queries import silver_df
from .oracle import with_ctes
from .registry import register

AS_OF = ledger.LEDGER_AS_OF
RUN_TS = AS_OF + " 02:00:00"

STATUSES = ("COMPLETED", "FAILED", "PENDING")
# The ledger suite (fixed check list for the registered query).
LEDGER_SUITE = [
    Q.not_null("transaction_id"),
    Q.unique("transaction_id"),
    Q.between("amount", 1000, 100000, severity="warning"),
    Q.in_set("status", STATUSES),
    Q.matches("transaction_date", r"\d{4}-\d{2}-\d{2}", severity="warning"),
    Q.in_set("payment_method", ("UPI", "CREDIT_CARD"), severity="warning"),
    Q.not_null("merchant_name", severity="warning"),
    Q.Check("row_count_between", None, {"lo": 1, "hi": 1e9}),
    Q.Check("mean_between", "amount", {"lo": 100, "hi": 5000}, "warning"),
    Q.Check("min_at_least", "amount", {"lo": 0}),
    Q.Check("duplicate_count_max", "transaction_id", {"max": 0}),
    Q.Check("missing_count_max", "customer_id", {"max": 0}),
    Q.Check("invalid_count_max", "status", {"values": STATUSES, "max": 0}),
    Q.not_null("currency"),
]

_NN = "expect_column_values_to_not_be_null"
_UQ = "expect_column_values_to_be_unique"
_BT = "expect_column_values_to_be_between"
_IS = "expect_column_values_to_be_in_set"
_RX = "expect_column_values_to_match_regex"

_FLAGS = f"""
, d AS (SELECT transaction_id FROM bronze WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1),
f AS (SELECT b.*,
        (b.transaction_id IS NULL OR trim(b.transaction_id) = '') AS f_nn_id,
        (d.transaction_id IS NOT NULL) AS f_uq_id,
        (TRY_CAST(b.amount AS DOUBLE) IS NULL OR TRY_CAST(b.amount AS DOUBLE) < 1000
           OR TRY_CAST(b.amount AS DOUBLE) > 100000) AS f_bt_amount,
        NOT COALESCE(b.status IN ('COMPLETED', 'FAILED', 'PENDING'), FALSE) AS f_is_status,
        NOT COALESCE(regexp_matches(b.transaction_date, '^(?:\\d{{4}}-\\d{{2}}-\\d{{2}})'), FALSE) AS f_rx_date,
        NOT COALESCE(b.payment_method IN ('UPI', 'CREDIT_CARD'), FALSE) AS f_is_method,
        (b.merchant_name IS NULL OR trim(b.merchant_name) = '') AS f_nn_name
      FROM bronze b LEFT JOIN d ON b.transaction_id = d.transaction_id)"""


@register("q13_suite_transactions", ids=("Q13", "Q2", "Q3", "Q4", "Q5", "Q6", "Q7", "Q8", "Q9", "Q10"),
          sql=with_ctes("bronze", _FLAGS + f"""
, c AS (SELECT COUNT(*) FILTER (WHERE f_nn_id) AS a1, COUNT(*) FILTER (WHERE f_uq_id) AS a2,
               COUNT(*) FILTER (WHERE f_bt_amount) AS a3, COUNT(*) FILTER (WHERE f_is_status) AS a4,
               COUNT(*) FILTER (WHERE f_rx_date) AS a5, COUNT(*) FILTER (WHERE f_is_method) AS a6,
               COUNT(*) FILTER (WHERE f_nn_name) AS a7 FROM f),
s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS rc, ROUND(AVG(TRY_CAST(amount AS DOUBLE)), 4) AS mean_amt,
             ROUND(MIN(TRY_CAST(amount AS DOUBLE)), 4) AS min_amt,
             CAST(COUNT(transaction_id) - COUNT(DISTINCT transaction_id) AS DOUBLE) AS dup,
             CAST(COUNT(*) FILTER (WHERE customer_id IS NULL OR trim(customer_id) = '') AS DOUBLE) AS miss,
             CAST(COUNT(*) FILTER (WHERE status IS NOT NULL AND status NOT IN ('COMPLETED', 'FAILED', 'PENDING')) AS DOUBLE) AS inval
      FROM bronze)
SELECT '{_NN}' AS check_name, 'transaction_id' AS column_name, 'critical' AS severity, a1 AS failed_row_count,
       CAST(NULL AS DOUBLE) AS observed_value, a1 = 0 AS passed, CAST(NULL AS VARCHAR) AS error FROM c
UNION ALL SELECT '{_UQ}', 'transaction_id', 'critical', a2, NULL, a2 = 0, NULL FROM c
UNION ALL SELECT '{_BT}', 'amount', 'warning', a3, NULL, a3 = 0, NULL FROM c
UNION ALL SELECT '{_IS}', 'status', 'critical', a4, NULL, a4 = 0, NULL FROM c
UNION ALL SELECT '{_RX}', 'transaction_date', 'warning', a5, NULL, a5 = 0, NULL FROM c
UNION ALL SELECT '{_IS}', 'payment_method', 'warning', a6, NULL, a6 = 0, NULL FROM c
UNION ALL SELECT '{_NN}', 'merchant_name', 'warning', a7, NULL, a7 = 0, NULL FROM c
UNION ALL SELECT 'row_count_between', NULL, 'critical', NULL, rc, rc >= 1 AND rc <= 1e9, NULL FROM s
UNION ALL SELECT 'mean_between', 'amount', 'warning', NULL, mean_amt, COALESCE(mean_amt >= 100 AND mean_amt <= 5000, FALSE), NULL FROM s
UNION ALL SELECT 'min_at_least', 'amount', 'critical', NULL, min_amt, COALESCE(min_amt >= 0, TRUE), NULL FROM s
UNION ALL SELECT 'duplicate_count_max', 'transaction_id', 'critical', NULL, dup, dup <= 0, NULL FROM s
UNION ALL SELECT 'missing_count_max', 'customer_id', 'critical', NULL, miss, miss <= 0, NULL FROM s
UNION ALL SELECT 'invalid_count_max', 'status', 'critical', NULL, inval, inval <= 0, NULL FROM s
UNION ALL SELECT '{_NN}', 'currency', 'critical', NULL, NULL, FALSE, 'Column ''currency'' not found'"""))
def q_suite(spark, sf):
    return Q.run_suite(ledger.bronze_enriched(spark, sf), LEDGER_SUITE)


_QUAR_SQL = with_ctes("bronze", _FLAGS + f"""
, r AS (SELECT *, concat_ws('; ', CASE WHEN f_nn_id THEN '{_NN}:transaction_id' END,
                         CASE WHEN f_uq_id THEN '{_UQ}:transaction_id' END,
                         CASE WHEN f_is_status THEN '{_IS}:status' END) AS reason FROM f)""")


@register("q14_quarantine_split", ids=("Q14", "S8"), headline=True, sql=_QUAR_SQL + f"""
SELECT transaction_id, amount, status, merchant_id, customer_id, transaction_date, payment_method, merchant_name,
       city, reason AS _quarantine_reason, TIMESTAMP '{RUN_TS}' AS _quarantine_ts
FROM r WHERE reason <> ''""")
def q_quarantine(spark, sf):
    _clean, quarantined = Q.quarantine_split(ledger.bronze_enriched(spark, sf), LEDGER_SUITE, RUN_TS)
    return quarantined


@register("q16_load_decision", ids=("Q16", "Q14"), sql=_QUAR_SQL + """
, t AS (SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE reason = '') AS clean_rows,
               COUNT(*) FILTER (WHERE reason <> '') AS quarantined_rows FROM r)
SELECT total_rows, clean_rows, quarantined_rows,
       ROUND(quarantined_rows * 100.0 / total_rows, 1) AS quarantine_pct,
       CASE WHEN ROUND(quarantined_rows * 100.0 / total_rows, 1) > 20 THEN 'reject_all'
            WHEN quarantined_rows > 0 THEN 'quarantine_and_load' ELSE 'load_clean' END AS load_decision,
       (ROUND(quarantined_rows * 100.0 / total_rows, 1) > 10 OR quarantined_rows > 0) AS alert_required
FROM t""")
def q_decision(spark, sf):
    c = Q.split_counts(ledger.bronze_enriched(spark, sf), LEDGER_SUITE)
    j = c.withColumn("total_rows", F.col("clean_rows") + F.col("quarantined_rows"))
    return j.select("total_rows", "clean_rows", "quarantined_rows",
                    *Q.load_decision(F.col("total_rows"), F.col("quarantined_rows"), F.col("quarantined_rows") > 0))


def _profile_sql() -> str:
    cols = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date",
            "payment_method", "merchant_name", "city"]
    parts = []
    for c in cols:
        num = f"TRY_CAST({c} AS DOUBLE)"
        nulls = f"COUNT(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '')"
        numeric = f"COUNT({num}) > COUNT(*) * 0.5"
        parts.append(f"""SELECT '{c}' AS column_name, 'string' AS dtype, COUNT(*) AS total_rows, {nulls} AS null_count,
  FLOOR(({nulls} * 2000 + COUNT(*)) / (COUNT(*) * 2)) / 10.0 AS null_pct,
  COUNT(DISTINCT {c}) AS unique_count, FLOOR((COUNT(DISTINCT {c}) * 2000 + COUNT(*)) / (COUNT(*) * 2)) / 10.0 AS uniqueness_pct,
  CASE WHEN {numeric} THEN 'numeric' ELSE 'string' END AS inferred_type,
  CASE WHEN {numeric} THEN MIN({num}) END AS min_value, CASE WHEN {numeric} THEN MAX({num}) END AS max_value,
  CASE WHEN {numeric} THEN ROUND(AVG({num}), 2) END AS mean_value,
  CASE WHEN {numeric} THEN COUNT(*) FILTER (WHERE {num} < 0) END AS negative_count FROM bronze""")
    return with_ctes("bronze", "\nUNION ALL\n".join(parts))


@register("q1_profile_bronze", ids=("Q1",), sql=_profile_sql())
def q_profile(spark, sf):
    return Q.profile(ledger.bronze_enriched(spark, sf))


@register("q18_dq_scorecard", ids=("Q18",), sql=with_ctes("bronze", f"""
, a AS (SELECT COUNT(*) AS n,
               COUNT(*) FILTER (WHERE amount IS NULL) + COUNT(*) FILTER (WHERE transaction_date IS NULL)
               + COUNT(*) FILTER (WHERE transaction_id IS NULL) + COUNT(*) FILTER (WHERE status IS NULL)
               + COUNT(*) FILTER (WHERE customer_id IS NULL) AS nulls,
               COUNT(DISTINCT transaction_id) AS d FROM bronze),
s AS (SELECT ROUND(nulls / n, 6) AS null_rate, ROUND((n - d) / n, 6) AS duplicate_rate FROM a)
SELECT DATE '{AS_OF}' AS run_date, 'ALL' AS column_name, null_rate, duplicate_rate, 1 AS schema_match,
       ROUND(GREATEST(0.0, LEAST(100.0, 100 - (null_rate * 40 + duplicate_rate * 40))), 4) AS overall_quality_score,
       CASE WHEN ROUND(GREATEST(0.0, LEAST(100.0, 100 - (null_rate * 40 + duplicate_rate * 40))), 4) < 60
            THEN 'HALTED' ELSE 'SUCCESS' END AS pipeline_status, FALSE AS schema_alert
FROM s"""))
def q_scorecard(spark, sf):
    req = ["transaction_id", "customer_id", "amount", "transaction_date", "status"]
    return Q.scorecard(ledger.bronze_enriched(spark, sf), AS_OF, req, "transaction_id", req)


@register("a18_median_amount", ids=("A18", "Q15"), sql=with_ctes("silver", """
SELECT MEDIAN(CAST(amount AS DOUBLE)) AS median_amount, COUNT(*) AS n FROM silver"""))
def q_median(spark, sf):
    s = silver_df(spark, sf)
    med, n = Q.exact_median(s, "amount")
    return spark.createDataFrame([(med, n)], "median_amount double, n bigint")


@register("q21_impossible_rows", ids=("Q21", "Q24", "J6"), sql=with_ctes("txn merchants", f"""
, t AS (SELECT t.*, m.merchant_id IS NOT NULL AS known FROM txn t LEFT JOIN merchants m ON t.merchant_id = m.merchant_id),
f AS (SELECT transaction_id, merchant_id, amount, transaction_date, 'UPI_OVER_LIMIT' AS rule, 'CRITICAL' AS severity
      FROM t WHERE payment_method = 'UPI' AND amount > 100000
      UNION ALL SELECT transaction_id, merchant_id, amount, transaction_date, 'FUTURE_DATE', 'CRITICAL' FROM t
      WHERE transaction_date > DATE '{AS_OF}'
      UNION ALL SELECT transaction_id, merchant_id, amount, transaction_date, 'INVALID_STATUS', 'CRITICAL' FROM t
      WHERE NOT COALESCE(status IN ('COMPLETED', 'FAILED', 'PENDING'), FALSE)
      UNION ALL SELECT transaction_id, merchant_id, amount, transaction_date, 'ORPHAN_MERCHANT', 'CRITICAL' FROM t
      WHERE NOT known
      UNION ALL SELECT transaction_id, merchant_id, amount, transaction_date, 'ZERO_COMPLETED', 'MINOR' FROM t
      WHERE status = 'COMPLETED' AND amount = 0)
SELECT transaction_id, merchant_id, CAST(amount AS DOUBLE) AS amount, transaction_date, rule, severity FROM f"""))
def q_impossible(spark, sf):
    f = Q.impossible_rows(ledger.transactions(spark, sf), ledger.merchants(spark, sf), AS_OF)
    return f.withColumn("amount", F.col("amount").cast("double"))


@register("q21_verdict", ids=("Q21",), sql=with_ctes("txn merchants", f"""
, t AS (SELECT t.*, m.merchant_id IS NOT NULL AS known FROM txn t LEFT JOIN merchants m ON t.merchant_id = m.merchant_id),
f AS (SELECT 'CRITICAL' AS severity FROM t WHERE payment_method = 'UPI' AND amount > 100000
      UNION ALL SELECT 'CRITICAL' FROM t WHERE transaction_date > DATE '{AS_OF}'
      UNION ALL SELECT 'CRITICAL' FROM t WHERE NOT COALESCE(status IN ('COMPLETED', 'FAILED', 'PENDING'), FALSE)
      UNION ALL SELECT 'CRITICAL' FROM t WHERE NOT known
      UNION ALL SELECT 'MINOR' FROM t WHERE status = 'COMPLETED' AND amount = 0)
SELECT COUNT(*) AS issues, COUNT(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
       CASE WHEN COUNT(*) FILTER (WHERE severity = 'CRITICAL') > 0 THEN 'NOT SAFE' ELSE 'SAFE' END AS verdict FROM f"""))
def q_verdict(spark, sf):
    return Q.verdict(Q.impossible_rows(ledger.transactions(spark, sf), ledger.merchants(spark, sf), AS_OF))


@register("q23_outliers", ids=("Q23",), sql=with_ctes("silver", """
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount FROM silver
WHERE amount > (SELECT AVG(amount) FROM silver) * 3"""))
def q_outliers(spark, sf):
    s = silver_df(spark, sf).select("transaction_id", "amount")
    return (Q.outliers(s, "amount", 3.0).where("is_outlier")
            .select("transaction_id", F.col("amount").cast("double").alias("amount")))


@register("q24_future_dated", ids=("Q24",), sql=with_ctes("silver", f"""
SELECT transaction_id, transaction_date FROM silver WHERE transaction_date > DATE '{AS_OF}'"""))
def q_future(spark, sf):
    return Q.future_dated(silver_df(spark, sf), "transaction_date", AS_OF).select("transaction_id", "transaction_date")


@register("q25_null_repair", ids=("Q25", "B2"), sql=with_ctes("txn merchants", """
SELECT t.transaction_id, COALESCE(m.merchant_name, 'UNKNOWN') AS merchant_name,
       COALESCE(m.category, 'UNKNOWN') AS business_category, COALESCE(m.city, 'UNKNOWN') AS merchant_city,
       (CASE WHEN m.merchant_name IS NULL THEN 1 ELSE 0 END) + (CASE WHEN m.category IS NULL THEN 1 ELSE 0 END)
       + (CASE WHEN m.city IS NULL THEN 1 ELSE 0 END) AS _repaired_cells
FROM txn t LEFT JOIN merchants m ON t.merchant_id = m.merchant_id WHERE m.merchant_id IS NULL"""))
def q_repair(spark, sf):
    from ..operators.marts import fct_transactions
    fct = fct_transactions(ledger.transactions(spark, sf), ledger.customers(spark, sf), ledger.merchants(spark, sf))
    r = Q.repair_nulls(fct, ["merchant_name", "business_category", "merchant_city"])
    return r.where(F.col("_repaired_cells") > 0).select("transaction_id", "merchant_name", "business_category",
                                                        "merchant_city", "_repaired_cells")


@register("q26_psi_amount", ids=("Q26",), sql=with_ctes("booked", """
, a AS (SELECT CAST(amount AS DOUBLE) AS v FROM silver),
b AS (SELECT CAST(amount AS DOUBLE) AS v FROM booked),
ba AS (SELECT LEAST(GREATEST(CAST(FLOOR(10.0 * (v - 0.0) / 110000.0) AS BIGINT) + 1, 1), 10) AS bin, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM a) AS p FROM a GROUP BY 1),
bb AS (SELECT LEAST(GREATEST(CAST(FLOOR(10.0 * (v - 0.0) / 110000.0) AS BIGINT) + 1, 1), 10) AS bin, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM b) AS p FROM b GROUP BY 1),
sp AS (SELECT range AS bin FROM range(1, 11))
SELECT ROUND(SUM((GREATEST(COALESCE(bb.p, 0), 1e-6) - GREATEST(COALESCE(ba.p, 0), 1e-6))
                 * LN(GREATEST(COALESCE(bb.p, 0), 1e-6) / GREATEST(COALESCE(ba.p, 0), 1e-6))), 6) AS psi
FROM sp LEFT JOIN ba ON sp.bin = ba.bin LEFT JOIN bb ON sp.bin = bb.bin"""))
def q_psi(spark, sf):
    s = silver_df(spark, sf)
    return Q.psi(s, derived.booked_layer(s), "amount", 0.0, 110000.0, 10)


@register("q26_categorical_drift", ids=("Q26", "U4", "E9"), sql=with_ctes("booked", """
, a AS (SELECT * FROM silver), b AS (SELECT * FROM booked),
s AS (SELECT 'status' AS column_name, x.v AS rv, y.v AS cv FROM (SELECT DISTINCT status AS v FROM a) x
        FULL OUTER JOIN (SELECT DISTINCT status AS v FROM b) y ON x.v = y.v
      UNION ALL SELECT 'payment_method', x.v, y.v FROM (SELECT DISTINCT payment_method AS v FROM a) x
        FULL OUTER JOIN (SELECT DISTINCT payment_method AS v FROM b) y ON x.v = y.v
      UNION ALL SELECT 'merchant_id', x.v, y.v FROM (SELECT DISTINCT CAST(merchant_id AS VARCHAR) AS v FROM a) x
        FULL OUTER JOIN (SELECT DISTINCT CAST(merchant_id AS VARCHAR) AS v FROM b) y ON x.v = y.v)
SELECT column_name, COUNT(*) FILTER (WHERE rv IS NULL) AS new_values, COUNT(*) FILTER (WHERE cv IS NULL) AS missing_values,
       COUNT(*) FILTER (WHERE rv IS NULL) + COUNT(*) FILTER (WHERE cv IS NULL) > 0 AS drifted
FROM s GROUP BY column_name"""))
def q_catdrift(spark, sf):
    s = silver_df(spark, sf)
    return Q.categorical_drift(s, derived.booked_layer(s), ["status", "payment_method", "merchant_id"])


_DIFF_COLUMNS = ["amount", "status", "merchant_id", "customer_id", "transaction_date", "payment_method"]


def _diff_sql(left: str, right: str) -> str:
    one = lambda t: (f"(SELECT transaction_id AS k, max(struct_pack({', '.join(f'{c} := CAST({c} AS VARCHAR)' for c in _DIFF_COLUMNS)})) AS r, COUNT(*) AS n "  # noqa: E731
                     f"FROM {t} WHERE transaction_id IS NOT NULL GROUP BY 1)")
    item = lambda m, n, of, c="NULL": f"SELECT '{m}' AS measure, CAST({c} AS VARCHAR) AS column_name, CAST({n} AS BIGINT) AS rows, {'ROUND(' + n + ' * 1.0 / NULLIF(' + of + ', 0), 6)' if of else 'CAST(NULL AS DOUBLE)'} AS share FROM t"
    drift = ", ".join(f"COUNT(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND a.{c} IS DISTINCT FROM b.{c}) AS d_{c}" for c in _DIFF_COLUMNS)
    return f"""
, j AS (SELECT x.k AS ak, y.k AS bk, x.r AS a, y.r AS b, x.n AS an, y.n AS bn FROM {one(left)} x FULL OUTER JOIN {one(right)} y ON x.k = y.k),
t AS (SELECT COUNT(ak) AS ka, COUNT(bk) AS kb, COUNT(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL) AS both_sides, COUNT(*) FILTER (bk IS NULL) AS dropped, COUNT(*) FILTER (ak IS NULL) AS added,
  COUNT(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND a IS DISTINCT FROM b) AS changed, COUNT(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND a IS NOT DISTINCT FROM b) AS same,
  COALESCE(SUM(an - 1), 0) AS xa, COALESCE(SUM(bn - 1), 0) AS xb, (SELECT COUNT(*) FROM {left} WHERE transaction_id IS NULL) AS na, (SELECT COUNT(*) FROM {right} WHERE transaction_id IS NULL) AS nb, {drift} FROM j)
""" + " UNION ALL ".join([item("left_keys", "ka", ""), item("right_keys", "kb", ""), item("dropped", "dropped", "ka"), item("added", "added", "kb"), item("changed", "changed", "ka"),
                          item("same", "same", "ka"), item("left_copies", "xa", ""), item("right_copies", "xb", ""), item("left_null_keys", "na", ""), item("right_null_keys", "nb", ""),
                          *[item("drifted", f"d_{c}", "both_sides", f"'{c}'") for c in _DIFF_COLUMNS]])


@register("q26_layer_diff_booked", ids=("Q26", "A23", "Q27"), sql=with_ctes("booked", _diff_sql("silver", "booked")))
def q_layer_diff(spark, sf):
    s = silver_df(spark, sf)
    return layer_diff(s, derived.booked_layer(s), "transaction_id", _DIFF_COLUMNS)


@register("q26_layer_diff_bronze_silver", ids=("Q26", "A23", "Q27"), sql=with_ctes("txn silver", _diff_sql("txn", "silver")))
def q_layer_diff_bronze(spark, sf):
    return layer_diff(ledger.transactions(spark, sf), silver_df(spark, sf), "transaction_id", _DIFF_COLUMNS)


ORDERS_CONTRACT = [
    Q.Check("row_count_between", None, {"lo": 1}),
    Q.Check("missing_count_max", "order_id", {"max": 0}),
    Q.Check("duplicate_values_max", "order_id", {"max": 0}),
    Q.Check("missing_count_max", "customer_id", {"max": 0}),
    Q.Check("min_at_least", "amount", {"lo": 0}),
    Q.Check("invalid_count_max", "status", {"values": STATUSES, "max": 0}),
]


@register("q11_contract_checks_orders", ids=("Q11", "E7"), sql="""
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
                  o_totalprice AS amount, o_orderstatus AS status FROM orders),
s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS rc,
             CAST(COUNT(*) FILTER (WHERE order_id IS NULL OR trim(order_id) = '') AS DOUBLE) AS m1,
             CAST((SELECT COUNT(*) FROM (SELECT order_id FROM o WHERE order_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)) AS DOUBLE) AS dv,
             CAST(COUNT(*) FILTER (WHERE customer_id IS NULL OR trim(customer_id) = '') AS DOUBLE) AS m2,
             ROUND(MIN(amount), 4) AS mn,
             CAST(COUNT(*) FILTER (WHERE status IS NOT NULL AND status NOT IN ('COMPLETED', 'FAILED', 'PENDING')) AS DOUBLE) AS inv
      FROM o)
SELECT 'row_count_between' AS check_name, CAST(NULL AS VARCHAR) AS column_name, 'critical' AS severity,
       CAST(NULL AS BIGINT) AS failed_row_count, rc AS observed_value, rc >= 1 AS passed, CAST(NULL AS VARCHAR) AS error FROM s
UNION ALL SELECT 'missing_count_max', 'order_id', 'critical', NULL, m1, m1 <= 0, NULL FROM s
UNION ALL SELECT 'duplicate_values_max', 'order_id', 'critical', NULL, dv, dv <= 0, NULL FROM s
UNION ALL SELECT 'missing_count_max', 'customer_id', 'critical', NULL, m2, m2 <= 0, NULL FROM s
UNION ALL SELECT 'min_at_least', 'amount', 'critical', NULL, mn, COALESCE(mn >= 0, TRUE), NULL FROM s
UNION ALL SELECT 'invalid_count_max', 'status', 'critical', NULL, inv, inv <= 0, NULL FROM s""")
def q_contract(spark, sf):
    from ..sources.tables import read_table
    o = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"))
    return Q.run_suite(o, ORDERS_CONTRACT)


@register("q20_issue_counts", ids=("Q20",), sql=with_ctes("bronze", """
, d AS (SELECT transaction_id FROM bronze WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1),
n AS (SELECT b.*, TRY_CAST(replace(b.amount, ',', '') AS DECIMAL(18,2)) AS amt,
             COALESCE(TRY_STRPTIME(b.transaction_date, '%Y-%m-%d'), TRY_STRPTIME(b.transaction_date, '%Y/%m/%d'),
                      TRY_STRPTIME(b.transaction_date, '%d-%m-%Y'), TRY_STRPTIME(b.transaction_date, '%d/%m/%Y')) AS dt,
             d.transaction_id IS NOT NULL AS dup
      FROM bronze b LEFT JOIN d ON b.transaction_id = d.transaction_id),
m AS (SELECT AVG(amt) AS mean FROM n),
c AS (SELECT CASE
        WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'blank transaction_id|H|false'
        WHEN amt < 0 THEN 'negative amount|H|false'
        WHEN dup THEN 'duplicate id|H|false'
        WHEN amt > (SELECT mean FROM m) * 100 THEN 'outlier amount|H|false'
        WHEN dt IS NULL THEN 'invalid date|H|true'
        WHEN NOT regexp_matches(transaction_date, '^\\d{4}-\\d{2}-\\d{2}$') THEN 'non-standard date format|M|true'
        WHEN amt = 0 THEN 'zero amount|M|false'
        WHEN merchant_name IS NULL OR trim(merchant_name) = '' THEN 'blank merchant_name|M|false'
        WHEN contains(amount, ',') THEN 'comma in amount|M|true'
        WHEN status <> upper(trim(status)) THEN 'status casing|L|true' END AS k FROM n)
SELECT split_part(k, '|', 1) AS issue_found, split_part(k, '|', 2) AS severity,
       CAST(split_part(k, '|', 3) AS BOOLEAN) AS auto_fixable, COUNT(*) AS n
FROM c WHERE k IS NOT NULL GROUP BY k"""))
def q_issues(spark, sf):
    b = ledger.bronze_enriched(spark, sf)
    c = Q.classify_issue(b, currency_col="__none__")
    return (c.where(F.col("issue_found").isNotNull()).groupBy("issue_found", "severity", "auto_fixable")
            .agg(F.count(F.lit(1)).alias("n")))


@register("w3_first_occurrence", ids=("W3",), sql=with_ctes("txn", """
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, status, merchant_id, transaction_date FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
                               ORDER BY transaction_date, src_seq, merchant_id, amount, status, customer_id,
                                        payment_method) AS rn FROM txn) WHERE rn = 1"""))
def q_w3(spark, sf):
    from ..operators.silver import keep_first
    t = ledger.transactions(spark, sf)
    f = keep_first(t, "transaction_id", ["transaction_date", "src_seq", "merchant_id", "amount"])
    return f.select("transaction_id", F.col("amount").cast("double").alias("amount"), "status", "merchant_id",
                    "transaction_date")


@register("q12_model_tests", ids=("Q12", "J6"), sql=with_ctes("silver merchants", """
, perf AS (SELECT merchant_id, COALESCE(ROUND(COUNT(CASE WHEN status = 'FAILED' THEN 1 END) * 100.0 / COUNT(*), 2), 0.0)
                  AS failure_rate_pct FROM silver GROUP BY merchant_id)
SELECT 'unique' AS test_name, 'merchants.merchant_id' AS target,
       (SELECT COUNT(*) FROM merchants WHERE merchant_id IN
          (SELECT merchant_id FROM merchants GROUP BY 1 HAVING COUNT(*) > 1)) AS failures
UNION ALL SELECT 'not_null', 'merchants.merchant_name',
       (SELECT COUNT(*) FROM merchants WHERE merchant_name IS NULL OR trim(merchant_name) = '')
UNION ALL SELECT 'accepted_values', 'silver.payment_method',
       (SELECT COUNT(*) FROM silver WHERE NOT COALESCE(payment_method IN ('UPI', 'CREDIT_CARD', 'DEBIT_CARD'), FALSE))
UNION ALL SELECT 'relationships', 'silver.merchant_id -> merchants',
       (SELECT COUNT(*) FROM silver s WHERE NOT EXISTS (SELECT 1 FROM merchants m WHERE m.merchant_id = s.merchant_id))
UNION ALL SELECT 'range_0_100', 'merchant_performance.failure_rate_pct',
       (SELECT COUNT(*) FROM perf WHERE failure_rate_pct < 0 OR failure_rate_pct > 100)"""))
def q_q12(spark, sf):
    """Silver once: its rows are counted per merchant, and the tests over rows, keys and rates add those counts up."""
    m = ledger.merchants(spark, sf)
    bad_method = ~F.coalesce(F.col("payment_method").isin("UPI", "CREDIT_CARD", "DEBIT_CARD"), F.lit(False))
    per = silver_df(spark, sf).groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad_method).alias("bad_methods"), count_when(F.col("status") == "FAILED").alias("failed"))
    per = (per.join(m.select("merchant_id").distinct().withColumn("_known", F.lit(True)), "merchant_id", "left")
           .withColumn("failure_rate_pct", pct_or_zero("failed", "n")))
    row = per.agg(F.coalesce(F.sum("bad_methods"), F.lit(0)).alias("accepted"),
                  F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
                  F.count_if(~F.col("failure_rate_pct").between(0, 100)).alias("out_of_range"))
    tests = [("accepted_values", "silver.payment_method", "accepted"), ("relationships", "silver.merchant_id -> merchants", "orphans"),
             ("range_0_100", "merchant_performance.failure_rate_pct", "out_of_range")]
    rows = row.select(F.inline(F.array(*[F.struct(F.lit(t).alias("test_name"), F.lit(c).alias("target"), F.col(n).alias("failures"))
                                         for t, c, n in tests])))
    suite = Q.run_suite(m, [Q.unique("merchant_id"), Q.not_null("merchant_name")])
    name = F.when(F.col("check_name") == _UQ, "unique").otherwise("not_null")
    return rows.unionByName(suite.select(name.alias("test_name"), F.concat(F.lit("merchants."), "column_name").alias("target"),
                                         F.col("failed_row_count").alias("failures")))
