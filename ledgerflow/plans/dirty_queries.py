"""Rules over the dirty view of the whole ledger (``ledger.dirty_bronze``), where every branch of theirs occurs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import marts as M
from ..operators import quality as Q
from ..operators import recovery as R
from ..operators.repair_loop import repair_loop
from ..operators.silver import build_silver, silver_filter
from ..session import ensure_checkpoint_dir
from ..sources import ledger
from ..sources.tables import read_table
from .oracle import with_ctes
from .registry import register

AS_OF = ledger.LEDGER_AS_OF
LOADED_AT = AS_OF + " 02:00:00"
STATUSES, CURRENCIES = ("COMPLETED", "FAILED", "PENDING"), ("INR", "USD")
_STATUS, _CURRENCY = "('COMPLETED', 'FAILED', 'PENDING')", "('INR', 'USD')"
_NN, _UQ = "expect_column_values_to_not_be_null", "expect_column_values_to_be_unique"
_BT, _IS = "expect_column_values_to_be_between", "expect_column_values_to_be_in_set"
_RX = "expect_column_values_to_match_regex"

DIRTY_SUITE = [
    Q.not_null("transaction_id"), Q.unique("transaction_id"), Q.between("amount", 0, 1000000, severity="warning"),
    Q.in_set("status", STATUSES), Q.matches("transaction_date", r"\d{4}-\d{2}-\d{2}$", severity="warning"),
    Q.in_set("currency", CURRENCIES), Q.not_null("merchant_name", severity="warning"), Q.unique("merchant_name", severity="warning"),
    Q.Check("min_at_least", "amount", {"lo": 0}), Q.Check("duplicate_count_max", "transaction_id", {"max": 0}),
    Q.Check("duplicate_values_max", "merchant_name", {"max": 0}), Q.Check("missing_count_max", "currency", {"max": 0}),
    Q.Check("invalid_count_max", "currency", {"values": CURRENCIES, "max": 0}), Q.not_null("channel"),
]

# the row flags in SQL, each value's rows counted by a window
_FLAGS = f"""
, f AS (SELECT d.*, TRY_CAST(amount AS DOUBLE) AS num, COUNT(*) OVER (PARTITION BY transaction_id) > 1 AS uq,
       COUNT(*) OVER (PARTITION BY merchant_name) > 1 AS uq_name, (transaction_id IS NULL OR trim(transaction_id) = '') AS nn,
       NOT COALESCE(status IN {_STATUS}, FALSE) AS st, NOT COALESCE(currency IN {_CURRENCY}, FALSE) AS cu FROM dirty d)"""
_REASON = f"concat_ws('; ', CASE WHEN nn THEN '{_NN}:transaction_id' END, CASE WHEN uq THEN '{_UQ}:transaction_id' END, CASE WHEN st THEN '{_IS}:status' END, CASE WHEN cu THEN '{_IS}:currency' END)"


def _check_sql(name: str, column: str, severity: str, failed: str = "", observed: str = "", ok: str = "", error: str = "NULL") -> str:
    n = f"COUNT(*) FILTER ({failed})" if failed else "CAST(NULL AS BIGINT)"
    passed = ok or (f"COUNT(*) FILTER ({failed}) = 0" if failed else "FALSE")
    source = "FROM f" if n != "CAST(NULL AS BIGINT)" or observed else ""
    return (f"SELECT '{name}' AS check_name, '{column}' AS column_name, '{severity}' AS severity, {n} AS failed_row_count, "
            f"CAST({observed or 'NULL'} AS DOUBLE) AS observed_value, {passed} AS passed, CAST({error} AS VARCHAR) AS error {source}")


def _max_sql(name: str, column: str, n: str) -> str:
    return _check_sql(name, column, "critical", observed=n, ok=f"{n} <= 0")


@register("q13_suite_dirty", ids=("Q13", "Q2", "Q3", "Q4", "Q5", "Q6", "Q8", "Q9", "Q10", "Q11"), sql=with_ctes("dirty", _FLAGS + "\n" + "\nUNION ALL ".join([
    _check_sql(_NN, "transaction_id", "critical", "nn"), _check_sql(_UQ, "transaction_id", "critical", "uq"),
    _check_sql(_BT, "amount", "warning", "num IS NULL OR num < 0 OR num > 1000000"), _check_sql(_IS, "status", "critical", "st"),
    _check_sql(_RX, "transaction_date", "warning", "NOT COALESCE(regexp_matches(transaction_date, '^\\d{4}-\\d{2}-\\d{2}$'), FALSE)"),
    _check_sql(_IS, "currency", "critical", "cu"), _check_sql(_NN, "merchant_name", "warning", "merchant_name IS NULL OR trim(merchant_name) = ''"),
    _check_sql(_UQ, "merchant_name", "warning", "uq_name"),
    _check_sql("min_at_least", "amount", "critical", observed="ROUND(MIN(num), 4)", ok="COALESCE(MIN(num) >= 0, TRUE)"),
    _max_sql("duplicate_count_max", "transaction_id", "(COUNT(transaction_id) - COUNT(DISTINCT transaction_id))"),
    _max_sql("duplicate_values_max", "merchant_name", "COUNT(DISTINCT CASE WHEN uq_name THEN merchant_name END)"),
    _max_sql("missing_count_max", "currency", "COUNT(*) FILTER (currency IS NULL OR trim(currency) = '')"),
    _max_sql("invalid_count_max", "currency", f"COUNT(*) FILTER (currency NOT IN {_CURRENCY})"),
    _check_sql(_NN, "channel", "critical", error="'Column ''channel'' not found'")])))
def q_suite_dirty(spark, sf):
    return Q.run_suite(ledger.dirty_bronze(spark, sf), DIRTY_SUITE)


@register("q14_quarantine_dirty", ids=("Q14", "S8", "P11"), sql=with_ctes("dirty", _FLAGS + f"""
SELECT transaction_id, amount, status, currency, transaction_date, {_REASON} AS _quarantine_reason, TIMESTAMP '{LOADED_AT}' AS _quarantine_ts
FROM f WHERE nn OR uq OR st OR cu"""))
def q_quarantine_dirty(spark, sf):
    rows = ledger.dirty_bronze(spark, sf).select("transaction_id", "amount", "status", "currency", "transaction_date")
    return Q.quarantine_split(rows, DIRTY_SUITE, LOADED_AT)[1]


@register("q16_load_decision_per_day", ids=("Q16",), sql=with_ctes("dirty", _FLAGS + """
, t AS (SELECT transaction_date, COUNT(*) AS total_rows, COUNT(*) FILTER (nn OR st OR cu) AS quarantined_rows FROM f GROUP BY 1),
p AS (SELECT *, ROUND(quarantined_rows * 100.0 / total_rows, 1) AS quarantine_pct FROM t)
SELECT *, CASE WHEN quarantine_pct > 20 THEN 'reject_all' WHEN quarantined_rows > 0 THEN 'quarantine_and_load' ELSE 'load_clean' END AS load_decision,
       quarantine_pct > 10 OR quarantined_rows > 0 AS alert_required FROM p"""))
def q_decisions(spark, sf):
    checks = [c for c in DIRTY_SUITE if c.kind in ("not_null", "in_set") and c.column != "channel"]
    return Q.load_decisions(ledger.dirty_bronze(spark, sf), checks, "transaction_date")


@register("q18_null_rate_per_column", ids=("Q18", "Q1"), sql=with_ctes("dirty", "\nUNION ALL ".join(
    f"SELECT DATE '{AS_OF}' AS run_date, '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL OR trim({c}) = '') AS nulls, "
    f"ROUND(COUNT(*) FILTER ({c} IS NULL OR trim({c}) = '') * 1.0 / COUNT(*), 6) AS null_rate FROM dirty"
    for c in ("transaction_id", "amount", "merchant_name", "city", "currency", "note"))))
def q_null_rates(spark, sf):
    cols = ["transaction_id", "amount", "merchant_name", "city", "currency", "note"]
    return Q.column_null_rates(ledger.dirty_bronze(spark, sf).select(*cols), AS_OF)


_TOP = ("transaction_id", "amount", "status", "merchant_name", "city", "currency", "payment_method")


@register("q1_top_values", ids=("Q1",), sql=with_ctes("dirty", f"""
, v AS (UNPIVOT (SELECT {', '.join(_TOP)} FROM dirty) ON {', '.join(_TOP)} INTO NAME column_name VALUE value),
c AS (SELECT column_name, value, COUNT(*) AS n FROM v WHERE trim(value) <> '' GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS value_rank FROM c)
SELECT column_name, CAST(value_rank AS INTEGER) AS value_rank, value, n, FLOOR((n * 2000 + t) / (t * 2)) / 10.0 AS share_pct FROM r, (SELECT COUNT(*) AS t FROM dirty) WHERE value_rank <= 5"""))
def q_top_values(spark, sf):
    return Q.top_values(ledger.dirty_bronze(spark, sf).select(*_TOP), 5)


@register("q20_issue_classes", ids=("Q20", "Q22"), sql=with_ctes("dirty", f"""
, n AS (SELECT d.*, TRY_CAST(replace(amount, ',', '') AS DECIMAL(18,2)) AS amt, COUNT(*) OVER (PARTITION BY transaction_id) > 1 AS dup,
             COALESCE(TRY_STRPTIME(transaction_date, '%Y-%m-%d'), TRY_STRPTIME(transaction_date, '%Y/%m/%d'),
                      TRY_STRPTIME(transaction_date, '%d-%m-%Y'), TRY_STRPTIME(transaction_date, '%d/%m/%Y')) AS dt,
             CASE upper(trim(currency)) WHEN 'IND' THEN 'INR' WHEN 'RS' THEN 'INR' WHEN 'US$' THEN 'USD' ELSE upper(trim(currency)) END AS cur
      FROM dirty d),
c AS (SELECT CASE
        WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'blank transaction_id|H|false'
        WHEN amt < 0 THEN 'negative amount|H|false' WHEN dup THEN 'duplicate id|H|false'
        WHEN amt > (SELECT AVG(amt) FROM n) * 100 THEN 'outlier amount|H|false' WHEN dt IS NULL THEN 'invalid date|H|true'
        WHEN NOT regexp_matches(transaction_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN 'non-standard date format|M|true'
        WHEN amt = 0 THEN 'zero amount|M|false' WHEN merchant_name IS NULL OR trim(merchant_name) = '' THEN 'blank merchant_name|M|false'
        WHEN contains(amount, ',') THEN 'comma in amount|M|true' WHEN currency <> cur THEN 'currency alias|M|true'
        WHEN NOT COALESCE(cur IN {_CURRENCY}, FALSE) THEN 'unsupported currency|M|true'
        WHEN status <> upper(trim(status)) THEN 'status casing|L|true' END AS k FROM n)
SELECT split_part(k, '|', 1) AS issue_found, split_part(k, '|', 2) AS severity, CAST(split_part(k, '|', 3) AS BOOLEAN) AS auto_fixable, COUNT(*) AS n
FROM c WHERE k IS NOT NULL GROUP BY k"""))
def q_issue_classes(spark, sf):
    c = Q.classify_issue(ledger.dirty_bronze(spark, sf).drop("src_seq"))
    return (c.where(F.col("issue_found").isNotNull()).groupBy("issue_found", "severity", "auto_fixable")
            .agg(F.count(F.lit(1)).alias("n")))


# typed rows of the dirty view
_TYPED = """
, typed AS (SELECT transaction_id, TRY_CAST(replace(amount, ',', '') AS DECIMAL(18,2)) AS amount, status, TRY_CAST(merchant_id AS BIGINT) AS merchant_id,
   CAST(customer_id AS BIGINT) AS customer_id, CAST(COALESCE(TRY_STRPTIME(transaction_date, '%Y-%m-%d'), TRY_STRPTIME(transaction_date, '%Y/%m/%d')) AS DATE) AS transaction_date,
   payment_method, src_seq, currency, note FROM dirty)"""


def typed(spark, sf) -> DataFrame:
    n = Q.normalise(ledger.dirty_bronze(spark, sf))
    return n.select("transaction_id", F.col("amount_norm").alias("amount"), "status", F.expr("try_cast(merchant_id AS BIGINT)").alias("merchant_id"),
                    F.col("customer_id").cast("bigint").alias("customer_id"), F.col("transaction_date_norm").alias("transaction_date"),
                    "payment_method", "src_seq", "currency", "note")


@register("p3_silver_dirty", ids=("P3", "W2", "J1"), sql=with_ctes("dirty merchants", _TYPED + """
, d AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY transaction_date DESC, src_seq DESC, merchant_id DESC, amount DESC,
          status DESC, customer_id DESC, payment_method DESC) AS rn FROM typed WHERE transaction_id IS NOT NULL AND amount >= 0)
SELECT d.transaction_id, CAST(d.amount AS DOUBLE) AS amount, d.status, d.merchant_id, d.customer_id, d.transaction_date, m.merchant_name,
       CASE WHEN m.merchant_id IS NULL THEN 'UNMATCHED' ELSE 'CLEAN' END AS quality_flag
FROM d LEFT JOIN merchants m ON d.merchant_id = m.merchant_id WHERE rn = 1"""))
def q_silver_dirty(spark, sf):
    s = build_silver(typed(spark, sf).drop("currency", "note"), ledger.merchants(spark, sf))
    return s.select("transaction_id", F.col("amount").cast("double").alias("amount"), "status", "merchant_id", "customer_id",
                    "transaction_date", "merchant_name", "quality_flag")


@register("p4_strict_positive", ids=("P4", "P3"), sql=with_ctes("dirty", _TYPED + """
SELECT status, COUNT(*) FILTER (amount >= 0) AS kept, COUNT(*) FILTER (amount > 0) AS kept_strict FROM typed
WHERE transaction_id IS NOT NULL AND amount >= 0 GROUP BY 1"""))
def q_strict(spark, sf):
    t = typed(spark, sf)
    per = lambda strict, name: silver_filter(t, strict_positive=strict).groupBy("status").agg(F.count(F.lit(1)).alias(name))
    return per(False, "kept").join(per(True, "kept_strict"), "status", "left").fillna(0)


@register("p11_reasons_dirty", ids=("P11",), sql=with_ctes("dirty", """
SELECT CASE WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'missing_id' WHEN COALESCE(TRY_CAST(amount AS DOUBLE) <= 0, TRUE) THEN 'non_positive_amount'
            WHEN NOT COALESCE(regexp_matches(transaction_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'), FALSE) THEN 'bad_date_format' ELSE 'CLEAN' END AS route, COUNT(*) AS n
FROM dirty GROUP BY 1"""))
def q_routes(spark, sf):
    route = F.coalesce(R.quarantine_reason(), F.lit("CLEAN")).alias("route")
    return ledger.dirty_bronze(spark, sf).groupBy(route).agg(F.count(F.lit(1)).alias("n"))


@register("p2_stage_typed", ids=("P2",), sql=with_ctes("dirty", f"""
SELECT lower(transaction_id) AS transaction_id, CAST(TRY_CAST(amount AS DECIMAL(10,2)) AS DOUBLE) AS amount, lower(status) AS status, lower(merchant_id) AS merchant_id,
       lower(customer_id) AS customer_id, CAST(TRY_STRPTIME(transaction_date, '%Y-%m-%d') AS DATE) AS transaction_date, lower(payment_method) AS payment_method,
       TIMESTAMP '{LOADED_AT}' AS loaded_at FROM dirty WHERE merchant_id NOT LIKE 'TEST_%'"""))
def q_stage_typed(spark, sf):
    return M.stage_typed(ledger.dirty_bronze(spark, sf), LOADED_AT).withColumn("amount", F.col("amount").cast("double"))


_STAGED = {
    "transactions": ("transaction_id", {"transaction_id": "transaction_id", "customer_id": "customer_id", "merchant_id": "merchant_id", "amount": "amount", "currency": "currency",
                                        "payment_method": "payment_method", "transaction_date": "transaction_date", "transaction_status": "status"}),
    "customers": ("c_custkey", {"customer_id": "c_custkey", "full_name": "c_name", "account_tier": "c_mktsegment", "home_nation": "c_nationkey", "balance": "c_acctbal"}),
    "merchants": ("s_suppkey", {"merchant_id": "s_suppkey", "merchant_name": "s_name", "merchant_nation": "s_nationkey", "balance": "s_acctbal"}),
    "orders": ("o_orderkey", {"order_id": "o_orderkey", "user_id": "o_custkey", "order_placed_on": "o_orderdate", "order_status": "o_orderstatus", "final_amount_paid": "o_totalprice"}),
}


def _stage_sql(model: str, table: str, where: str = "") -> str:
    key, columns = _STAGED[model]
    cols = ", ".join(f"{old} AS {new}" for new, old in columns.items() if new != "amount")
    amount = "CAST(amount AS DOUBLE) AS amount, " if "amount" in columns else ""
    return f"SELECT {amount}{cols}, TIMESTAMP '{LOADED_AT}' AS _loaded_at FROM {table} WHERE {key} IS NOT NULL{where}"


@register("p1_stg_transactions", ids=("P1", "P4"), sql=with_ctes("dirty", _TYPED + "\n" + _stage_sql("transactions", "typed", " AND amount > 0")))
def q_stg_transactions(spark, sf):
    key, columns = _STAGED["transactions"]
    rows = silver_filter(typed(spark, sf), strict_positive=True)
    return M.stage(rows, columns, key, LOADED_AT).withColumn("amount", F.col("amount").cast("double"))


def _stage_query(model: str, table: str) -> None:
    key, columns = _STAGED[model]

    @register(f"p1_stg_{model}", ids=("P1",), sql=_stage_sql(model, table))
    def query(spark, sf):
        return M.stage(read_table(spark, sf, table), columns, key, LOADED_AT)


for _model, _table in (("customers", "customer"), ("merchants", "supplier"), ("orders", "orders")):
    _stage_query(_model, _table)


@register("q21_rules_dirty", ids=("Q21", "Q24"), sql=with_ctes("dirty merchants", _TYPED + f"""
, t AS (SELECT t.*, m.merchant_id IS NOT NULL AS known FROM typed t LEFT JOIN merchants m ON t.merchant_id = m.merchant_id),
r AS (SELECT unnest([CASE WHEN payment_method = 'UPI' AND amount > 100000 THEN 'UPI_OVER_LIMIT|CRITICAL' END, CASE WHEN transaction_date > DATE '{AS_OF}' THEN 'FUTURE_DATE|CRITICAL' END,
    CASE WHEN NOT COALESCE(status IN {_STATUS}, FALSE) THEN 'INVALID_STATUS|CRITICAL' END, CASE WHEN NOT known THEN 'ORPHAN_MERCHANT|CRITICAL' END,
    CASE WHEN status = 'COMPLETED' AND amount = 0 THEN 'ZERO_COMPLETED|MINOR' END]) AS k FROM t)
SELECT split_part(k, '|', 1) AS rule, split_part(k, '|', 2) AS severity, COUNT(*) AS n FROM r WHERE k IS NOT NULL GROUP BY k"""))
def q_rules_dirty(spark, sf):
    return (Q.impossible_rows(typed(spark, sf), ledger.merchants(spark, sf), AS_OF).groupBy("rule", "severity")
            .agg(F.count(F.lit(1)).alias("n")))


@register("q22_row_decisions", ids=("Q22",), sql=with_ctes("dirty", _TYPED + f"""
SELECT transaction_id, currency, CASE WHEN amount < 0 OR NOT COALESCE(currency IN ('INR', 'USD', 'EUR'), FALSE) OR transaction_date > DATE '{AS_OF}' THEN 'QUARANTINE'
  WHEN amount > 100000 AND note IS NULL THEN 'FLAG' ELSE 'PASS' END AS decision FROM typed"""))
def q_row_decisions(spark, sf):
    return Q.row_decision(typed(spark, sf), AS_OF, flag_over=100000.0).select("transaction_id", "currency", "decision")


@register("q23_outliers_dirty", ids=("Q23",), sql=with_ctes("dirty", _TYPED + """
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount FROM typed WHERE amount > (SELECT AVG(amount) FROM typed) * 3"""))
def q_outliers_dirty(spark, sf):
    return (Q.outliers(typed(spark, sf).select("transaction_id", "amount"), "amount").where("is_outlier")
            .select("transaction_id", F.col("amount").cast("double").alias("amount")))


@register("q15_fix_log", ids=("Q15", "A18"), sql=with_ctes("dirty", """
, x AS (SELECT unnest([CASE WHEN amount IS NULL OR trim(amount) = '' THEN 'null_amount_filled_with_median' END,
                       CASE WHEN transaction_date IS NOT NULL AND TRY_STRPTIME(transaction_date, '%Y-%m-%d') IS NULL THEN 'invalid_dates_marked' END]) AS fix FROM dirty)
SELECT fix, COUNT(*) AS rows_affected, (SELECT MEDIAN(TRY_CAST(amount AS DOUBLE)) FROM dirty) AS median_amount FROM x WHERE fix IS NOT NULL GROUP BY fix"""))
def q_fix_log(spark, sf):
    rows = ledger.dirty_bronze(spark, sf)
    median, _n = Q.exact_median(rows, "amount")
    return Q.fix_log(Q.auto_fix(rows, median=median)).withColumn("median_amount", F.lit(median).cast("double"))


# What to try per failing check, in turn
REPAIR_SUITE = [Q.not_null("channel", severity="warning"), Q.between("amount", 0, 1000000, severity="warning"), Q.not_null("transaction_id"),
                Q.in_set("status", STATUSES), Q.in_set("currency", CURRENCIES)]
CATALOGUE = {
    (_NN, "channel"): [("add_column", "string"), ("fill_default", "WEB")],
    (_BT, "amount"): [("cast_column", "double"), ("drop_bad_rows", None)],
    (_NN, "transaction_id"): [("drop_bad_rows", None)],
    (_IS, "status"): [("drop_bad_rows", None)],
    (_IS, "currency"): [("fill_default", "INR")],
}


def _state_row(attempt: int, check: str, column: str, action: str, failed: str, changed: str, n: str) -> str:
    return (f"SELECT {attempt} AS attempt, '{check}' AS check_name, '{column}' AS column_name, '{action}' AS action, CAST({failed} AS BIGINT) AS failed_before, "
            f"CAST({changed} AS BIGINT) AS rows_changed, (SELECT COUNT(*) FROM d{attempt}) AS rows_after FROM d{attempt - 1}")


_BAD0, _BAD1 = "COUNT(*) FILTER (num IS NULL OR num < 0 OR num > 1000000)", "COUNT(*) FILTER (amt IS NULL OR amt < 0 OR amt > 1000000)"


@register("r14_repair_loop", ids=("R14", "E4", "E5"), sql=with_ctes("dirty", f"""
, d0 AS (SELECT *, TRY_CAST(amount AS DOUBLE) AS num, TRY_CAST(replace(amount, ',', '') AS DOUBLE) AS amt, (transaction_id IS NULL OR trim(transaction_id) = '') AS nn,
                NOT COALESCE(status IN {_STATUS}, FALSE) AS st FROM dirty),
d1 AS (SELECT * FROM d0 WHERE NOT nn AND NOT st), d2 AS (SELECT * FROM d1 WHERE amt >= 0 AND amt <= 1000000), d3 AS (SELECT * FROM d2)
""" + " UNION ALL ".join([
    _state_row(1, _NN, "channel", "add_column", "NULL", "COUNT(*)", "d1"),
    _state_row(1, _BT, "amount", "cast_column", _BAD0, "COUNT(*) FILTER ((num IS NULL AND amt IS NOT NULL) OR (trim(amount) <> '' AND amt IS NULL))", "d1"),
    _state_row(1, _NN, "transaction_id", "drop_bad_rows", "COUNT(*) FILTER (nn)", "COUNT(*) FILTER (nn)", "d1"),
    _state_row(1, _IS, "status", "drop_bad_rows", "COUNT(*) FILTER (st)", "COUNT(*) FILTER (st)", "d1"),
    _state_row(1, _IS, "currency", "fill_default", f"COUNT(*) FILTER (NOT COALESCE(currency IN {_CURRENCY}, FALSE))", "COUNT(*) FILTER (currency IS NULL)", "d1"),
    _state_row(2, _NN, "channel", "fill_default", "COUNT(*)", "COUNT(*)", "d2"), _state_row(2, _BT, "amount", "drop_bad_rows", _BAD1, _BAD1, "d2"),
    _state_row(2, _IS, "currency", "escalate", f"COUNT(*) FILTER (currency NOT IN {_CURRENCY})", "0", "d2"),
    "SELECT 3, NULL, NULL, 'unresolved', 1, 0, (SELECT COUNT(*) FROM d3)"])))
def q_repair_loop(spark, sf):
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerflow-repair/{uuid.uuid4().hex}"
    rows = ledger.dirty_bronze(spark, sf).drop("src_seq")
    return repair_loop(rows, REPAIR_SUITE, CATALOGUE, root)[1]
