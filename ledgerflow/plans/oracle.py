"""SQL text of the test-data adapter for the DuckDB oracle.

Mirrors ``sources/ledger.py`` (same mapping, written independently as SQL).
``with_ctes`` prefixes a query body with the views it needs.
"""

from __future__ import annotations

CTES: dict[str, str] = {
    "txn": """
  SELECT 'TXN' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CASE l_returnflag WHEN 'A' THEN 'COMPLETED' WHEN 'R' THEN 'FAILED' ELSE 'PENDING' END AS status,
         l_suppkey AS merchant_id,
         o_custkey AS customer_id,
         CAST(l_shipdate AS DATE) AS transaction_date,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'CREDIT_CARD'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'DEBIT_CARD' ELSE 'UPI' END AS payment_method,
         l_partkey AS src_seq
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "merchant_master": """
  SELECT s_suppkey AS merchant_id, s_name AS merchant_name, r_name AS category, n_name AS city,
         s_acctbal >= 0 AS is_active
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "merchants": """
  SELECT merchant_id, merchant_name, category, city FROM merchant_master WHERE is_active""",
    "silver": """
  SELECT d.transaction_id, d.amount, d.status, d.merchant_id, d.customer_id, d.transaction_date,
         d.payment_method, m.merchant_name, m.category, m.city,
         CASE WHEN m.merchant_id IS NULL THEN 'UNMATCHED' ELSE 'CLEAN' END AS quality_flag
  FROM (SELECT * FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
                   ORDER BY transaction_date DESC, src_seq DESC, merchant_id DESC, amount DESC) AS rn
          FROM txn WHERE transaction_id IS NOT NULL AND amount >= 0) x WHERE rn = 1) d
  LEFT JOIN merchants m ON d.merchant_id = m.merchant_id""",
    "customers": """
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_tier,
         n_name AS city, c_acctbal AS balance, c_acctbal >= 0 AS is_active
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "ev": """
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM events""",
    "daily_gmv": """
  SELECT t.transaction_date, t.merchant_id, m.merchant_name, m.category AS business_category,
         COUNT(t.transaction_id) AS transaction_count,
         SUM(CASE WHEN t.status = 'COMPLETED' THEN t.amount ELSE 0 END) AS gmv,
         SUM(CASE WHEN t.status = 'FAILED' THEN t.amount ELSE 0 END) AS failed_amount,
         COUNT(CASE WHEN t.status = 'FAILED' THEN 1 END) AS failed_count,
         ROUND(COUNT(CASE WHEN t.status = 'FAILED' THEN 1 END) * 100.0 / NULLIF(COUNT(t.transaction_id), 0), 2)
           AS failure_rate_pct
  FROM txn t JOIN merchants m ON t.merchant_id = m.merchant_id
  GROUP BY 1, 2, 3, 4""",
}

# Dependencies between the CTEs above (emitted in this order).
_DEPS = {
    "txn": (),
    "merchant_master": (),
    "merchants": ("merchant_master",),
    "silver": ("txn", "merchants"),
    "customers": (),
    "ev": (),
    "daily_gmv": ("txn", "merchants"),
}


def with_ctes(names: str, body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names.split():
        visit(n)
    parts = [f"{n} AS ({CTES[n]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()

CTES["bronze"] = """
  SELECT t.transaction_id, CAST(t.amount AS VARCHAR) AS amount, t.status, CAST(t.merchant_id AS VARCHAR) AS merchant_id,
         CAST(t.customer_id AS VARCHAR) AS customer_id, CAST(t.transaction_date AS VARCHAR) AS transaction_date,
         t.payment_method, m.merchant_name, m.city
  FROM txn t LEFT JOIN merchants m ON t.merchant_id = m.merchant_id"""
_DEPS["bronze"] = ("txn", "merchants")

CTES["booked"] = """
  SELECT transaction_id || x.suffix AS transaction_id,
         CAST(CASE WHEN day(transaction_date) = 15 THEN amount + 5 ELSE amount END AS DECIMAL(18,2)) AS amount, status, merchant_id, customer_id, transaction_date,
         CASE WHEN payment_method = 'UPI' AND year(transaction_date) >= 1997 THEN 'WALLET' ELSE payment_method END AS payment_method
  FROM silver, (VALUES (''), ('-R')) x(suffix)
  WHERE COALESCE(day(transaction_date) <> 1, TRUE) AND (x.suffix = '' OR day(transaction_date) = 2)"""
_DEPS["booked"] = ("silver",)

CTES["dirty"] = """
  SELECT src_seq, CASE k WHEN 0 THEN '' WHEN 1 THEN NULL ELSE transaction_id END AS transaction_id,
         CASE k WHEN 2 THEN '-' || amount WHEN 3 THEN '0.00' WHEN 4 THEN regexp_replace(CAST(amount AS VARCHAR), '^(\\d+)(\\d{3}\\.)', '\\1,\\2')
                WHEN 5 THEN ' ' WHEN 6 THEN 'n/a' WHEN 7 THEN '99999999.00' ELSE CAST(amount AS VARCHAR) END AS amount,
         CASE k WHEN 11 THEN lower(status) WHEN 12 THEN 'REFUNDED' ELSE status END AS status,
         CASE k WHEN 18 THEN 'TEST_' || merchant_id ELSE CAST(merchant_id AS VARCHAR) END AS merchant_id, CAST(customer_id AS VARCHAR) AS customer_id,
         CASE k WHEN 8 THEN replace(CAST(transaction_date AS VARCHAR), '-', '/') WHEN 9 THEN '99-99-9999' WHEN 10 THEN '2090-05-05'
                ELSE CAST(transaction_date AS VARCHAR) END AS transaction_date,
         payment_method, CASE k WHEN 13 THEN ' ' ELSE merchant_name END AS merchant_name, city,
         CASE k WHEN 14 THEN 'IND' WHEN 15 THEN 'XYZ' WHEN 16 THEN NULL WHEN 17 THEN 'US$' ELSE CASE WHEN customer_id % 5 = 0 THEN 'USD' ELSE 'INR' END END AS currency,
         CASE WHEN customer_id % 2 = 0 THEN 'agreed' END AS note
  FROM (SELECT t.*, m.merchant_name, m.city, (t.src_seq * 31 + t.customer_id * 7 + t.merchant_id) % 400 AS k
        FROM txn t LEFT JOIN merchants m ON t.merchant_id = m.merchant_id) b, (VALUES (1), (2)) x(copy)
  WHERE copy = 1 OR k = 20"""
_DEPS["dirty"] = ("txn", "merchants")
