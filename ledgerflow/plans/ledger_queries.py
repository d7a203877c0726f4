"""Registered ledger queries: Silver (B1/W2/J1/P3) and the Gold marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold, silver
from ..sources import ledger
from .oracle import with_ctes
from .registry import register

AS_OF = ledger.LEDGER_AS_OF


def silver_df(spark, sf):
    return silver.build_silver(ledger.transactions(spark, sf), ledger.merchants(spark, sf))


@register("b1_silver_transactions", ids=("B1", "P3", "W2", "J1"), sql=with_ctes("silver", """
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, status, merchant_id, customer_id,
       transaction_date, payment_method, merchant_name, category, city, quality_flag
FROM silver"""))
def q_silver(spark, sf):
    return silver_df(spark, sf).withColumn("amount", F.col("amount").cast("double"))


@register("b1_silver_flag_counts", ids=("B1", "J1", "S17"), sql=with_ctes("silver", """
SELECT quality_flag, COUNT(*) AS row_count, CAST(SUM(amount) AS DOUBLE) AS total_amount
FROM silver GROUP BY quality_flag"""))
def q_silver_flags(spark, sf):
    return silver_df(spark, sf).groupBy("quality_flag").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").cast("double").alias("total_amount"))


@register("a1_merchant_performance", ids=("A1",), headline=True, sql=with_ctes("silver", """
SELECT merchant_id, merchant_name, category, city, transaction_date AS report_date,
       CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS total_revenue,
       COUNT(*) AS txn_count,
       COALESCE(ROUND(COUNT(CASE WHEN status = 'FAILED' THEN 1 END) * 100.0 / NULLIF(COUNT(*), 0), 2), 0.0)
         AS failure_rate_pct
FROM silver GROUP BY 1, 2, 3, 4, 5"""))
def q_a1(spark, sf):
    return gold.merchant_performance(silver_df(spark, sf), by_date=True)


@register("a1_merchant_performance_total", ids=("A1", "B16"), sql=with_ctes("silver", """
SELECT merchant_id, merchant_name, category, city,
       CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS total_revenue,
       COUNT(*) AS txn_count,
       COALESCE(ROUND(COUNT(CASE WHEN status = 'FAILED' THEN 1 END) * 100.0 / NULLIF(COUNT(*), 0), 2), 0.0)
         AS failure_rate_pct
FROM silver GROUP BY 1, 2, 3, 4"""))
def q_a1_total(spark, sf):
    return gold.merchant_performance(silver_df(spark, sf), by_date=False)


@register("a2_daily_summary", ids=("A2",), headline=True, sql=with_ctes("silver", """
SELECT transaction_date AS report_date,
       CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS total_revenue,
       COUNT(*) AS total_txns,
       COUNT(DISTINCT customer_id) AS unique_customers,
       COUNT(DISTINCT merchant_id) AS unique_merchants,
       COALESCE(ROUND(COUNT(CASE WHEN status = 'FAILED' THEN 1 END) * 100.0 / NULLIF(COUNT(*), 0), 2), 0.0)
         AS failure_rate_pct
FROM silver GROUP BY 1 ORDER BY 1"""))
def q_a2(spark, sf):
    return gold.daily_summary(silver_df(spark, sf))


@register("a3_customer_ltv", ids=("A3",), headline=True, sql=with_ctes("silver", """
, done AS (SELECT * FROM silver WHERE status = 'COMPLETED'),
pm AS (SELECT customer_id, payment_method,
              ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY COUNT(*) DESC, payment_method ASC) AS r
       FROM done GROUP BY customer_id, payment_method)
SELECT d.customer_id, CAST(SUM(amount) AS DOUBLE) AS total_spent, COUNT(*) AS total_txns,
       CAST(ROUND(CAST(AVG(amount) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_txn_value,
       MIN(transaction_date) AS first_txn_date, MAX(transaction_date) AS last_txn_date,
       MIN(pm.payment_method) AS preferred_payment_method
FROM done d JOIN pm ON d.customer_id = pm.customer_id AND pm.r = 1
GROUP BY d.customer_id"""))
def q_a3(spark, sf):
    return gold.customer_ltv(silver_df(spark, sf))


@register("a5_daily_gmv", ids=("A5", "J2"), sql=with_ctes("daily_gmv", """
SELECT transaction_date, merchant_id, merchant_name, business_category, transaction_count,
       CAST(gmv AS DOUBLE) AS gmv, CAST(failed_amount AS DOUBLE) AS failed_amount, failed_count,
       failure_rate_pct
FROM daily_gmv"""))
def q_a5(spark, sf):
    d = gold.daily_gmv(ledger.transactions(spark, sf), ledger.merchants(spark, sf))
    return d.withColumn("gmv", F.col("gmv").cast("double")).withColumn(
        "failed_amount", F.col("failed_amount").cast("double"))


@register("a6_merchant_30d", ids=("A6", "W5", "P7", "P10"), sql=with_ctes("daily_gmv", f"""
SELECT merchant_id, merchant_name, business_category,
       CAST(SUM(gmv) AS DOUBLE) AS gmv_30d,
       CAST(SUM(transaction_count) AS BIGINT) AS transactions_30d,
       CAST(CAST(AVG(CAST(failure_rate_pct AS DECIMAL(12,2))) AS DECIMAL(38,6)) AS DOUBLE) AS avg_failure_rate_pct,
       MAX(transaction_date) AS last_transaction_date,
       CASE WHEN SUM(gmv) >= 1000000 THEN 'PLATINUM' WHEN SUM(gmv) >= 500000 THEN 'GOLD'
            WHEN SUM(gmv) >= 100000 THEN 'SILVER' ELSE 'BRONZE' END AS merchant_tier
FROM daily_gmv
WHERE transaction_date BETWEEN DATE '{AS_OF}' - INTERVAL 30 DAY AND DATE '{AS_OF}'
GROUP BY 1, 2, 3"""))
def q_a6(spark, sf):
    daily = gold.daily_gmv(ledger.transactions(spark, sf), ledger.merchants(spark, sf))
    return gold.merchant_30d(daily, AS_OF)
