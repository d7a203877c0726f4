"""Registered mart / join / window / top-k queries (A4, A9-A23, W1, W4, T*, U*, B*, J*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import as_double
from ..operators import gold, marts, metrics, windows
from ..operators.silver import keep_latest
from ..sources import derived, ledger
from .ledger_queries import silver_df
from .oracle import with_ctes
from .registry import register

AS_OF = ledger.LEDGER_AS_OF
EV_AS_OF = ledger.EVENTS_AS_OF


def _daily(spark, sf):
    return gold.daily_gmv(ledger.transactions(spark, sf), ledger.merchants(spark, sf))


@register("a4_mart_merchant_kpis", ids=("A4", "P2", "J2"), sql=with_ctes("txn merchants", """
, staged AS (SELECT transaction_id, amount, lower(status) AS status, customer_id, merchant_id FROM txn
             WHERE NOT (CAST(merchant_id AS VARCHAR) LIKE 'TEST_%')),
agg AS (SELECT merchant_id, COUNT(transaction_id) AS total_transactions,
               COUNT(DISTINCT customer_id) AS unique_customers,
               CAST(SUM(CASE WHEN status = 'completed' THEN amount ELSE 0 END) AS DOUBLE) AS total_revenue,
               COUNT(CASE WHEN status = 'failed' THEN 1 END) AS failed_count,
               CAST(ROUND(CAST(AVG(CASE WHEN status = 'completed' THEN amount END) AS DECIMAL(38,6)), 2) AS DOUBLE)
                 AS avg_transaction_value
        FROM staged GROUP BY merchant_id)
SELECT a.merchant_id, total_transactions, unique_customers, total_revenue, failed_count,
       avg_transaction_value, CAST(failed_count AS DOUBLE) / total_transactions * 100 AS failure_rate_pct,
       m.merchant_name, m.category, m.city
FROM agg a JOIN merchants m ON a.merchant_id = m.merchant_id"""))
def q_a4(spark, sf):
    staged = marts.stage_transactions(ledger.transactions(spark, sf))
    return marts.merchant_kpis(staged, ledger.merchants(spark, sf))


@register("a9_metrics_by_method", ids=("A9",), sql=with_ctes("silver", """
SELECT payment_method,
       CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS total_revenue,
       ROUND(100.0 * SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) / COUNT(*), 2) AS failure_rate_pct,
       CAST(SUM(CASE WHEN status = 'COMPLETED' THEN 1 ELSE 0 END) AS BIGINT) AS completed_transaction_count
FROM silver GROUP BY payment_method"""))
def q_a9(spark, sf):
    return metrics.metric(silver_df(spark, sf),
                          ["total_revenue", "failure_rate_pct", "completed_transaction_count"],
                          by=["payment_method"])


@register("a10_transaction_counts", ids=("A10", "S15"), sql=with_ctes("silver", """
SELECT COUNT(*) AS total_transactions, COUNT(*) FILTER (WHERE status = 'FAILED') AS failed_count FROM silver"""))
def q_a10_counts(spark, sf):
    return silver_df(spark, sf).agg(F.count(F.lit(1)).alias("total_transactions"),
                                    F.count_if(F.col("status") == "FAILED").alias("failed_count"))


@register("a10_top_merchant_by_revenue", ids=("A10", "T1"), sql=with_ctes("silver", """
SELECT merchant_name, CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS revenue
FROM silver WHERE quality_flag = 'CLEAN' GROUP BY merchant_name ORDER BY revenue DESC, merchant_name LIMIT 1"""))
def q_a10_top(spark, sf):
    s = silver_df(spark, sf).where(F.col("quality_flag") == "CLEAN")
    g = metrics.metric(s, ["total_revenue"], by=["merchant_name"]).withColumnRenamed("total_revenue", "revenue")
    return marts.top_n(g, "revenue", 1, ["merchant_name"])


@register("a10_failure_rate_by_method", ids=("A10",), sql=with_ctes("silver", """
SELECT payment_method, COUNT(*) AS total, CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       ROUND(100.0 * SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) / COUNT(*), 2) AS failure_rate_pct
FROM silver GROUP BY payment_method ORDER BY failure_rate_pct DESC"""))
def q_a10_fail(spark, sf):
    failed = F.count_if(F.col("status") == "FAILED")
    g = silver_df(spark, sf).groupBy("payment_method").agg(F.count(F.lit(1)).alias("total"), failed.alias("failed"))
    rate = F.round(F.col("failed") * 100.0 / F.col("total"), 2)
    return g.withColumn("failure_rate_pct", rate).orderBy(F.desc("failure_rate_pct"))


@register("a10_merchant_summary", ids=("A10", "J2"), sql=with_ctes("silver", """
SELECT merchant_name, category, COUNT(transaction_id) AS total_txns,
       CAST(SUM(CASE WHEN status = 'COMPLETED' THEN 1 ELSE 0 END) AS BIGINT) AS completed,
       CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       ROUND(100.0 * SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) / COUNT(*), 2) AS failure_rate_pct,
       CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS revenue
FROM silver WHERE quality_flag = 'CLEAN' GROUP BY merchant_name, category ORDER BY revenue DESC"""))
def q_a10_summary(spark, sf):
    s = silver_df(spark, sf).where(F.col("quality_flag") == "CLEAN")
    return (s.groupBy("merchant_name", "category").agg(
        F.count("transaction_id").alias("total_txns"),
        F.count_if(F.col("status") == "COMPLETED").alias("completed"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        metrics.METRICS["failure_rate_pct"]().alias("failure_rate_pct"),
        metrics.METRICS["total_revenue"]().alias("revenue")).orderBy(F.desc("revenue")))


@register("a11_revenue_by_merchant_top10", ids=("A11", "J3", "P5", "T1"), sql=with_ctes("silver", """
SELECT merchant_id, merchant_name, CAST(SUM(amount) AS DOUBLE) AS total_revenue, COUNT(*) AS txn_count
FROM silver WHERE transaction_date > DATE '1998-01-01' AND quality_flag = 'CLEAN'
GROUP BY merchant_id, merchant_name ORDER BY total_revenue DESC, merchant_id LIMIT 10"""))
def q_a11_top10(spark, sf):
    return marts.top_n(marts.revenue_by_merchant(silver_df(spark, sf), "1998-01-01"), "total_revenue", 10,
                       ["merchant_id"])


_SPEND_SQL = """
, per AS (SELECT customer_id, SUM(amount) AS v, COUNT(*) AS n FROM silver WHERE status = 'COMPLETED'
          GROUP BY customer_id)
SELECT c.customer_id, c.customer_name, c.customer_tier,
       CAST(COALESCE(per.v, 0) AS DOUBLE) AS lifetime_value, CAST(COALESCE(per.n, 0) AS BIGINT) AS total_orders
FROM customers c LEFT JOIN per ON c.customer_id = per.customer_id"""


@register("j5_customer_spend_all", ids=("J5",), sql=with_ctes("silver customers", _SPEND_SQL))
def q_j5(spark, sf):
    return marts.customer_spend(ledger.customers(spark, sf), silver_df(spark, sf), None)


@register("a11_customer_spend_over_1000", ids=("A11", "J5"),
          sql=with_ctes("silver customers", _SPEND_SQL + "\nWHERE COALESCE(per.v, 0) > 1000"))
def q_a11_spend(spark, sf):
    return marts.customer_spend(ledger.customers(spark, sf), silver_df(spark, sf), 1000.0)


@register("a11_daily_failure_rate", ids=("A11",), sql=with_ctes("silver", """
SELECT transaction_date, COUNT(*) FILTER (WHERE status = 'FAILED') AS failed_count, COUNT(*) AS total_count,
       ROUND(CAST(COUNT(*) FILTER (WHERE status = 'FAILED') AS DOUBLE) * 100.0 / COUNT(*), 2) AS failure_rate
FROM silver GROUP BY transaction_date"""))
def q_a11_fail(spark, sf):
    return marts.daily_failure_rate(silver_df(spark, sf))


@register("a11_city_spend", ids=("A11", "P9"), sql=with_ctes("silver customers", """
SELECT c.customer_id, c.customer_name, CAST(SUM(s.amount) AS DOUBLE) AS total_spent,
       CAST(ROUND(CAST(AVG(s.amount) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_spent
FROM customers c JOIN silver s ON c.customer_id = s.customer_id
WHERE c.city = 'NATION_7' AND s.status = 'COMPLETED' GROUP BY c.customer_id, c.customer_name"""))
def q_a11_city(spark, sf):
    return marts.city_spend(ledger.customers(spark, sf), silver_df(spark, sf), "NATION_7")


@register("a12_payment_method_growth", ids=("A12",), sql=with_ctes("silver", f"""
, b AS (SELECT payment_method, DATE_TRUNC('month', transaction_date) AS m FROM silver
        WHERE transaction_date >= DATE_TRUNC('month', DATE '{AS_OF}') - INTERVAL 2 MONTH
          AND transaction_date < DATE_TRUNC('month', DATE '{AS_OF}') + INTERVAL 1 MONTH
          AND COALESCE(payment_method, '') <> '' AND COALESCE(amount, 0) <> 0)
SELECT payment_method,
       COUNT(CASE WHEN m = DATE_TRUNC('month', DATE '{AS_OF}') THEN 1 END) AS this_month,
       COUNT(CASE WHEN m = DATE_TRUNC('month', DATE '{AS_OF}') - INTERVAL 1 MONTH THEN 1 END) AS last_month,
       COALESCE(ROUND((CAST(COUNT(CASE WHEN m = DATE_TRUNC('month', DATE '{AS_OF}') THEN 1 END) AS DOUBLE)
          / NULLIF(CAST(COUNT(CASE WHEN m = DATE_TRUNC('month', DATE '{AS_OF}') - INTERVAL 1 MONTH THEN 1 END) AS DOUBLE), 0)
          - 1) * 100, 2), 0.0) AS growth_percentage
FROM b GROUP BY payment_method"""))
def q_a12(spark, sf):
    return marts.payment_method_growth(silver_df(spark, sf), AS_OF)


@register("a13_failure_share_top5", ids=("A13", "T1", "P7"), sql=with_ctes("silver merchants", """
, g AS (SELECT merchant_id, COUNT(CASE WHEN status = 'FAILED' THEN 1 END) AS failed_count,
               COUNT(*) AS total_transaction_count FROM silver
        WHERE quality_flag = 'CLEAN' AND transaction_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
        GROUP BY merchant_id)
SELECT g.merchant_id, failed_count, total_transaction_count,
       ROUND(failed_count * 100.0 / NULLIF(CAST(total_transaction_count AS DOUBLE), 0), 4) AS failed_rate,
       m.merchant_name
FROM g JOIN merchants m ON g.merchant_id = m.merchant_id
ORDER BY failed_rate DESC, g.merchant_id LIMIT 5"""))
def q_a13(spark, sf):
    return marts.failure_share_top(silver_df(spark, sf), ledger.merchants(spark, sf), "1996-01-01",
                                   "1996-12-31", 5)


@register("a14_hourly_gmv_24h", ids=("A14",), sql=with_ctes("ev", f"""
SELECT DATE_TRUNC('hour', ts) AS hour, COUNT(*) AS row_count, ROUND(SUM(value), 2) AS gmv,
       MIN(ts) AS first_ts, MAX(ts) AS last_ts
FROM ev WHERE ts >= TIMESTAMP '{EV_AS_OF} 00:00:00' - INTERVAL 24 HOUR AND ts < TIMESTAMP '{EV_AS_OF} 00:00:00'
GROUP BY 1"""))
def q_a14(spark, sf):
    return marts.hourly_gmv(ledger.events(spark, sf), EV_AS_OF, 24)


@register("a15_hourly_volume_flags", ids=("A15",), sql=with_ctes("ev", """
, spine AS (SELECT UNNEST(generate_series(MIN(DATE_TRUNC('hour', ts)), MAX(DATE_TRUNC('hour', ts)),
                                           INTERVAL 1 HOUR)) AS hour FROM ev),
c AS (SELECT DATE_TRUNC('hour', ts) AS hour, COUNT(*) AS n FROM ev GROUP BY 1),
f AS (SELECT s.hour, CAST(COALESCE(c.n, 0) AS BIGINT) AS event_count,
       CASE WHEN COALESCE(c.n, 0) > 1000 THEN 'SPIKE' WHEN COALESCE(c.n, 0) = 0 THEN 'ZERO' ELSE 'OK' END
         AS volume_flag
FROM spine s LEFT JOIN c ON s.hour = c.hour)
SELECT f.*, (SELECT CAST(SUM(event_count) AS BIGINT) FROM f) AS total_events,
       (SELECT COUNT(*) FROM f WHERE volume_flag = 'SPIKE') AS spike_hours,
       (SELECT COUNT(*) FROM f WHERE volume_flag = 'ZERO') AS zero_hours
FROM f"""))
def q_a15(spark, sf):
    return marts.hourly_volume_flags(ledger.events(spark, sf), 1000)


@register("b14_merchant_risk_score", ids=("B14", "A16", "U1"), sql=with_ctes("silver txn", """
, both_layers AS (SELECT merchant_id, amount, transaction_id FROM silver
                  UNION ALL SELECT merchant_id, amount, transaction_id FROM txn),
per AS (SELECT merchant_id, COUNT(transaction_id) AS txn_count,
               CAST(ROUND(CAST(AVG(amount) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_amount
        FROM both_layers WHERE merchant_id IS NOT NULL GROUP BY merchant_id),
nulls AS (SELECT COUNT(*) FILTER (WHERE merchant_id IS NULL) AS null_merchant_rows FROM silver)
SELECT per.*, nulls.null_merchant_rows,
       CAST((CASE WHEN txn_count > 3 THEN 40 WHEN txn_count > 1 THEN 20 ELSE 0 END)
          + (CASE WHEN avg_amount < 200 THEN 40 WHEN avg_amount < 500 THEN 20 ELSE 0 END)
          + (CASE WHEN null_merchant_rows > 0 THEN 20 ELSE 0 END) AS INTEGER) AS risk_score,
       CASE WHEN (CASE WHEN txn_count > 3 THEN 40 WHEN txn_count > 1 THEN 20 ELSE 0 END)
          + (CASE WHEN avg_amount < 200 THEN 40 WHEN avg_amount < 500 THEN 20 ELSE 0 END)
          + (CASE WHEN null_merchant_rows > 0 THEN 20 ELSE 0 END) >= 50 THEN 'INVESTIGATE' ELSE 'CLEAR' END
         AS decision
FROM per CROSS JOIN nulls"""))
def q_b14(spark, sf):
    return marts.merchant_risk_score(silver_df(spark, sf), ledger.transactions(spark, sf))


@register("b15_suspicious_merchants", ids=("B15", "T1"), sql=with_ctes("silver", """
, per AS (SELECT merchant_id, COUNT(*) AS txn_count, AVG(CAST(amount AS DOUBLE)) AS avg_amount
          FROM silver GROUP BY merchant_id),
hv AS (SELECT * FROM per WHERE txn_count >= (SELECT AVG(txn_count) FROM per)),
z AS (SELECT hv.*, ROUND((avg_amount - (SELECT AVG(avg_amount) FROM hv))
                         / NULLIF((SELECT STDDEV_SAMP(avg_amount) FROM hv), 0), 6) AS z_score FROM hv)
SELECT merchant_id, txn_count, ROUND(avg_amount, 2) AS avg_amount, z_score FROM z
ORDER BY ABS(z_score) DESC, merchant_id LIMIT 3"""))
def q_b15(spark, sf):
    return marts.suspicious_merchants(silver_df(spark, sf), 3)


@register("b16_flag_merchants", ids=("B16", "A1"), sql=with_ctes("silver", """
SELECT merchant_id, COUNT(*) AS txn_count FROM silver GROUP BY merchant_id HAVING COUNT(*) > 500"""))
def q_b16(spark, sf):
    perf = gold.merchant_performance(silver_df(spark, sf), by_date=False)
    return perf.where(F.col("txn_count") > 500).select("merchant_id", "txn_count")


@register("a19_amount_profile", ids=("A19",), sql=with_ctes("silver", """
SELECT COUNT(*) AS row_count, COUNT(DISTINCT amount) AS distinct_amounts,
       CAST(MIN(amount) AS DOUBLE) AS min_amount, CAST(MAX(amount) AS DOUBLE) AS max_amount,
       CAST(ROUND(CAST(AVG(amount) AS DECIMAL(38,6)), 2) AS DOUBLE) AS mean_amount,
       COUNT(DISTINCT status) AS distinct_status FROM silver"""))
def q_a19(spark, sf):
    s = silver_df(spark, sf)
    return s.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("amount").alias("distinct_amounts"),
                 as_double(F.min("amount")).alias("min_amount"), as_double(F.max("amount")).alias("max_amount"),
                 as_double(F.round(F.avg("amount"), 2)).alias("mean_amount"),
                 F.countDistinct("status").alias("distinct_status"))


@register("a19_status_value_counts", ids=("A19",), sql=with_ctes("silver", """
SELECT status, COUNT(*) AS n FROM silver GROUP BY status"""))
def q_a19_vc(spark, sf):
    return silver_df(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("a20_worst_merchant", ids=("A20",), sql=with_ctes("silver", """
, perf AS (SELECT merchant_id, COUNT(*) AS txn_count,
                  CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS total_revenue,
                  COALESCE(ROUND(COUNT(CASE WHEN status = 'FAILED' THEN 1 END) * 100.0 / COUNT(*), 2), 0.0)
                    AS failure_rate_pct
           FROM silver GROUP BY merchant_id)
SELECT (SELECT merchant_id FROM perf ORDER BY failure_rate_pct DESC, merchant_id DESC LIMIT 1) AS worst_merchant_id,
       MAX(failure_rate_pct) AS worst_failure_rate_pct, CAST(SUM(txn_count) AS BIGINT) AS fleet_txns,
       ROUND(SUM(total_revenue), 2) AS fleet_revenue FROM perf"""))
def q_a20(spark, sf):
    perf = silver_df(spark, sf).groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("txn_count"),
        metrics.METRICS["total_revenue"]().alias("total_revenue"),
        F.coalesce(metrics.METRICS["failure_rate_pct"](), F.lit(0.0)).alias("failure_rate_pct"))
    return marts.worst_merchant(perf)


@register("b4_fct_daily_revenue", ids=("B4", "A21", "W1"), sql=with_ctes("daily_gmv", """
, d AS (SELECT transaction_date, CAST(SUM(gmv) AS DOUBLE) AS total_gmv, CAST(SUM(transaction_count) AS BIGINT) AS total_transactions,
               COUNT(DISTINCT merchant_id) AS active_merchants, CAST(SUM(failed_amount) AS DOUBLE) AS total_failed,
               CAST(ROUND(CAST(AVG(CAST(failure_rate_pct AS DECIMAL(12,2))) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_failure_rate_pct
        FROM daily_gmv GROUP BY transaction_date)
SELECT d.*, total_gmv - LAG(total_gmv) OVER (ORDER BY transaction_date) AS gmv_day_on_day_change,
       ROUND((total_gmv - LAG(total_gmv) OVER (ORDER BY transaction_date))
             / NULLIF(LAG(total_gmv) OVER (ORDER BY transaction_date), 0) * 100, 2) AS gmv_growth_pct
FROM d"""))
def q_b4(spark, sf):
    return marts.daily_revenue(_daily(spark, sf))


@register("b11_compliance_daily_summary", ids=("B11", "A22"), sql=with_ctes("silver", """
SELECT transaction_date, payment_method, COUNT(*) AS txn_count, CAST(SUM(amount) AS DOUBLE) AS total_amount,
       COUNT(CASE WHEN amount > 50000 THEN 1 END) AS requires_review_count,
       CASE WHEN COUNT(CASE WHEN amount > 50000 THEN 1 END) > 0 THEN 'REQUIRES_REVIEW' ELSE 'CLEAR' END AS compliance_flag,
       TIMESTAMP '2001-08-01 02:00:00' AS report_time
FROM silver GROUP BY 1, 2"""))
def q_b11(spark, sf):
    return marts.compliance_daily_summary(silver_df(spark, sf), AS_OF + " 02:00:00")


@register("b12_fee_analysis", ids=("B12", "J11"), sql=with_ctes("silver", """
, fees(payment_method, fee_rate) AS (VALUES ('CREDIT_CARD', 0.02), ('DEBIT_CARD', 0.015), ('UPI', 0.0)),
per AS (SELECT payment_method, SUM(amount) AS gross, COUNT(*) AS txn_count FROM silver
        WHERE status = 'COMPLETED' GROUP BY payment_method)
SELECT p.payment_method, txn_count, CAST(gross AS DOUBLE) AS gross_revenue,
       CAST(ROUND(gross * CAST(COALESCE(f.fee_rate, 0) AS DECIMAL(10,4)), 2) AS DOUBLE) AS fees,
       CAST(gross - ROUND(gross * CAST(COALESCE(f.fee_rate, 0) AS DECIMAL(10,4)), 2) AS DOUBLE) AS effective_revenue
FROM per p LEFT JOIN fees f ON p.payment_method = f.payment_method"""))
def q_b12(spark, sf):
    return marts.fee_analysis(silver_df(spark, sf), derived.fee_table(spark))


@register("b2_fct_transactions", ids=("B2", "J4"), sql=with_ctes("txn customers merchants", """
SELECT t.transaction_id, t.transaction_date, t.customer_id, c.customer_tier, t.merchant_id, m.merchant_name,
       m.category AS business_category, m.city AS merchant_city, CAST(t.amount AS DOUBLE) AS amount,
       t.payment_method, t.status,
       CAST(CASE WHEN t.status = 'COMPLETED' THEN t.amount ELSE 0 END AS DOUBLE) AS gmv_contribution
FROM txn t LEFT JOIN customers c ON t.customer_id = c.customer_id
LEFT JOIN merchants m ON t.merchant_id = m.merchant_id"""))
def q_b2(spark, sf):
    return marts.fct_transactions(ledger.transactions(spark, sf), ledger.customers(spark, sf),
                                  ledger.merchants(spark, sf))


@register("b3_dim_merchants", ids=("B3", "A6", "P8"), sql=with_ctes("daily_gmv merchant_master", f"""
, p AS (SELECT merchant_id, CAST(SUM(gmv) AS DOUBLE) AS gmv_30d, CAST(CAST(AVG(CAST(failure_rate_pct AS DECIMAL(12,2))) AS DECIMAL(38,6)) AS DOUBLE) AS avg_failure_rate_pct,
               CASE WHEN SUM(gmv) >= 1000000 THEN 'PLATINUM' WHEN SUM(gmv) >= 500000 THEN 'GOLD'
                    WHEN SUM(gmv) >= 100000 THEN 'SILVER' ELSE 'BRONZE' END AS merchant_tier
        FROM daily_gmv WHERE transaction_date BETWEEN DATE '{AS_OF}' - INTERVAL 30 DAY AND DATE '{AS_OF}'
        GROUP BY merchant_id)
SELECT m.merchant_id, m.merchant_name, m.category, m.city, COALESCE(p.merchant_tier, 'BRONZE') AS current_tier,
       COALESCE(p.gmv_30d, 0.0) AS gmv_30d, COALESCE(p.avg_failure_rate_pct, 0.0) AS failure_rate_30d_pct
FROM merchant_master m LEFT JOIN p ON m.merchant_id = p.merchant_id WHERE m.is_active"""))
def q_b3(spark, sf):
    perf = gold.merchant_30d(_daily(spark, sf), AS_OF)
    return marts.dim_merchants(ledger.merchant_master(spark, sf), perf)


@register("b7_churn_risk", ids=("B7",), sql=with_ctes("silver", f"""
SELECT customer_id, MAX(transaction_date) AS last_txn_date, COUNT(*) AS frequency,
       CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS monetary,
       CAST(DATE '{AS_OF}' - MAX(transaction_date) AS INTEGER) AS recency_days,
       DATE '{AS_OF}' - MAX(transaction_date) > 14 AS at_risk
FROM silver WHERE transaction_date <= DATE '{AS_OF}' GROUP BY customer_id"""))
def q_b7(spark, sf):
    return marts.churn_risk(silver_df(spark, sf), AS_OF)


@register("b8_merchant_risk_days", ids=("B8", "A5"), sql=with_ctes("daily_gmv", """
SELECT transaction_date, merchant_id, transaction_count, failed_count, failure_rate_pct, TRUE AS suspicious,
       CASE WHEN transaction_count >= 20 THEN 'HIGH' WHEN transaction_count >= 5 THEN 'MEDIUM' ELSE 'LOW' END
         AS confidence
FROM daily_gmv WHERE failure_rate_pct > 30"""))
def q_b8(spark, sf):
    return marts.merchant_risk_days(_daily(spark, sf))


@register("b9_marketing_attribution", ids=("B9", "J10"), sql=with_ctes("silver customers", """
, promo AS (SELECT customer_id, CASE customer_tier WHEN 'AUTOMOBILE' THEN 'SEARCH' WHEN 'BUILDING' THEN 'EMAIL'
              WHEN 'FURNITURE' THEN 'SOCIAL' WHEN 'HOUSEHOLD' THEN 'EMAIL' WHEN 'MACHINERY' THEN 'SEARCH' END AS channel
            FROM customers),
costs(channel, cost) AS (VALUES ('EMAIL', 10000.0), ('SOCIAL', 25000.0), ('SEARCH', 50000.0)),
per AS (SELECT p.channel, SUM(s.amount) AS rev, COUNT(DISTINCT s.customer_id) AS customers
        FROM silver s JOIN promo p ON s.customer_id = p.customer_id WHERE s.status = 'COMPLETED'
        GROUP BY p.channel)
SELECT per.channel, customers, CAST(rev AS DOUBLE) AS revenue, CAST(c.cost AS DOUBLE) AS cost,
       ROUND((CAST(rev AS DOUBLE) - c.cost) / NULLIF(c.cost, 0), 4) AS roi
FROM per LEFT JOIN costs c ON per.channel = c.channel"""))
def q_b9(spark, sf):
    promos = derived.promotions(ledger.customers(spark, sf))
    return marts.marketing_attribution(silver_df(spark, sf), promos, derived.channel_costs(spark))


@register("b10_customer_segments", ids=("B10",), sql=with_ctes("silver", f"""
, g AS (SELECT customer_id, CAST(COALESCE(SUM(amount) FILTER (own), 0) AS DOUBLE) AS spend_30d, COUNT(*) FILTER (own) AS txn_frequency
        FROM (SELECT *, status = 'COMPLETED' AND transaction_date > DATE '{AS_OF}' - INTERVAL 30 DAY AND transaction_date <= DATE '{AS_OF}' AS own FROM silver)
        GROUP BY customer_id)
SELECT customer_id, spend_30d, txn_frequency, DATE '{AS_OF}' AS segment_date, CASE WHEN spend_30d > 5000 THEN 'VIP' WHEN spend_30d >= 1000 THEN 'High'
       WHEN spend_30d >= 200 THEN 'Mid' ELSE 'Low' END AS segment FROM g"""))
def q_b10(spark, sf):
    return marts.customer_segments(silver_df(spark, sf), AS_OF)


@register("b13_reconciliation_summary", ids=("B13", "J9"), sql=with_ctes("silver", """
, gw AS (SELECT transaction_id, CASE WHEN dayofmonth(transaction_date) = 20 THEN 'OTHER' ELSE payment_method END AS gateway,
                CASE WHEN dayofmonth(transaction_date) = 15 THEN amount + 5 ELSE amount END AS gw_amount
         FROM silver WHERE dayofmonth(transaction_date) <> 1),
j AS (SELECT s.payment_method AS gateway, s.amount, gw.gw_amount,
             CASE WHEN gw.transaction_id IS NULL THEN 'MISSING'
                  WHEN ABS(s.amount - gw.gw_amount) > 1 THEN 'DISPUTED' ELSE 'MATCHED' END AS st
      FROM silver s LEFT JOIN gw ON s.transaction_id = gw.transaction_id AND s.payment_method = gw.gateway)
SELECT gateway, COUNT(*) FILTER (WHERE st = 'MATCHED') AS matched, COUNT(*) FILTER (WHERE st = 'DISPUTED') AS disputed,
       COUNT(*) FILTER (WHERE st = 'MISSING') AS missing,
       CAST(COALESCE(SUM(gw_amount - amount), 0) AS DOUBLE) AS net_variance
FROM j GROUP BY gateway"""))
def q_b13(spark, sf):
    s = silver_df(spark, sf)
    led = s.select("transaction_id", "amount", F.col("payment_method").alias("gateway"))
    return marts.reconcile(led, derived.gateway_feed(s))


@register("w4_rolling_4h_value", ids=("W4",), sql=with_ctes("ev", """
SELECT event_id, user_id, ts, ROUND(SUM(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
       RANGE BETWEEN 14399999999 PRECEDING AND CURRENT ROW), 2) AS value_4h FROM ev"""))
def q_w4(spark, sf):
    ev = ledger.events(spark, sf).select("event_id", "user_id", "ts", "value")
    out = windows.rolling_sum(ev, "user_id", "ts", "value", 4 * 3600, "value_4h")
    return out.select("event_id", "user_id", "ts", F.round("value_4h", 2).alias("value_4h"))


@register("t2_latest_events", ids=("T2", "T5"), sql=with_ctes("ev", """
SELECT event_id, ts, user_id, event_type FROM ev ORDER BY ts DESC, event_id DESC LIMIT 10"""))
def q_t2(spark, sf):
    ev = ledger.events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return ev.orderBy(F.desc("ts"), F.desc("event_id")).limit(10)


@register("t4_top5_values_per_column", ids=("T4",), sql=with_ctes("silver", """
, long AS (SELECT 'status' AS column_name, status AS value FROM silver
           UNION ALL SELECT 'payment_method', payment_method FROM silver
           UNION ALL SELECT 'city', city FROM silver
           UNION ALL SELECT 'merchant_name', merchant_name FROM silver
           UNION ALL SELECT 'customer_id', CAST(customer_id AS VARCHAR) FROM silver),
c AS (SELECT column_name, value, COUNT(*) AS value_count FROM long WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY value_count DESC, value) AS INTEGER) AS value_rank
               FROM c) WHERE value_rank <= 5"""))
def q_t4(spark, sf):
    return windows.top_values_per_column(silver_df(spark, sf),
                                         ["status", "payment_method", "city", "merchant_name", "customer_id"], 5)


@register("u4_status_set_equality", ids=("U4", "U1"), sql=with_ctes("txn silver", """
, a AS (SELECT DISTINCT status AS value FROM txn), b AS (SELECT DISTINCT status AS value FROM silver)
SELECT COALESCE(a.value, b.value) AS value, a.value IS NOT NULL AS in_bronze, b.value IS NOT NULL AS in_silver
FROM a FULL OUTER JOIN b ON a.value = b.value"""))
def q_u4(spark, sf):
    from ..operators.joins import distinct_set_compare
    return distinct_set_compare(ledger.transactions(spark, sf), silver_df(spark, sf), "status",
                                "in_bronze", "in_silver")


@register("j6_orphan_merchants", ids=("J6",), sql=with_ctes("txn merchants", """
SELECT t.merchant_id, COUNT(*) AS txn_count FROM txn t
WHERE NOT EXISTS (SELECT 1 FROM merchants m WHERE m.merchant_id = t.merchant_id) GROUP BY t.merchant_id"""))
def q_j6(spark, sf):
    from ..operators.joins import orphans
    return orphans(ledger.transactions(spark, sf), ledger.merchants(spark, sf), "merchant_id").groupBy(
        "merchant_id").agg(F.count(F.lit(1)).alias("txn_count"))


@register("j7_latest_order_per_customer", ids=("J7",), sql=with_ctes("customers", """
, o AS (SELECT o_custkey AS customer_id, o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
               o_totalprice FROM orders),
latest AS (SELECT * FROM (SELECT *, RANK() OVER (PARTITION BY customer_id ORDER BY order_date DESC) AS r FROM o)
           WHERE r = 1)
SELECT c.customer_id, c.customer_name, l.o_orderkey, l.order_date, l.o_totalprice
FROM customers c LEFT JOIN latest l ON c.customer_id = l.customer_id"""))
def q_j7(spark, sf):
    from ..operators.joins import join_latest
    from ..sources.tables import read_table
    o = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"), "o_orderkey",
        F.to_date("o_orderdate").alias("order_date"), "o_totalprice")
    c = ledger.customers(spark, sf).select("customer_id", "customer_name")
    return join_latest(c, o, "customer_id", "order_date")


@register("j8_replay_candidates", ids=("J8", "R2"), sql=with_ctes("ev", f"""
, loaded AS (SELECT * FROM ev WHERE NOT (ts >= TIMESTAMP '{derived.OUTAGE_START}' AND ts < TIMESTAMP '{derived.OUTAGE_END}'))
SELECT e.event_id, e.ts, e.user_id, e.value FROM ev e
WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.event_id = e.event_id)"""))
def q_j8(spark, sf):
    from ..operators.joins import exclude_loaded
    ev = ledger.events(spark, sf)
    return exclude_loaded(ev, derived.loaded_events(ev), "event_id").select("event_id", "ts", "user_id", "value")


@register("a23_distribution_compare", ids=("A23", "Q26"), sql=with_ctes("booked", """
, a AS (SELECT * FROM silver), b AS (SELECT * FROM booked),
sa AS (SELECT 'status' AS column_name, COUNT(DISTINCT status) AS distinct_a,
              ROUND(AVG(CASE WHEN status IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate_a FROM a
       UNION ALL SELECT 'payment_method', COUNT(DISTINCT payment_method),
              ROUND(AVG(CASE WHEN payment_method IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM a
       UNION ALL SELECT 'amount', COUNT(DISTINCT amount), ROUND(AVG(CASE WHEN amount IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM a),
sb AS (SELECT 'status' AS column_name, COUNT(DISTINCT status) AS distinct_b,
              ROUND(AVG(CASE WHEN status IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate_b FROM b
       UNION ALL SELECT 'payment_method', COUNT(DISTINCT payment_method),
              ROUND(AVG(CASE WHEN payment_method IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM b
       UNION ALL SELECT 'amount', COUNT(DISTINCT amount), ROUND(AVG(CASE WHEN amount IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM b)
SELECT sa.column_name, distinct_a, distinct_b, null_rate_a, null_rate_b,
       CASE WHEN sa.column_name = 'amount' THEN (SELECT CAST(ROUND(CAST(AVG(amount) AS DECIMAL(38,6)), 2) AS DOUBLE) FROM a) END AS mean_a,
       CASE WHEN sa.column_name = 'amount' THEN (SELECT CAST(ROUND(CAST(AVG(amount) AS DECIMAL(38,6)), 2) AS DOUBLE) FROM b) END AS mean_b
FROM sa JOIN sb ON sa.column_name = sb.column_name"""))
def q_a23(spark, sf):
    from ..operators.quality import distribution_compare
    silver = silver_df(spark, sf)
    return distribution_compare(silver, derived.booked_layer(silver), ["status", "payment_method", "amount"], numeric=["amount"])


@register("w2_latest_order_per_customer", ids=("W2", "W6"), sql=with_ctes("customers", """
, o AS (SELECT o_custkey AS customer_id, o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders)
SELECT customer_id, o_orderkey, order_date FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date DESC, o_orderkey DESC) AS rn FROM o)
WHERE rn = 1"""))
def q_keep_latest_orders(spark, sf):
    from ..sources.tables import read_table
    o = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id"), "o_orderkey",
                                               F.to_date("o_orderdate").alias("order_date"))
    return keep_latest(o, "customer_id", ["order_date", "o_orderkey"])


@register("a7_headcount", ids=("A7",), sql=with_ctes("customers", f"""
, j AS (SELECT o_custkey AS customer_id, MIN(CAST(o_orderdate AS DATE)) AS joined_on FROM orders GROUP BY 1)
SELECT c.city, c.customer_tier, COUNT(c.customer_id) AS headcount,
       COUNT(CASE WHEN c.is_active THEN 1 END) AS active_count,
       ROUND(AVG(DATE '{AS_OF}' - j.joined_on), 6) AS avg_tenure_days,
       COUNT(CASE WHEN c.customer_tier = 'BUILDING' THEN 1 END) AS contractor_count
FROM customers c LEFT JOIN j ON c.customer_id = j.customer_id GROUP BY 1, 2"""))
def q_a7(spark, sf):
    from ..sources.tables import read_table
    first = read_table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min(F.to_date("o_orderdate")).alias("joined_on"))
    return marts.headcount(ledger.customers(spark, sf), first, ["city", "customer_tier"], AS_OF,
                           "customer_tier", "BUILDING")


@register("a8_user_behaviour", ids=("A8",), sql=with_ctes("ev", """
, m AS (SELECT user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, event_type) AS r
        FROM ev GROUP BY 1, 2)
SELECT e.user_id, COUNT(e.event_id) AS total_events,
       FLOOR((SUM(CAST(ROUND(e.value * 100) AS BIGINT)) * 20000 + COUNT(e.value)) / (COUNT(e.value) * 2)) / 1000000.0
         AS avg_value, MAX(e.ts) AS last_event_at,
       COUNT(DISTINCT e.event_type) AS unique_event_types, MIN(m.event_type) AS preferred_event_type,
       ROUND(AVG(EXTRACT(HOUR FROM e.ts)), 6) AS avg_event_hour,
       COUNT(CASE WHEN e.event_type = 'error' THEN 1 END) AS cancelled_events, ROUND(SUM(e.value), 2) AS total_value
FROM ev e JOIN m ON e.user_id = m.user_id AND m.r = 1 GROUP BY e.user_id"""))
def q_a8(spark, sf):
    return marts.user_behaviour(ledger.events(spark, sf))


@register("a17_null_pct_unpivot", ids=("A17",), sql=with_ctes("txn customers merchants", """
, f AS (SELECT t.transaction_id, t.amount, m.merchant_name, c.customer_tier, m.city AS merchant_city
        FROM txn t LEFT JOIN customers c ON t.customer_id = c.customer_id
        LEFT JOIN merchants m ON t.merchant_id = m.merchant_id),
r AS (SELECT ROUND(COUNT(*) FILTER (WHERE transaction_id IS NULL) * 100.0 / COUNT(*), 4) AS transaction_id,
             ROUND(COUNT(*) FILTER (WHERE amount IS NULL) * 100.0 / COUNT(*), 4) AS amount,
             ROUND(COUNT(*) FILTER (WHERE merchant_name IS NULL) * 100.0 / COUNT(*), 4) AS merchant_name,
             ROUND(COUNT(*) FILTER (WHERE customer_tier IS NULL) * 100.0 / COUNT(*), 4) AS customer_tier,
             ROUND(COUNT(*) FILTER (WHERE merchant_city IS NULL) * 100.0 / COUNT(*), 4) AS merchant_city FROM f)
SELECT column_name, null_pct FROM (UNPIVOT r ON transaction_id, amount, merchant_name, customer_tier, merchant_city
                                   INTO NAME column_name VALUE null_pct)"""))
def q_a17(spark, sf):
    fct = marts.fct_transactions(ledger.transactions(spark, sf), ledger.customers(spark, sf),
                                 ledger.merchants(spark, sf))
    return marts.null_pct_by_column(fct, ["transaction_id", "amount", "merchant_name", "customer_tier",
                                          "merchant_city"])


@register("q27_dedup_fix_impact", ids=("Q27",), sql=with_ctes("txn silver", """
, b AS (SELECT status, COUNT(*) AS n FROM txn GROUP BY 1), a AS (SELECT status, COUNT(*) AS n FROM silver GROUP BY 1)
SELECT COALESCE(b.status, a.status) AS status, COALESCE(b.n, 0) AS rows_before, COALESCE(a.n, 0) AS rows_after,
       COALESCE(b.n, 0) - COALESCE(a.n, 0) AS rows_removed FROM b FULL OUTER JOIN a ON b.status = a.status"""))
def q_q27(spark, sf):
    return marts.fix_impact(ledger.transactions(spark, sf), silver_df(spark, sf), "status")
