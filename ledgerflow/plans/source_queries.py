"""Registered source-side queries: table counts (S14), capped / since / duplicate
lookups (S15), describe (S16), staging projections (P1), code lists (P6),
clean/quarantine routing (P11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import recovery as R
from ..sources import ledger
from ..sources.tables import TABLES, read_table
from .oracle import with_ctes
from .registry import register


@register("s14_table_counts", ids=("S14",), sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES))
def q_s14(spark, sf):
    parts = [read_table(spark, sf, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("s15_row_count_since", ids=("S15",), sql=with_ctes("ev", """
SELECT COUNT(*) AS rows_since, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM ev
WHERE ts >= TIMESTAMP '2024-01-29 00:00:00'"""))
def q_s15_since(spark, sf):
    ev = ledger.events(spark, sf).where(F.col("ts") >= F.to_timestamp(F.lit("2024-01-29 00:00:00")))
    return ev.agg(F.count(F.lit(1)).alias("rows_since"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("s15_duplicate_ids", ids=("S15", "Q9"), sql=with_ctes("txn", """
SELECT transaction_id, COUNT(*) AS copies FROM txn GROUP BY transaction_id HAVING COUNT(*) > 1"""))
def q_s15_dup(spark, sf):
    t = ledger.transactions(spark, sf)
    return t.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


@register("s15_capped_query", ids=("S15", "T2"), sql=with_ctes("ev", """
, top AS (SELECT event_id, ts, event_type FROM ev WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 51)
SELECT event_id, ts, event_type, (SELECT COUNT(*) FROM top) > 50 AS truncated
FROM (SELECT * FROM top ORDER BY ts DESC, event_id DESC LIMIT 50)"""))
def q_s15_cap(spark, sf):
    """Fetch n + 1 rows to know whether the n-row answer was truncated."""
    n = 50
    top = (ledger.events(spark, sf).where(F.col("event_type") == "error")
           .select("event_id", "ts", "event_type").orderBy(F.desc("ts"), F.desc("event_id")).limit(n + 1))
    truncated = top.agg(F.count(F.lit(1)) > n).scalar()
    return top.orderBy(F.desc("ts"), F.desc("event_id")).limit(n).withColumn("truncated", truncated)


@register("p1_stg_events", ids=("P1",), sql=with_ctes("ev", """
SELECT event_id, user_id AS customer_id, lower(event_type) AS event_name, ts AS event_at,
       CAST(value AS DOUBLE) AS event_value, json_extract_string(props, '$.k') AS prop_k,
       TIMESTAMP '2024-01-31 00:00:00' AS _loaded_at
FROM ev WHERE event_id IS NOT NULL"""))
def q_p1(spark, sf):
    ev = ledger.events(spark, sf).where(F.col("event_id").isNotNull())
    return ev.select("event_id", F.col("user_id").alias("customer_id"), F.lower("event_type").alias("event_name"),
                     F.col("ts").alias("event_at"), F.col("value").cast("double").alias("event_value"),
                     F.get_json_object("props", "$.k").alias("prop_k"),
                     F.to_timestamp(F.lit("2024-01-31 00:00:00")).alias("_loaded_at"))


@register("p6_code_lists", ids=("P6", "P3", "P4"), sql=with_ctes("txn", """
SELECT payment_method, status, COUNT(*) AS n FROM txn
WHERE status IN ('COMPLETED', 'FAILED') AND payment_method NOT IN ('UPI') AND amount > 0
GROUP BY 1, 2"""))
def q_p6(spark, sf):
    t = ledger.transactions(spark, sf)
    t = t.where(F.col("status").isin("COMPLETED", "FAILED") & ~F.col("payment_method").isin("UPI")
                & (F.col("amount") > 0))
    return t.groupBy("payment_method", "status").agg(F.count(F.lit(1)).alias("n"))


@register("p11_route_clean_quarantine", ids=("P11",), sql=with_ctes("bronze", """
SELECT CASE WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'missing_id'
            WHEN COALESCE(TRY_CAST(amount AS DOUBLE) <= 0, TRUE) THEN 'non_positive_amount'
            WHEN NOT COALESCE(regexp_matches(transaction_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'), FALSE) THEN 'bad_date_format'
            ELSE 'CLEAN' END AS route, COUNT(*) AS n FROM bronze GROUP BY 1"""))
def q_p11(spark, sf):
    clean, bad = R.route_clean_quarantine(ledger.bronze_enriched(spark, sf))
    c = clean.agg(F.count(F.lit(1)).alias("n")).select(F.lit("CLEAN").alias("route"), "n").where(F.col("n") > 0)
    b = bad.groupBy(F.col("_quarantine_reason").alias("route")).agg(F.count(F.lit(1)).alias("n"))
    return c.unionByName(b)
