"""Gold marts over Silver (A1-A3 and their dbt-style variants A4-A6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_double, avg_rate, count_when, pct, pct_or_zero, sum_when

COMPLETED = "COMPLETED"
FAILED = "FAILED"


def merchant_performance(silver: DataFrame, by_date: bool = True) -> DataFrame:
    """A1: per merchant (and report_date): COMPLETED revenue, txn count, failure %.

    Revenue is 0 (not NULL) for a merchant with no COMPLETED rows; failure %
    is 0 when there are no rows (cannot happen after a group by, kept for
    parity with the reference rule).
    """
    keys = ["merchant_id", "merchant_name", "category", "city"]
    if by_date:
        silver = silver.withColumnRenamed("transaction_date", "report_date")
        keys.append("report_date")
    return silver.groupBy(*keys).agg(
        as_double(sum_when(F.col("status") == COMPLETED, "amount")).alias("total_revenue"),
        F.count(F.lit(1)).alias("txn_count"),
        pct_or_zero(count_when(F.col("status") == FAILED), F.count(F.lit(1))).alias("failure_rate_pct"),
    )


def daily_summary(silver: DataFrame) -> DataFrame:
    """A2: one row per date: revenue, txns, distinct customers/merchants, failure %."""
    return (silver.groupBy(F.col("transaction_date").alias("report_date")).agg(
        as_double(sum_when(F.col("status") == COMPLETED, "amount")).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_txns"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.countDistinct("merchant_id").alias("unique_merchants"),
        pct_or_zero(count_when(F.col("status") == FAILED), F.count(F.lit(1))).alias("failure_rate_pct"),
    ).orderBy("report_date"))


def customer_ltv(silver: DataFrame) -> DataFrame:
    """A3: lifetime value over COMPLETED rows; preferred method = mode, ties -> smallest.

    ``mode`` keeps a value->count map per group whose size is bounded by the
    number of payment methods, and it combines map-side.
    """
    done = silver.where(F.col("status") == COMPLETED)
    return done.groupBy("customer_id").agg(
        as_double(F.sum("amount")).alias("total_spent"),
        F.count(F.lit(1)).alias("total_txns"),
        as_double(F.round(F.avg("amount"), 2)).alias("avg_txn_value"),
        F.min("transaction_date").alias("first_txn_date"),
        F.max("transaction_date").alias("last_txn_date"),
        F.mode("payment_method", deterministic=True).alias("preferred_payment_method"),
    )


def daily_gmv(txn: DataFrame, merchants: DataFrame) -> DataFrame:
    """A5: per date x merchant (inner join to the merchant dim).

    The ledger is summed by date and id before the join, so that no group carries the merchant's texts; a
    merchant row that occurs several times counts as often."""
    m = (merchants.select("merchant_id", "merchant_name", F.col("category").alias("business_category"))
         .groupBy("merchant_id", "merchant_name", "business_category").agg(F.count(F.lit(1)).alias("_copies")))
    n = F.count("transaction_id")
    failed = count_when(F.col("status") == FAILED)
    sums = {"transaction_count": n, "gmv": sum_when(F.col("status") == COMPLETED, "amount"),
            "failed_amount": sum_when(F.col("status") == FAILED, "amount"), "failed_count": failed}
    per = txn.where("merchant_id is not null").groupBy("transaction_date", "merchant_id").agg(
        *[c.alias(name) for name, c in sums.items()], pct(failed, n).alias("failure_rate_pct"))
    many = [F.when(F.col("_copies") == 1, F.col(c)).otherwise((F.col(c) * F.col("_copies")).cast(per.schema[c].dataType)).alias(c) for c in sums]
    return per.join(m, "merchant_id", "inner").select("transaction_date", "merchant_id", "merchant_name", "business_category", *many, "failure_rate_pct")


def merchant_tier(gmv: F.Column) -> F.Column:
    """P10 tier ladder (fixed thresholds from the reference model)."""
    # PLATINUM >= 1,000,000; GOLD >= 500,000; SILVER >= 100,000; else BRONZE.
    return (F.when(gmv >= 1000000, "PLATINUM").when(gmv >= 500000, "GOLD")
            .when(gmv >= 100000, "SILVER").otherwise("BRONZE"))


def merchant_30d(daily: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Trailing window [as_of - days, as_of] over daily_gmv rows."""
    d = F.to_date(F.lit(as_of))
    w = daily.where((F.col("transaction_date") >= F.date_sub(d, days)) & (F.col("transaction_date") <= d))
    gmv = F.sum("gmv")
    return w.groupBy("merchant_id", "merchant_name", "business_category").agg(
        as_double(gmv).alias("gmv_30d"),
        F.sum("transaction_count").alias("transactions_30d"),
        avg_rate("failure_rate_pct", 6).alias("avg_failure_rate_pct"),
        F.max("transaction_date").alias("last_transaction_date"),
        merchant_tier(gmv).alias("merchant_tier"),
    )
