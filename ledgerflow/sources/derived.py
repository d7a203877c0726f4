"""Derived test inputs built by Spark from the given tables.

Lookup tables that the reference declares as literals (fee rates, channel
costs, SLA thresholds) live here as fixed values; every derived frame is a
function of the given tables so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fee rate per payment method (credit 2 %, debit 1.5 %, UPI 0 %).
FEE_RATES = [("CREDIT_CARD", 0.02), ("DEBIT_CARD", 0.015), ("UPI", 0.0)]

# Fixed values (our fixture): marketing channel per customer market segment,
# and channel costs.
CHANNEL_BY_SEGMENT = {"AUTOMOBILE": "SEARCH", "BUILDING": "EMAIL", "FURNITURE": "SOCIAL",
                      "HOUSEHOLD": "EMAIL", "MACHINERY": "SEARCH"}
CHANNEL_COSTS = [("EMAIL", 10000.0), ("SOCIAL", 25000.0), ("SEARCH", 50000.0)]

# Gateway settlement file rules (our fixture): the gateway missed the 1st of
# every month (settlement outage) and booked 5.00 extra on the 15th.
GATEWAY_MISSING_DAY = 1
GATEWAY_DISPUTED_DAY = 15
GATEWAY_OTHER_DAY = 20

# SLA contract terms for the rolling 4 h window (two contracts):
# tier, GMV-loss threshold, notify within hours, credit % per breach hour,
# breach hours free of credit.
SLA_TIERS = [("CONTRACT_A", 50000.0, 2, 0.5, 4), ("CONTRACT_B", 100000.0, 4, 0.3, 0)]

# Simulated sink outage used by the replay / gap / failure-window queries.
OUTAGE_START = "2024-01-15 10:00:00"
OUTAGE_END = "2024-01-15 14:00:00"


def fee_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FEE_RATES, "payment_method string, fee_rate double")


def channel_costs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHANNEL_COSTS, "channel string, cost double")


def promotions(customers: DataFrame) -> DataFrame:
    """Promotion touch per customer: channel by market segment."""
    ch = F.lit(None).cast("string")
    for seg, channel in CHANNEL_BY_SEGMENT.items():
        ch = F.when(F.col("customer_tier") == seg, F.lit(channel)).otherwise(ch)
    return customers.select("customer_id", ch.alias("channel")).where(F.col("channel").isNotNull())


def gateway_feed(silver: DataFrame) -> DataFrame:
    """Gateway settlement file derived from the ledger: nothing booked on the
    missing day of each month, 5.00 extra on the disputed day, and on the 20th under another gateway."""
    day = F.dayofmonth("transaction_date")
    amt = F.when(day == GATEWAY_DISPUTED_DAY, F.col("amount") + F.lit(5).cast("decimal(18,2)")).otherwise(F.col("amount"))
    return silver.where(day != GATEWAY_MISSING_DAY).select("transaction_id", amt.alias("amount"),
                                                           F.when(day == GATEWAY_OTHER_DAY, "OTHER").otherwise(F.col("payment_method")).alias("gateway"))


def booked_layer(silver: DataFrame) -> DataFrame:
    """What a partner books of Silver, a layer that drifts from it: nothing on the missing day, 5.00 extra on the
    disputed day, UPI as WALLET from 1997 on, and the rows of the 2nd of a month once more under a new id."""
    day, upi = F.dayofmonth("transaction_date"), (F.col("payment_method") == "UPI") & (F.year("transaction_date") >= 1997)
    amt = F.when(day == GATEWAY_DISPUTED_DAY, F.col("amount") + F.lit(5).cast("decimal(18,2)")).otherwise(F.col("amount"))
    booked = (silver.where(F.coalesce(day != GATEWAY_MISSING_DAY, F.lit(True)))
              .withColumn("amount", amt.cast("decimal(18,2)")).withColumn("payment_method", F.when(upi, "WALLET").otherwise(F.col("payment_method"))))
    again = booked.where(day == 2).withColumn("transaction_id", F.concat("transaction_id", F.lit("-R")))
    return booked.unionByName(again)


def sla_contracts(spark: SparkSession, unit: float = 1.0) -> DataFrame:
    """The contract terms, their thresholds times ``unit`` (the events' values are small)."""
    return spark.createDataFrame(
        [(t, limit * unit, *rest) for t, limit, *rest in SLA_TIERS], "sla_tier string, threshold double, notify_hours int, credit_pct_per_hour double, grace_hours int")


def user_tier(col: str = "user_id"):
    return F.when(F.pmod(F.col(col), F.lit(2)) == 0, "CONTRACT_A").otherwise("CONTRACT_B")


def loaded_events(events: DataFrame) -> DataFrame:
    """Sink copy of ``events`` that missed the outage window."""
    return events.where(~((F.col("ts") >= F.to_timestamp(F.lit(OUTAGE_START)))
                          & (F.col("ts") < F.to_timestamp(F.lit(OUTAGE_END)))))


def terminal_ledger(events: DataFrame) -> DataFrame:
    """Events as a ledger of terminals (user and day), amounts in tens; errors come from no terminal."""
    terminal = F.concat_ws("@", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
    return events.select(F.col("event_id").cast("string").alias("transaction_id"), (F.col("value") * 10).cast("decimal(18,2)").alias("amount"),
                         F.when(F.col("event_type") != "error", terminal).alias("merchant_id"))


def contact_tables(customers: DataFrame, merchants: DataFrame) -> dict[str, DataFrame]:
    """Master data with personal values made from the keys: for scans over many tables."""
    digits = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    return {
        "customer_contacts": customers.select(
            F.concat(F.lit("c"), F.col("customer_id").cast("string"), F.lit("@example.com")).alias("mail_to"),
            F.concat(F.lit("9"), digits("customer_id", 9)).alias("reach_at"), F.concat(F.lit("ABCDE"), F.right(digits("customer_id", 8), F.lit(4)), F.lit("F")).alias("tax_id"),
            F.lit("1990-01-01").alias("dobText"), "customer_tier"),
        "merchant_accounts": merchants.select(digits("merchant_id", 11).alias("settle_to"), F.concat(F.lit("10.0.0."), (F.col("merchant_id") % 250).cast("string")).alias("terminal_host"),
                                              "category"),
    }
