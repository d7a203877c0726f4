"""Business marts and reviewed/verified queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_double, avg_cents_half_up, avg_rate, count_when, pct, sum_when
from .windows import with_lag_change

COMPLETED, FAILED = "COMPLETED", "FAILED"


# --- P2 / A4 -----------------------------------------------------------------

def stage_transactions(txn: DataFrame, test_prefix_like: str = "TEST_%", literal: bool = False) -> DataFrame:
    """Lower-case codes, drop test merchants.

    Default keeps the model's LIKE semantics ('_' is a wildcard, so 'TESTX1'
    is dropped too).  ``literal=True`` treats the pattern's text before '%'
    as a plain prefix (the escaped form of the same rule)."""
    mid = F.col("merchant_id").cast("string")
    test = mid.startswith(test_prefix_like.rstrip("%")) if literal else mid.like(test_prefix_like)
    return (txn.withColumn("status", F.lower("status"))
            .withColumn("payment_method", F.lower("payment_method"))
            .where(~F.coalesce(test, F.lit(False))))


def stage_typed(txn: DataFrame, loaded_at: str) -> DataFrame:
    """P2 in full: codes and ids lower-cased, amount DECIMAL(10,2), date DATE (NULL where the text is neither), rows
    without a merchant and test merchants dropped, load time added."""
    lowered = ["transaction_id", "status", "merchant_id", "customer_id", "payment_method"]
    staged = stage_transactions(txn).where(F.col("merchant_id").isNotNull())
    for c in lowered:
        staged = staged.withColumn(c, F.lower(F.col(c).cast("string")))
    return staged.select(
        "transaction_id", F.expr("try_cast(amount AS DECIMAL(10,2))").alias("amount"), "status", "merchant_id", "customer_id",
        F.expr("try_to_date(CAST(transaction_date AS STRING), 'yyyy-MM-dd')").alias("transaction_date"), "payment_method",
        F.to_timestamp(F.lit(loaded_at)).alias("loaded_at"))


def stage(df: DataFrame, columns: dict[str, str], key: str, loaded_at: str) -> DataFrame:
    """Pick and rename columns (new name: source column), drop rows whose ``key`` is NULL, add the load time."""
    return df.where(F.col(key).isNotNull()).select(
        *[F.col(old).alias(new) for new, old in columns.items()], F.to_timestamp(F.lit(loaded_at)).alias("_loaded_at"))


def merchant_kpis(staged: DataFrame, merchants: DataFrame) -> DataFrame:
    """A4: per-merchant KPIs, aggregated before the (inner) join to the dim."""
    agg = staged.groupBy("merchant_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.countDistinct("customer_id").alias("unique_customers"),
        as_double(sum_when(F.col("status") == "completed", "amount")).alias("total_revenue"),
        count_when(F.col("status") == "failed").alias("failed_count"),
        as_double(F.round(F.avg(F.when(F.col("status") == "completed", F.col("amount"))), 2))
        .alias("avg_transaction_value"),
    ).withColumn("failure_rate_pct",
                 F.col("failed_count").cast("double") / F.col("total_transactions") * 100)
    return agg.join(merchants.select("merchant_id", "merchant_name", "category", "city"),
                    "merchant_id", "inner")


# --- A10 / A11 / T1 ------------------------------------------------------------

def top_n(df: DataFrame, metric: str, n: int, tiebreak: Sequence[str]) -> DataFrame:
    """Top-N by metric DESC with an explicit tiebreak (TakeOrderedAndProject)."""
    return df.orderBy(F.desc(metric), *[F.asc(c) for c in tiebreak]).limit(n)


def revenue_by_merchant(silver: DataFrame, after: str) -> DataFrame:
    """A11 corrected: revenue per merchant for dates strictly after ``after``."""
    return (silver.where(F.col("transaction_date") > F.to_date(F.lit(after)))
            .where(F.col("quality_flag") == "CLEAN")
            .groupBy("merchant_id", "merchant_name").agg(
                as_double(F.sum("amount")).alias("total_revenue"),
                F.count(F.lit(1)).alias("txn_count")))


def customer_spend(customers: DataFrame, silver: DataFrame, min_value: float | None) -> DataFrame:
    """Customers LEFT JOIN completed txns, predicate inside the join.

    Zero-order customers keep lifetime_value 0 / total_orders 0.  With
    ``min_value`` the HAVING filter is applied after the aggregate.  The fact
    is pre-aggregated per customer before the join.
    """
    per_cust = (silver.where(F.col("status") == COMPLETED).groupBy("customer_id")
                .agg(F.sum("amount").alias("_v"), F.count(F.lit(1)).alias("_n")))
    j = customers.select("customer_id", "customer_name", "customer_tier").join(per_cust, "customer_id", "left")
    out = j.select("customer_id", "customer_name", "customer_tier",
                   as_double(F.coalesce(F.col("_v"), F.lit(0).cast("decimal(18,2)"))).alias("lifetime_value"),
                   F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("total_orders"))
    if min_value is not None:
        out = out.where(F.col("lifetime_value") > min_value)
    return out


def daily_failure_rate(txn: DataFrame) -> DataFrame:
    """A11 corrected (D15): one-pass conditional aggregate instead of a correlated subquery."""
    return txn.groupBy("transaction_date").agg(
        count_when(F.col("status") == FAILED).alias("failed_count"),
        F.count(F.lit(1)).alias("total_count"),
    ).withColumn("failure_rate", pct("failed_count", "total_count"))


def city_spend(customers: DataFrame, silver: DataFrame, city: str) -> DataFrame:
    """Spend per customer of one city; city is normalised at Silver so the
    predicate compares the raw column (keeps pushdown), COMPLETED only."""
    c = customers.where(F.col("city") == city).select("customer_id", "customer_name")
    s = silver.where(F.col("status") == COMPLETED).select("customer_id", "amount")
    return c.join(s, "customer_id").groupBy("customer_id", "customer_name").agg(
        as_double(F.sum("amount")).alias("total_spent"),
        as_double(F.round(F.avg("amount"), 2)).alias("avg_spent"))


def payment_method_growth(silver: DataFrame, as_of: str) -> DataFrame:
    """Count this month vs last month per method, growth % (NULLIF/COALESCE)."""
    d = F.to_date(F.lit(as_of))
    this_m = F.trunc(d, "MM")
    last_m = F.add_months(this_m, -1)
    m = F.trunc("transaction_date", "MM")
    base = silver.where((F.col("transaction_date") >= F.add_months(this_m, -2))
                        & (F.col("transaction_date") < F.add_months(this_m, 1))
                        & (F.coalesce(F.col("payment_method"), F.lit("")) != "")
                        & (F.coalesce(F.col("amount"), F.lit(0)) != 0))
    g = base.groupBy("payment_method").agg(count_when(m == this_m).alias("this_month"),
                                           count_when(m == last_m).alias("last_month"))
    growth = (F.try_divide(F.col("this_month").cast("double"), F.col("last_month").cast("double")) - 1) * 100
    return g.withColumn("growth_percentage", F.coalesce(F.round(growth, 2), F.lit(0.0)))


def failure_share_top(silver: DataFrame, merchants: DataFrame, start: str, end: str, n: int) -> DataFrame:
    """Merchants with the highest FAILED share among CLEAN rows in [start, end]."""
    s = silver.where((F.col("quality_flag") == "CLEAN")
                     & F.col("transaction_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    g = s.groupBy("merchant_id").agg(count_when(F.col("status") == FAILED).alias("failed_count"),
                                     F.count(F.lit(1)).alias("total_transaction_count"))
    g = g.withColumn("failed_rate", F.round(F.try_divide(F.col("failed_count") * 100.0,
                                                          F.col("total_transaction_count").cast("double")), 4))
    j = g.join(merchants.select("merchant_id", "merchant_name"), "merchant_id")
    return top_n(j, "failed_rate", n, ["merchant_id"])


def hourly_gmv(events: DataFrame, as_of: str, hours: int) -> DataFrame:
    """Per hour count, value sum, first/last row time in the trailing window."""
    end = F.to_timestamp(F.lit(as_of))
    w = events.where((F.col("ts") >= end - F.expr(f"INTERVAL {hours} HOURS")) & (F.col("ts") < end))
    return w.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("value"), 2).alias("gmv"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def hourly_volume_flags(events: DataFrame, spike: int | Column) -> DataFrame:
    """Hourly spine (gap-filled) left join counts; SPIKE above ``spike``, ZERO when empty."""
    from .windows import time_spine
    spine = time_spine(events, "ts", "1 hour", col_name="hour")
    counts = events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("event_count"))
    j = spine.join(counts, "hour", "left").withColumn("event_count", F.coalesce("event_count", F.lit(0)).cast("bigint"))
    flag = F.when(F.col("event_count") > spike, "SPIKE").when(F.col("event_count") == 0, "ZERO").otherwise("OK")
    whole = Window.partitionBy()  # one row an hour: bounded by the calendar
    return j.withColumn("volume_flag", flag).select(
        "hour", "event_count", "volume_flag", F.sum("event_count").over(whole).alias("total_events"),
        F.count_if(F.col("volume_flag") == "SPIKE").over(whole).alias("spike_hours"),
        F.count_if(F.col("volume_flag") == "ZERO").over(whole).alias("zero_hours"))


# --- A16 / B14 / B15 / B16 ----------------------------------------------------

def merchant_risk_score(silver: DataFrame, bronze: DataFrame) -> DataFrame:
    """B14 over U1/A16: silver UNION ALL bronze per merchant, scored for all merchants at once.

    Rules (fixed values): count > 3 -> +40, > 1 -> +20; avg < 200 -> +40,
    < 500 -> +20; any NULL merchant_id in silver -> +20; >= 50 investigate.
    """
    both = (silver.select("merchant_id", "amount", "transaction_id")
            .unionByName(bronze.select("merchant_id", "amount", "transaction_id")))
    per = both.where(F.col("merchant_id").isNotNull()).groupBy("merchant_id").agg(
        F.count("transaction_id").alias("txn_count"),
        as_double(F.round(F.avg("amount"), 2)).alias("avg_amount"))
    # scalar subquery (one value, no join)
    nulls = silver.agg(count_when(F.col("merchant_id").isNull())).scalar()
    j = per.withColumn("null_merchant_rows", nulls)
    score = (F.when(F.col("txn_count") > 3, 40).when(F.col("txn_count") > 1, 20).otherwise(0)
             + F.when(F.col("avg_amount") < 200, 40).when(F.col("avg_amount") < 500, 20).otherwise(0)
             + F.when(F.col("null_merchant_rows") > 0, 20).otherwise(0))
    return (j.withColumn("risk_score", score.cast("int"))
            .withColumn("decision", F.when(F.col("risk_score") >= 50, "INVESTIGATE").otherwise("CLEAR")))


def suspicious_merchants(silver: DataFrame, n: int = 3) -> DataFrame:
    """Among merchants with at least average volume, top-n by |z| of average amount."""
    per = silver.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("txn_count"),
                                            F.avg(as_double("amount")).alias("avg_amount"))
    hv = per.where(F.col("txn_count") >= per.agg(F.avg("txn_count")).scalar())
    spread = hv.agg(F.struct(F.avg("avg_amount").alias("mu"), F.stddev_samp("avg_amount").alias("sd"))).scalar()
    z = hv.withColumn("_spread", spread).withColumn(
        "z_score", F.round(F.try_divide(F.col("avg_amount") - F.col("_spread.mu"), F.col("_spread.sd")), 6)).drop("_spread")
    z = z.withColumn("abs_z", F.abs("z_score")).withColumn("avg_amount", F.round("avg_amount", 2))
    return top_n(z, "abs_z", n, ["merchant_id"]).drop("abs_z")


# --- A20 / A21 / A22 / B4 / B11 / B12 ----------------------------------------------

def worst_merchant(perf: DataFrame) -> DataFrame:
    """Argmax (max_by) of failure rate plus fleet totals in one aggregate."""
    return perf.agg(
        F.max_by("merchant_id", F.struct("failure_rate_pct", F.col("merchant_id"))).alias("worst_merchant_id"),
        F.max("failure_rate_pct").alias("worst_failure_rate_pct"),
        F.sum("txn_count").alias("fleet_txns"),
        F.round(F.sum("total_revenue"), 2).alias("fleet_revenue"))


def daily_revenue(daily: DataFrame) -> DataFrame:
    """A21 + W1 (B4 fct_daily_revenue). Of a date's merchant the first row is counted: one sort of the rows
    instead of a distinct aggregate's two hash maps beside each other in a task."""
    own = Window.partitionBy("transaction_date", "merchant_id").orderBy("merchant_id")
    first = F.col("merchant_id").isNotNull() & (F.row_number().over(own) == 1)
    agg = daily.withColumn("_first", first).groupBy("transaction_date").agg(
        as_double(F.sum("gmv")).alias("total_gmv"),
        F.sum("transaction_count").alias("total_transactions"),
        F.count_if("_first").alias("active_merchants"),
        as_double(F.sum("failed_amount")).alias("total_failed"),
        avg_rate("failure_rate_pct", 2).alias("avg_failure_rate_pct"))
    return with_lag_change(agg, "transaction_date", "total_gmv", "gmv_day_on_day_change", "gmv_growth_pct")


def compliance_daily_summary(silver: DataFrame, report_time: str, review_over: float = 50000.0) -> DataFrame:
    """Per date x method totals over all statuses; rows above the
    threshold require review, and a group that has one is flagged. ``report_time`` is the run's."""
    review = count_when(F.col("amount") > review_over)
    return silver.groupBy("transaction_date", "payment_method").agg(
        F.count(F.lit(1)).alias("txn_count"),
        as_double(F.sum("amount")).alias("total_amount"),
        review.alias("requires_review_count"),
        F.when(review > 0, "REQUIRES_REVIEW").otherwise("CLEAR").alias("compliance_flag"),
        F.lit(report_time).cast("timestamp").alias("report_time"))


def fee_analysis(silver: DataFrame, fees: DataFrame) -> DataFrame:
    """Fee-rate lookup by method (literal table, broadcast), effective revenue."""
    done = silver.where(F.col("status") == COMPLETED)
    per = done.groupBy("payment_method").agg(F.sum("amount").alias("_gross"), F.count(F.lit(1)).alias("txn_count"))
    j = per.join(F.broadcast(fees), "payment_method", "left")
    fee = F.round(F.col("_gross") * F.coalesce(F.col("fee_rate"), F.lit(0.0)).cast("decimal(10,4)"), 2)
    return j.select("payment_method", "txn_count", as_double("_gross").alias("gross_revenue"),
                    as_double(fee).alias("fees"), as_double(F.col("_gross") - fee).alias("effective_revenue"))


# --- B2 / B3 / B7 / B8 / B9 / B10 / B13 ------------------------------------------------

def fct_transactions(txn: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """Multi-way left star join with GMV contribution."""
    c = customers.select("customer_id", "customer_tier")
    m = merchants.select("merchant_id", "merchant_name", F.col("category").alias("business_category"),
                         F.col("city").alias("merchant_city"))
    j = txn.join(c, "customer_id", "left").join(m, "merchant_id", "left")
    return j.select("transaction_id", "transaction_date", "customer_id", "customer_tier", "merchant_id",
                    "merchant_name", "business_category", "merchant_city",
                    as_double("amount").alias("amount"), "payment_method", "status",
                    as_double(F.when(F.col("status") == COMPLETED, F.col("amount"))
                              .otherwise(F.lit(0).cast("decimal(18,2)"))).alias("gmv_contribution"))


def dim_merchants(master: DataFrame, perf30: DataFrame) -> DataFrame:
    """Active merchants left join 30-day performance, defaults for no activity."""
    p = perf30.select("merchant_id", "merchant_tier", "gmv_30d", "avg_failure_rate_pct")
    j = master.where(F.col("is_active")).join(p, "merchant_id", "left")
    return j.select("merchant_id", "merchant_name", "category", "city",
                    F.coalesce("merchant_tier", F.lit("BRONZE")).alias("current_tier"),
                    F.coalesce("gmv_30d", F.lit(0.0)).alias("gmv_30d"),
                    F.coalesce("avg_failure_rate_pct", F.lit(0.0)).alias("failure_rate_30d_pct"))


def churn_risk(silver: DataFrame, as_of: str, at_risk_days: int = 14) -> DataFrame:
    """Recency / frequency / monetary; at_risk when no txn in ``at_risk_days``."""
    d = F.to_date(F.lit(as_of))
    s = silver.where(F.col("transaction_date") <= d)
    g = s.groupBy("customer_id").agg(
        F.max("transaction_date").alias("last_txn_date"), F.count(F.lit(1)).alias("frequency"),
        as_double(sum_when(F.col("status") == COMPLETED, "amount")).alias("monetary"))
    g = g.withColumn("recency_days", F.datediff(d, F.col("last_txn_date")))
    return g.withColumn("at_risk", F.col("recency_days") > at_risk_days)


def merchant_risk_days(daily: DataFrame, threshold_pct: float = 30.0) -> DataFrame:
    """Merchant-days with failure rate above threshold; confidence by sample size
    (our rule: HIGH n >= 20, MEDIUM n >= 5, else LOW)."""
    s = daily.where(F.col("failure_rate_pct") > threshold_pct)
    conf = (F.when(F.col("transaction_count") >= 20, "HIGH")
            .when(F.col("transaction_count") >= 5, "MEDIUM").otherwise("LOW"))
    return s.select("transaction_date", "merchant_id", "transaction_count", "failed_count",
                    "failure_rate_pct", F.lit(True).alias("suspicious"), conf.alias("confidence"))


def marketing_attribution(silver: DataFrame, promotions: DataFrame, channel_costs: DataFrame) -> DataFrame:
    """Join txns to promotions on customer, revenue and ROI per channel."""
    done = silver.where(F.col("status") == COMPLETED).select("customer_id", "amount")
    j = done.join(promotions, "customer_id", "inner")
    per = j.groupBy("channel").agg(F.sum("amount").alias("_rev"),
                                   F.countDistinct("customer_id").alias("customers"))
    per = per.join(F.broadcast(channel_costs), "channel", "left")
    return per.select("channel", "customers", as_double("_rev").alias("revenue"),
                      F.col("cost").cast("double").alias("cost"),
                      F.round(F.try_divide(as_double("_rev") - F.col("cost"), F.col("cost")), 4).alias("roi"))


def customer_segments(silver: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """30-day COMPLETED spend -> VIP > 5000, High 1000-5000, Mid 200-1000, Low < 200;
    a customer without any spent 0."""
    d = F.to_date(F.lit(as_of))
    own = (F.col("status") == COMPLETED) & (F.col("transaction_date") > F.date_sub(d, days)) & (F.col("transaction_date") <= d)
    g = silver.groupBy("customer_id").agg(as_double(sum_when(own, "amount")).alias("spend_30d"), count_when(own).alias("txn_frequency"), d.alias("segment_date"))
    seg = (F.when(F.col("spend_30d") > 5000, "VIP").when(F.col("spend_30d") >= 1000, "High")
           .when(F.col("spend_30d") >= 200, "Mid").otherwise("Low"))
    return g.withColumn("segment", seg)


def reconcile(ledger_df: DataFrame, gateway: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Ledger-side match on id per gateway; matched / disputed / missing
    and net variance per gateway."""
    keys = ["transaction_id", *(["gateway"] if "gateway" in gateway.columns else [])]
    # bookings of one id are summed, so that a double one is disputed and matches once; one without amount makes the sum unknown
    whole = F.count(F.lit(1)) == F.count("amount")
    g = gateway.groupBy(*keys).agg(F.when(whole, F.sum("amount")).alias("gw_amount")).withColumn("_in_gw", F.lit(True))
    j = ledger_df.join(g, keys, "left")
    diff = F.abs(F.col("amount") - F.col("gw_amount"))
    state = (F.when(F.col("_in_gw").isNull(), "MISSING")
             .when(F.coalesce(diff > tolerance, F.lit(True)), "DISPUTED").otherwise("MATCHED"))
    j = j.withColumn("recon_state", state)
    return j.groupBy("gateway").agg(
        count_when(F.col("recon_state") == "MATCHED").alias("matched"),
        count_when(F.col("recon_state") == "DISPUTED").alias("disputed"),
        count_when(F.col("recon_state") == "MISSING").alias("missing"),
        as_double(F.coalesce(F.sum(F.col("gw_amount") - F.col("amount")), F.lit(0))).alias("net_variance"))


# --- A7 / A8 / A17 / Q27 ------------------------------------------------------------

def headcount(people: DataFrame, joined: DataFrame, keys: Sequence[str], as_of: str,
              contract_col: str, contract_value: str) -> DataFrame:
    """Counts, active, contractors and average tenure (days since joining,
    calendar-day DATEDIFF) per key combination."""
    j = people.join(joined, "customer_id", "left")
    tenure = F.datediff(F.to_date(F.lit(as_of)), F.col("joined_on"))
    return j.groupBy(*keys).agg(
        F.count("customer_id").alias("headcount"),
        count_when(F.col("is_active")).alias("active_count"),
        F.round(F.avg(tenure), 6).alias("avg_tenure_days"),
        count_when(F.col(contract_col) == contract_value).alias("contractor_count"))


def user_behaviour(events: DataFrame, cancel_type: str = "error") -> DataFrame:
    """Per user counts, average value, last time, distinct kinds, modal kind
    (ties -> smallest), average hour, cancelled count, value sum."""
    return events.groupBy("user_id").agg(
        F.count("event_id").alias("total_events"),
        avg_cents_half_up("value", 6).alias("avg_value"),
        F.max("ts").alias("last_event_at"),
        F.countDistinct("event_type").alias("unique_event_types"),
        F.mode("event_type", deterministic=True).alias("preferred_event_type"),
        F.round(F.avg(F.hour("ts")), 6).alias("avg_event_hour"),
        count_when(F.col("event_type") == cancel_type).alias("cancelled_events"),
        F.round(F.sum("value"), 2).alias("total_value"))


def null_pct_by_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """COUNT(*) FILTER (WHERE c IS NULL) * 100 / COUNT(*) per column in one
    aggregate, then UNPIVOT to (column_name, null_pct)."""
    row = df.agg(*[F.round(F.count_if(F.col(c).isNull()) * 100.0 / F.count(F.lit(1)), 4).alias(c)
                   for c in columns])
    return row.unpivot([], list(columns), "column_name", "null_pct")


def fix_impact(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """Q27: row counts per ``by`` before and after a fix, and the difference."""
    b = before.groupBy(by).agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.groupBy(by).agg(F.count(F.lit(1)).alias("rows_after"))
    j = b.join(a, by, "full_outer")
    return j.select(by, F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
                    F.coalesce("rows_after", F.lit(0)).alias("rows_after")).withColumn(
        "rows_removed", F.col("rows_before") - F.col("rows_after"))
