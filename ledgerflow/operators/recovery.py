"""Recovery, incident and alarm operators (R1-R15) over source/sink frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .asof import asof_join
from .joins import exclude_loaded
from .windows import consecutive_breach, rolling_sum, time_spine


def _bucket(ts: str, step: str) -> Column:
    return F.window(F.col(ts).cast("timestamp"), step).start


def gap_report(source: DataFrame, target: DataFrame, key: str, by: str, value: str) -> DataFrame:
    """R2: per ``by``: expected rows (source), loaded rows, missing rows and value."""
    there = target.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_there", F.lit(True))
    j = source.join(there, key, "left").withColumn("_missing", F.col("_there").isNull())
    return j.groupBy(by).agg(
        F.count(F.lit(1)).alias("expected_rows"),
        F.count_if(~F.col("_missing")).alias("loaded_rows"),
        F.count_if(F.col("_missing")).alias("missing_rows"),
        F.round(F.coalesce(F.sum(F.when(F.col("_missing"), F.col(value))), F.lit(0.0)), 2).alias("missing_value"))


def sla_breaches(source: DataFrame, target: DataFrame, key: str, by: str, ts: str, value: str,
                 tiers: DataFrame, tier_of: Column, window_hours: int = 4) -> DataFrame:
    """Missing value in any rolling ``window_hours`` window per ``by``
    vs the contract threshold of its tier; breach hours, notify-by, credit %."""
    missing = exclude_loaded(source, target, key).select(by, ts, value)
    roll = rolling_sum(missing, by, ts, value, window_hours * 3600, "_roll")
    per = roll.withColumn("sla_tier", tier_of).join(F.broadcast(tiers), "sla_tier", "left")
    over = F.col("_roll") > F.col("threshold")
    g = per.groupBy(by, "sla_tier", "threshold", "notify_hours", "credit_pct_per_hour", "grace_hours").agg(
        F.round(F.max("_roll"), 2).alias("max_missing_value_4h"),
        F.countDistinct(F.when(over, F.date_trunc("hour", F.col(ts)))).alias("breach_hours"))
    return g.select(by, "sla_tier", "threshold", "max_missing_value_4h",
                    (F.col("breach_hours") > 0).alias("breach"), "breach_hours",
                    F.when(F.col("breach_hours") > 0, F.col("notify_hours")).alias("notify_within_hours"),
                    F.round(F.greatest(F.col("breach_hours") - F.col("grace_hours"), F.lit(0))
                            * F.col("credit_pct_per_hour"), 2).alias("credit_pct"))


def hourly_source_vs_target(source: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """R4 helper: full join of hourly counts of both sides."""
    s = source.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("source_rows"))
    t = target.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("target_rows"))
    j = s.join(t, "hour", "full_outer")
    return j.select("hour", F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
                    F.coalesce("target_rows", F.lit(0)).alias("target_rows"))


def failure_window(source: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Hours where the source had rows and the sink loaded none."""
    h = hourly_source_vs_target(source, target, ts)
    return h.where((F.col("source_rows") > 0) & (F.col("target_rows") == 0))


def divergence_alarm(source: DataFrame, target: DataFrame, ts: str, step: str = "10 minutes",
                     threshold_pct: float = 5.0) -> DataFrame:
    """Per bucket gap % = (source - target) / source * 100; alarm above threshold
    (missing data = not breaching: only buckets with source rows)."""
    s = source.groupBy(_bucket(ts, step).alias("bucket")).agg(F.count(F.lit(1)).alias("source_rows"))
    t = target.groupBy(_bucket(ts, step).alias("bucket")).agg(F.count(F.lit(1)).alias("target_rows"))
    j = s.join(t, "bucket", "left").withColumn("target_rows", F.coalesce("target_rows", F.lit(0)))
    gap = F.round((F.col("source_rows") - F.col("target_rows")) * 100.0 / F.col("source_rows"), 4)
    return j.withColumn("divergence_pct", gap).withColumn("alarm", F.col("divergence_pct") > threshold_pct)


def zero_load_alarm(target: DataFrame, ts: str, start: str, end: str, step: str = "5 minutes",
                    periods: int = 2, threshold: int = 1) -> DataFrame:
    """Rows loaded per bucket over a gap-free spine [start, end); missing
    data counts as a breach; alarm after ``periods`` consecutive breaches."""
    spine = time_spine(target, ts, step, start=F.to_timestamp(F.lit(start)),
                       end=F.to_timestamp(F.lit(end)) - F.expr(f"INTERVAL {step}"))
    c = target.groupBy(_bucket(ts, step).alias("bucket")).agg(F.count(F.lit(1)).alias("rows_loaded"))
    j = spine.join(c, "bucket", "left").withColumn("rows_loaded", F.coalesce("rows_loaded", F.lit(0)))
    return consecutive_breach(j, "bucket", F.col("rows_loaded") < threshold, periods, "alarm")


def error_count_alarm(events: DataFrame, ts: str, type_col: str = "event_type", error_value: str = "error",
                      step: str = "1 minute", threshold: int | Column = 5) -> DataFrame:
    """Error rows per bucket, alarm above threshold (missing = not breaching)."""
    e = events.where(F.col(type_col) == error_value)
    g = e.groupBy(_bucket(ts, step).alias("bucket")).agg(F.count(F.lit(1)).alias("errors"))
    return g.withColumn("alarm", F.col("errors") > threshold)


def freshness(target: DataFrame, ts: str, start: str, end: str, step: str = "5 minutes",
              delayed_s: int = 600, critical_s: int = 900) -> DataFrame:
    """At each bucket end, seconds since the newest loaded row up to then;
    > 600 s DELAYED, >= 900 s CRITICAL (fixed thresholds)."""
    spine = time_spine(target, ts, step, start=F.to_timestamp(F.lit(start)),
                       end=F.to_timestamp(F.lit(end)) - F.expr(f"INTERVAL {step}"))
    c = target.groupBy(_bucket(ts, step).alias("bucket")).agg(F.max(F.col(ts)).alias("_latest"))
    j = spine.join(c, "bucket", "left")
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = j.withColumn("latest_row_ts", F.max("_latest").over(w)).drop("_latest")
    end_ts = F.col("bucket") + F.expr(f"INTERVAL {step}")
    lag_s = F.unix_micros(end_ts) - F.unix_micros(F.col("latest_row_ts"))
    j = j.withColumn("freshness_seconds", F.floor(lag_s / 1_000_000).cast("bigint"))
    status = (F.when(F.col("freshness_seconds").isNull(), "NO_DATA")
              .when(F.col("freshness_seconds") >= critical_s, "CRITICAL")
              .when(F.col("freshness_seconds") > delayed_s, "DELAYED").otherwise("OK"))
    return j.withColumn("status", status)


def alert_rules(silver: DataFrame, known_methods: Sequence[str], daily_bounds: tuple[int, int],
                merchant_failure_pct: float = 30.0) -> DataFrame:
    """Rule table evaluated over the data; one row per fired alert.

    CRITICAL row_count_out_of_bounds (per day), WARNING merchant_failure_rate_spike
    (per merchant), INFO new_payment_method_detected (per unseen method, E9)."""
    lo, hi = daily_bounds
    d = silver.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("v"))
    a1 = d.where((F.col("v") < lo) | (F.col("v") > hi)).select(
        F.lit("CRITICAL").alias("severity"), F.lit("row_count_out_of_bounds").alias("rule_name"),
        F.col("transaction_date").cast("string").alias("subject"), F.col("v").cast("double").alias("observed"))
    m = silver.groupBy("merchant_id").agg(
        F.round(F.count_if(F.col("status") == "FAILED") * 100.0 / F.count(F.lit(1)), 2).alias("v"))
    a2 = m.where(F.col("v") > merchant_failure_pct).select(
        F.lit("WARNING").alias("severity"), F.lit("merchant_failure_rate_spike").alias("rule_name"),
        F.col("merchant_id").cast("string").alias("subject"), F.col("v").cast("double").alias("observed"))
    pm = silver.groupBy("payment_method").agg(F.count(F.lit(1)).alias("v"))
    a3 = pm.where(~F.col("payment_method").isin(*known_methods)).select(
        F.lit("INFO").alias("severity"), F.lit("new_payment_method_detected").alias("rule_name"),
        F.col("payment_method").alias("subject"), F.col("v").cast("double").alias("observed"))
    return a1.unionByName(a2).unionByName(a3)


def change_correlation(alarms: DataFrame, changes: DataFrame, bucket: str = "bucket",
                       change_ts: str = "changed_at") -> DataFrame:
    """For each change event, the first alarming bucket at or after it, whatever the number of changes (an as-of join)."""
    a = alarms.where(F.col("alarm")).select(F.col(bucket).alias("_b"))
    j = asof_join(changes, a, change_ts, "_b", direction="forward", out="_next", block_seconds=86400)
    return j.select(*changes.columns, F.col("_next._b").alias("anomaly_start"))


def error_fingerprints(log: DataFrame, exc_col: str, code_col: str, fix_col: str, ts_col: str, ok_col: str | None = None) -> DataFrame:
    """fingerprint = md5(exception line + code line, paths, line numbers and addresses
    stripped)[:12]; count and latest fix per fingerprint (max_by, skew-safe).

    With ``ok_col`` only fixes that worked count for ``last_fix``.
    Numbers go only where they name a place (line numbers, addresses): the same
    error of two keys stays two errors."""
    path = lambda c: F.regexp_replace(F.col(c), r"(/[^\s:'\"]+)+(:[0-9]+)*", "<path>")
    norm = lambda c: F.regexp_replace(path(c), r"\b(line [0-9]+|0x[0-9a-fA-F]+)", "<at>")
    fp = F.substring(F.md5(F.concat_ws("|", norm(exc_col), norm(code_col))), 1, 12)
    return log.withColumn("fingerprint", fp).groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("occurrences"), F.max(ts_col).alias("last_seen"),
        F.max_by(fix_col, F.when(F.col(ok_col) if ok_col else F.lit(True), F.struct(F.col(ts_col), F.col(fix_col)))).alias("last_fix"))


def incident_summary(gap: DataFrame, window: DataFrame, breaches: DataFrame) -> DataFrame:
    """One summary row (counts, value gap, window, users, breaches)."""
    g = gap.agg(F.sum("missing_rows").alias("records_missing"), F.round(F.sum("missing_value"), 2).alias("value_missing"),
                F.count_if(F.col("missing_rows") > 0).alias("entities_affected"))
    return (g.withColumn("window_start", window.agg(F.min("hour")).scalar())
            .withColumn("window_end", window.agg(F.max("hour") + F.expr("INTERVAL 1 HOUR")).scalar())
            .withColumn("sla_breaches", breaches.agg(F.count_if(F.col("breach"))).scalar()))


# ---------------------------------------------------------------------------
# P11 routing and R1 recovery composition
# ---------------------------------------------------------------------------

def quarantine_reason(id_col: str = "transaction_id", amount_col: str = "amount", date_col: str = "transaction_date") -> Column:
    """First reason a row is not clean (id present, amount > 0, date shaped YYYY-MM-DD), NULL for a clean one."""
    from ..functions.exprs import is_blank
    amt = F.expr(f"try_cast(CAST(`{amount_col}` AS STRING) AS DOUBLE)")
    return (F.when(is_blank(F.col(id_col)), "missing_id")
            .when(F.coalesce(amt <= 0, F.lit(True)), "non_positive_amount")
            .when(~F.coalesce(F.col(date_col).cast("string").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit(False)),
                  "bad_date_format"))


def route_clean_quarantine(df: DataFrame, id_col: str = "transaction_id", amount_col: str = "amount",
                           date_col: str = "transaction_date") -> tuple[DataFrame, DataFrame]:
    """Clean rows, and the others with their ``quarantine_reason``."""
    tagged = df.withColumn("_quarantine_reason", quarantine_reason(id_col, amount_col, date_col))
    return (tagged.where(F.col("_quarantine_reason").isNull()).drop("_quarantine_reason"),
            tagged.where(F.col("_quarantine_reason").isNotNull()))


def recover(spark, source: DataFrame, target_path: str, quarantine_path: str, key: str, run_ts: str,
            source_name: str = "replay") -> dict:
    """Repair (E6) -> exclude loaded (J8) -> split (P11) -> quarantine
    -> insert-only merge (S9) -> verify.  Replaying twice changes nothing."""
    from ..sources.files import path_exists, write_quarantine
    from ..sources.merge import merge_insert_only
    from .schema import repair_record
    repaired = repair_record(source).drop("_fixed_field", "_fixed_date")
    todo = exclude_loaded(repaired, spark.read.parquet(target_path), key) if path_exists(spark, target_path) \
        else repaired
    clean, bad = route_clean_quarantine(todo)
    q_status = write_quarantine(bad, quarantine_path, "recovery_validation", source_name, run_ts)
    stats = merge_insert_only(spark, target_path, clean, key)
    stats["quarantine"] = q_status
    stats["target_rows"] = spark.read.parquet(target_path).count() if path_exists(spark, target_path) else 0
    return stats


def verify_producer(sample: DataFrame, required: list[str], forbidden: list[str]) -> dict:
    """A sample batch must carry the contract fields and none of the bad ones
    (schema metadata plus a non-null share of each required field)."""
    missing = [c for c in required if c not in sample.columns]
    present_bad = [c for c in forbidden if c in sample.columns]
    filled = {}
    if not missing:
        row = sample.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in required]).first()
        filled = {c: row[c] for c in required}
    ok = not missing and not present_bad and all((v or 0) == 1.0 for v in filled.values())
    return {"ok": ok, "missing": missing, "forbidden_present": present_bad, "filled_share": filled}
