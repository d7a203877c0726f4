"""Registered recovery / incident / alarm queries (R2-R8, R10, R13) over events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import recovery as R
from ..operators import rules as RU
from ..operators.asof import asof_join
from ..sources import derived, ledger
from .ledger_queries import silver_df
from .oracle import with_ctes
from .registry import register

OS, OE = derived.OUTAGE_START, derived.OUTAGE_END
SPAN_START, SPAN_END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"

LOADED = f"""
, loaded AS (SELECT * FROM ev WHERE NOT (ts >= TIMESTAMP '{OS}' AND ts < TIMESTAMP '{OE}')),
missing AS (SELECT e.* FROM ev e WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.event_id = e.event_id))"""


def _src_tgt(spark, sf):
    ev = ledger.events(spark, sf)
    return ev, derived.loaded_events(ev)


@register("r2_gap_report", ids=("R2", "J8"), sql=with_ctes("ev", LOADED + """
SELECT e.user_id, COUNT(*) AS expected_rows, COUNT(*) FILTER (WHERE m.event_id IS NULL) AS loaded_rows,
       COUNT(*) FILTER (WHERE m.event_id IS NOT NULL) AS missing_rows,
       ROUND(COALESCE(SUM(CASE WHEN m.event_id IS NOT NULL THEN e.value END), 0.0), 2) AS missing_value
FROM ev e LEFT JOIN missing m ON e.event_id = m.event_id GROUP BY e.user_id"""))
def q_r2(spark, sf):
    s, t = _src_tgt(spark, sf)
    return R.gap_report(s, t, "event_id", "user_id", "value")


@register("r3_sla_breaches", ids=("R3", "J12", "W4"), sql=with_ctes("ev", LOADED + """
, tiers(sla_tier, threshold, notify_hours, credit_pct_per_hour, grace_hours) AS
    (VALUES ('CONTRACT_A', CAST(50000 AS DOUBLE), 2, CAST(0.5 AS DOUBLE), 4), ('CONTRACT_B', CAST(100000 AS DOUBLE), 4, CAST(0.3 AS DOUBLE), 0)),
r AS (SELECT user_id, ts, CASE WHEN user_id % 2 = 0 THEN 'CONTRACT_A' ELSE 'CONTRACT_B' END AS sla_tier,
             SUM(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
                              RANGE BETWEEN 14399999999 PRECEDING AND CURRENT ROW) AS roll FROM missing),
g AS (SELECT r.user_id, r.sla_tier, t.threshold, t.notify_hours, t.credit_pct_per_hour, t.grace_hours,
             ROUND(MAX(roll), 2) AS max_missing_value_4h,
             COUNT(DISTINCT CASE WHEN roll > t.threshold THEN date_trunc('hour', ts) END) AS breach_hours
      FROM r LEFT JOIN tiers t ON r.sla_tier = t.sla_tier GROUP BY 1, 2, 3, 4, 5, 6)
SELECT user_id, sla_tier, threshold, max_missing_value_4h, breach_hours > 0 AS breach, breach_hours,
       CASE WHEN breach_hours > 0 THEN notify_hours END AS notify_within_hours,
       ROUND(GREATEST(breach_hours - grace_hours, 0) * credit_pct_per_hour, 2) AS credit_pct
FROM g"""))
def q_r3(spark, sf):
    s, t = _src_tgt(spark, sf)
    return R.sla_breaches(s, t, "event_id", "user_id", "ts", "value", derived.sla_contracts(spark),
                          derived.user_tier("user_id"))


@register("r4_failure_window", ids=("R4",), sql=with_ctes("ev", LOADED + """
, s AS (SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS n FROM ev GROUP BY 1),
t AS (SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS n FROM loaded GROUP BY 1)
SELECT COALESCE(s.hour, t.hour) AS hour, COALESCE(s.n, 0) AS source_rows, COALESCE(t.n, 0) AS target_rows
FROM s FULL OUTER JOIN t ON s.hour = t.hour WHERE COALESCE(s.n, 0) > 0 AND COALESCE(t.n, 0) = 0"""))
def q_r4(spark, sf):
    s, t = _src_tgt(spark, sf)
    return R.failure_window(s, t, "ts")


@register("r5_divergence_alarm", ids=("R5", "X7"), sql=with_ctes("ev", LOADED + """
, s AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS bucket, COUNT(*) AS source_rows FROM ev GROUP BY 1),
t AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS bucket, COUNT(*) AS target_rows FROM loaded GROUP BY 1)
SELECT s.bucket, s.source_rows, COALESCE(t.target_rows, 0) AS target_rows,
       ROUND((s.source_rows - COALESCE(t.target_rows, 0)) * 100.0 / s.source_rows, 4) AS divergence_pct,
       ROUND((s.source_rows - COALESCE(t.target_rows, 0)) * 100.0 / s.source_rows, 4) > 5.0 AS alarm
FROM s LEFT JOIN t ON s.bucket = t.bucket"""))
def q_r5(spark, sf):
    s, t = _src_tgt(spark, sf)
    return R.divergence_alarm(s, t, "ts")


@register("r6_zero_load_alarm", ids=("R6", "W7"), sql=with_ctes("ev", LOADED + f"""
, spine AS (SELECT UNNEST(generate_series(TIMESTAMP '{SPAN_START}', TIMESTAMP '{SPAN_END}' - INTERVAL 5 MINUTE,
                                           INTERVAL 5 MINUTE)) AS bucket),
c AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, COUNT(*) AS n FROM loaded GROUP BY 1),
j AS (SELECT s.bucket, COALESCE(c.n, 0) AS rows_loaded FROM spine s LEFT JOIN c ON s.bucket = c.bucket)
SELECT bucket, rows_loaded,
       rows_loaded < 1 AND COALESCE(LAG(CASE WHEN rows_loaded < 1 THEN 1 ELSE 0 END) OVER (ORDER BY bucket), 0) = 1
         AS alarm
FROM j"""))
def q_r6(spark, sf):
    _s, t = _src_tgt(spark, sf)
    return R.zero_load_alarm(t, "ts", SPAN_START, SPAN_END)


@register("r7_error_count_alarm", ids=("R7", "X2"), sql=with_ctes("ev", """
SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS bucket, COUNT(*) AS errors, COUNT(*) > 5 AS alarm
FROM ev WHERE event_type = 'error' GROUP BY 1"""))
def q_r7(spark, sf):
    return R.error_count_alarm(ledger.events(spark, sf), "ts")


@register("r8_freshness", ids=("R8",), sql=with_ctes("ev", LOADED + f"""
, spine AS (SELECT UNNEST(generate_series(TIMESTAMP '{SPAN_START}', TIMESTAMP '{SPAN_END}' - INTERVAL 5 MINUTE,
                                           INTERVAL 5 MINUTE)) AS bucket),
c AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, MAX(ts) AS latest FROM loaded GROUP BY 1),
j AS (SELECT s.bucket, MAX(c.latest) OVER (ORDER BY s.bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             AS latest_row_ts FROM spine s LEFT JOIN c ON s.bucket = c.bucket),
f AS (SELECT bucket, latest_row_ts,
             CAST(FLOOR((epoch_us(bucket + INTERVAL 5 MINUTE) - epoch_us(latest_row_ts)) / 1000000) AS BIGINT)
               AS freshness_seconds FROM j)
SELECT *, CASE WHEN freshness_seconds IS NULL THEN 'NO_DATA' WHEN freshness_seconds >= 900 THEN 'CRITICAL'
               WHEN freshness_seconds > 600 THEN 'DELAYED' ELSE 'OK' END AS status FROM f"""))
def q_r8(spark, sf):
    _s, t = _src_tgt(spark, sf)
    return R.freshness(t, "ts", SPAN_START, SPAN_END)


@register("r10_alert_rules", ids=("R10", "E9"), sql=with_ctes("silver", """
SELECT 'CRITICAL' AS severity, 'row_count_out_of_bounds' AS rule_name, CAST(transaction_date AS VARCHAR) AS subject,
       CAST(COUNT(*) AS DOUBLE) AS observed FROM silver GROUP BY transaction_date HAVING COUNT(*) < 17 OR COUNT(*) > 25
UNION ALL
SELECT 'WARNING', 'merchant_failure_rate_spike', CAST(merchant_id AS VARCHAR),
       ROUND(COUNT(*) FILTER (WHERE status = 'FAILED') * 100.0 / COUNT(*), 2) FROM silver GROUP BY merchant_id
HAVING ROUND(COUNT(*) FILTER (WHERE status = 'FAILED') * 100.0 / COUNT(*), 2) > 30.0
UNION ALL
SELECT 'INFO', 'new_payment_method_detected', payment_method, CAST(COUNT(*) AS DOUBLE) FROM silver
WHERE payment_method NOT IN ('UPI', 'CREDIT_CARD') GROUP BY payment_method"""))
def q_r10(spark, sf):
    return R.alert_rules(silver_df(spark, sf), ("UPI", "CREDIT_CARD"), (17, 25))


@register("r13_incident_summary", ids=("R13", "R2", "R3", "R4"), sql=with_ctes("ev", LOADED + """
, g AS (SELECT COUNT(*) AS records_missing, ROUND(COALESCE(SUM(value), 0.0), 2) AS value_missing,
               COUNT(DISTINCT user_id) AS entities_affected FROM missing),
s AS (SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS n FROM ev GROUP BY 1),
t AS (SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS n FROM loaded GROUP BY 1),
w AS (SELECT s.hour FROM s LEFT JOIN t ON s.hour = t.hour WHERE COALESCE(t.n, 0) = 0),
r AS (SELECT user_id, SUM(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
                                       RANGE BETWEEN 14399999999 PRECEDING AND CURRENT ROW) AS roll FROM missing)
SELECT records_missing, value_missing, entities_affected,
       (SELECT MIN(hour) FROM w) AS window_start, (SELECT MAX(hour) + INTERVAL 1 HOUR FROM w) AS window_end,
       (SELECT COUNT(DISTINCT user_id) FROM r WHERE roll > CASE WHEN user_id % 2 = 0 THEN 50000 ELSE 100000 END) AS sla_breaches
FROM g"""))
def q_r13(spark, sf):
    s, t = _src_tgt(spark, sf)
    gap = R.gap_report(s, t, "event_id", "user_id", "value")
    win = R.failure_window(s, t, "ts")
    br = R.sla_breaches(s, t, "event_id", "user_id", "ts", "value", derived.sla_contracts(spark),
                        derived.user_tier("user_id"))
    return R.incident_summary(gap, win, br)


_R6_ALARMS = LOADED + f"""
, spine AS (SELECT UNNEST(generate_series(TIMESTAMP '{SPAN_START}', TIMESTAMP '{SPAN_END}' - INTERVAL 5 MINUTE,
                                           INTERVAL 5 MINUTE)) AS bucket),
c AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, COUNT(*) AS n FROM loaded GROUP BY 1),
j AS (SELECT s.bucket, COALESCE(c.n, 0) AS rows_loaded FROM spine s LEFT JOIN c ON s.bucket = c.bucket),
alarms AS (SELECT bucket, rows_loaded < 1 AND COALESCE(LAG(CASE WHEN rows_loaded < 1 THEN 1 ELSE 0 END)
                  OVER (ORDER BY bucket), 0) = 1 AS alarm FROM j)"""


@register("r11_change_correlation", ids=("R11", "R6"), sql=with_ctes("ev", _R6_ALARMS + f"""
, changes AS (SELECT 'sink_outage' AS change_name, TIMESTAMP '{OS}' AS changed_at)
SELECT c.change_name, c.changed_at, MIN(a.bucket) AS anomaly_start
FROM changes c LEFT JOIN alarms a ON a.alarm AND a.bucket >= c.changed_at GROUP BY 1, 2"""))
def q_r11(spark, sf):
    _s, t = _src_tgt(spark, sf)
    alarms = R.zero_load_alarm(t, "ts", SPAN_START, SPAN_END)
    changes = spark.createDataFrame([("sink_outage",)], "change_name string").select(
        "change_name", F.to_timestamp(F.lit(OS)).alias("changed_at"))
    return R.change_correlation(alarms, changes)


@register("r11_next_alarm_per_error", ids=("R11", "R6"), sql=with_ctes("ev", _R6_ALARMS + """
SELECT e.event_id, e.ts AS changed_at, (SELECT MIN(a.bucket) FROM alarms a WHERE a.alarm AND a.bucket >= e.ts) AS anomaly_start
FROM ev e WHERE e.event_type = 'error'"""))
def q_r11_many(spark, sf):
    s, t = _src_tgt(spark, sf)
    alarms = R.zero_load_alarm(t, "ts", SPAN_START, SPAN_END)
    return R.change_correlation(alarms, s.where("event_type = 'error'").select("event_id", F.col("ts").alias("changed_at")))


@register("w6_last_purchase_before_error", ids=("W6", "R15"), sql=with_ctes("ev", """
, p AS (SELECT *, MAX(CASE WHEN event_type = 'purchase' THEN struct_pack(ts := ts, event_id := event_id, value := value) END)
    OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last FROM ev)
SELECT event_id, user_id, ts, last.event_id AS fix_id, last.ts AS fixed_at, last.value AS fix_value FROM p WHERE event_type = 'error'"""))
def q_w6(spark, sf):
    ev = ledger.events(spark, sf)
    errors = ev.where("event_type = 'error'").select("event_id", "user_id", "ts")
    fixes = ev.where("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    j = asof_join(errors, fixes, "ts", "ts", ["user_id"], out="fix")
    return j.select("event_id", "user_id", "ts", F.col("fix.event_id").alias("fix_id"), F.col("fix.ts").alias("fixed_at"), F.col("fix.value").alias("fix_value"))


# Test-data adapter of the rules' metrics: a user's last event stands for a pipeline's last run, the span of a
# user's events on a day for a run's minutes, an amount of at most 104,800 for a row that passes its checks.
VALID_AMOUNT, KNOWN_METHODS = 104800, ("UPI", "CREDIT_CARD")


def _rule_metrics(spark, sf):
    ev, txn, silver = ledger.events(spark, sf), ledger.transactions(spark, sf), silver_df(spark, sf)
    us = lambda c: F.unix_micros(c)
    fresh = ev.groupBy("user_id").agg(F.max("ts").alias("t"))
    runs = ev.groupBy("user_id", F.to_date("ts").alias("d")).agg((F.floor((us(F.max("ts")) - us(F.min("ts"))) / 1e6) / 60).alias("m"))
    quality = txn.groupBy("status", "payment_method").agg((F.count_if(F.col("amount") <= VALID_AMOUNT) * 100.0 / F.count("*")).alias("q"))
    days = silver.groupBy("transaction_date").agg(F.count("*").alias("n"))
    change = days.withColumn("p", F.lag("n").over(Window.orderBy("transaction_date")))  # one row a day
    merchants = silver.groupBy("merchant_id").agg((F.count_if(F.col("status") == "FAILED") * 100.0 / F.count("*")).alias("f"))
    methods = silver.groupBy("payment_method").agg(F.count_if(~F.col("payment_method").isin(*KNOWN_METHODS)).alias("n"))
    as_of = F.lit(ledger.EVENTS_AS_OF).cast("timestamp")
    parts = [RU.metric(fresh, "freshness_hours", F.col("user_id"), F.round(F.floor((us(as_of) - us(F.col("t"))) / 1e6) / 3600, 4)),
             RU.metric(runs, "runtime_minutes", F.concat_ws("/", "user_id", "d"), F.round("m", 4)),
             RU.metric(quality, "quality_pct", F.concat_ws("/", "status", "payment_method"), F.round("q", 6)),
             RU.metric(days, "daily_row_count", F.col("transaction_date"), F.col("n")),
             RU.metric(change.where("p is not null"), "row_count_change_pct", F.col("transaction_date"), F.round((F.col("n") - F.col("p")) * 100.0 / F.col("p"), 6)),
             RU.metric(merchants, "merchant_failure_pct", F.col("merchant_id"), F.round("f", 6)),
             RU.metric(methods, "unknown_method_rows", F.col("payment_method"), F.col("n"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_RULES_SQL = with_ctes("ev txn silver", f"""
, days AS (SELECT transaction_date, COUNT(*) AS n FROM silver GROUP BY 1),
runs AS (SELECT user_id, CAST(ts AS DATE) AS d, FLOOR((epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1e6) / 60 AS m FROM ev GROUP BY 1, 2),
metrics AS (
  SELECT 'freshness_hours' AS metric, CAST(user_id AS VARCHAR) AS subject, ROUND(FLOOR((epoch_us(TIMESTAMP '{ledger.EVENTS_AS_OF}') - epoch_us(MAX(ts))) / 1e6) / 3600, 4) AS value FROM ev GROUP BY user_id
  UNION ALL SELECT 'runtime_minutes', user_id || '/' || d, ROUND(m, 4) FROM runs
  UNION ALL SELECT 'quality_pct', status || '/' || payment_method, ROUND(COUNT(*) FILTER (amount <= {VALID_AMOUNT}) * 100.0 / COUNT(*), 6) FROM txn GROUP BY status, payment_method
  UNION ALL SELECT 'daily_row_count', CAST(transaction_date AS VARCHAR), n FROM days
  UNION ALL SELECT 'row_count_change_pct', CAST(transaction_date AS VARCHAR), ROUND((n - p) * 100.0 / p, 6) FROM (SELECT *, LAG(n) OVER (ORDER BY transaction_date) AS p FROM days) WHERE p IS NOT NULL
  UNION ALL SELECT 'merchant_failure_pct', CAST(merchant_id AS VARCHAR), ROUND(COUNT(*) FILTER (status = 'FAILED') * 100.0 / COUNT(*), 6) FROM silver GROUP BY merchant_id
  UNION ALL SELECT 'unknown_method_rows', payment_method, COUNT(*) FILTER (payment_method NOT IN ('UPI', 'CREDIT_CARD')) FROM silver GROUP BY payment_method),
rules(kind, severity, rule, metric, operator, lo, hi) AS (VALUES
  ('ALERT', 'CRITICAL', 'data_freshness_breached', 'freshness_hours', 'gt', NULL, 24.0), ('ALERT', 'CRITICAL', 'quality_threshold_breached', 'quality_pct', 'lt', 99.9, NULL),
  ('ALERT', 'CRITICAL', 'row_count_out_of_bounds', 'daily_row_count', 'outside', 17.0, 25.0), ('ALERT', 'WARNING', 'runtime_approaching_limit', 'runtime_minutes', 'band', 108.0, 120.0),
  ('ALERT', 'WARNING', 'quality_slightly_below_threshold', 'quality_pct', 'band', 99.85, 99.9), ('ALERT', 'WARNING', 'merchant_failure_rate_spike', 'merchant_failure_pct', 'gt', NULL, 30.0),
  ('ALERT', 'INFO', 'new_payment_method_detected', 'unknown_method_rows', 'gt', NULL, 0.0), ('ALERT', 'INFO', 'row_count_near_bounds', 'daily_row_count', 'near', 17.0, 25.0),
  ('SLO', 'BREACH', 'data_freshness_slo', 'freshness_hours', 'gt', NULL, 24.0), ('SLO', 'BREACH', 'quality_threshold_slo', 'quality_pct', 'lt', 99.9, NULL),
  ('SLO', 'BREACH', 'row_count_slo', 'row_count_change_pct', 'outside', -20.0, 20.0), ('SLO', 'BREACH', 'pipeline_runtime_slo', 'runtime_minutes', 'gt', NULL, 120.0)),
fired AS (SELECT kind, severity, rule, subject, CAST(value AS DOUBLE) AS value, CASE operator WHEN 'gt' THEN value > hi WHEN 'lt' THEN value < lo WHEN 'outside' THEN value < lo OR value > hi
    WHEN 'band' THEN value >= lo AND value < hi ELSE value BETWEEN lo AND hi AND (value <= lo + 1 OR value >= hi - 1) END AS fired FROM rules JOIN metrics USING (metric))
""")


@register("r10_rule_table", ids=("R10", "R9"), sql=_RULES_SQL + """
SELECT kind, severity, rule, COUNT(subject) AS subjects, COUNT(*) FILTER (fired) AS fired, MIN(ROUND(value, 4)) FILTER (fired) AS least, MAX(ROUND(value, 4)) FILTER (fired) AS greatest
FROM fired GROUP BY 1, 2, 3""")
def q_rule_table(spark, sf):
    return RU.rule_summary(RU.evaluate(_rule_metrics(spark, sf), RU.rule_table(spark)))


@register("r9_slo_breaches", ids=("R9",), sql=_RULES_SQL + "SELECT rule, subject, value FROM fired WHERE kind = 'SLO' AND fired")
def q_slo_breaches(spark, sf):
    return RU.evaluate(_rule_metrics(spark, sf), RU.rule_table(spark).where("kind = 'SLO'")).where("fired").select("rule", "subject", "value")
