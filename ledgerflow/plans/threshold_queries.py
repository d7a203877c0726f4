"""Alarms, scores and scans whose thresholds lie within the range of the given tables, so that both sides of each occur."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.patterns import PII_PATTERNS
from ..operators import governance as G
from ..operators import marts as M
from ..operators import recovery as R
from ..operators.joins import distinct_set_compare
from ..sources import derived, ledger
from .ledger_queries import silver_df
from .oracle import with_ctes
from .recovery_queries import LOADED, _src_tgt
from .registry import register

SLA_UNIT = 0.001       # thresholds 50 and 100


@register("a15_hourly_volume_after_outage", ids=("A15", "X2"), sql=with_ctes("ev", LOADED + """
, spine AS (SELECT UNNEST(generate_series(MIN(DATE_TRUNC('hour', ts)), MAX(DATE_TRUNC('hour', ts)), INTERVAL 1 HOUR)) AS hour FROM loaded),
c AS (SELECT DATE_TRUNC('hour', ts) AS hour, COUNT(*) AS n FROM loaded GROUP BY 1),
f AS (SELECT s.hour, CAST(COALESCE(c.n, 0) AS BIGINT) AS event_count,
        CASE WHEN COALESCE(c.n, 0) > (SELECT AVG(n) * 1.25 FROM c) THEN 'SPIKE' WHEN COALESCE(c.n, 0) = 0 THEN 'ZERO' ELSE 'OK' END AS volume_flag
      FROM spine s LEFT JOIN c ON s.hour = c.hour)
SELECT f.*, (SELECT CAST(SUM(event_count) AS BIGINT) FROM f) AS total_events, (SELECT COUNT(*) FROM f WHERE volume_flag = 'SPIKE') AS spike_hours,
       (SELECT COUNT(*) FROM f WHERE volume_flag = 'ZERO') AS zero_hours FROM f"""))
def q_volume(spark, sf):
    _s, loaded = _src_tgt(spark, sf)
    per_hour = loaded.groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return M.hourly_volume_flags(loaded, per_hour.agg(F.avg("n") * 1.25).scalar())


@register("r7_error_alarm_above_mean", ids=("R7",), sql=with_ctes("ev", """
, e AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket, COUNT(*) AS errors FROM ev WHERE event_type = 'error' GROUP BY 1)
SELECT bucket, errors, errors > (SELECT AVG(errors) FROM e) AS alarm FROM e"""))
def q_errors(spark, sf):
    ev = ledger.events(spark, sf)
    hourly = ev.where(F.col("event_type") == "error").groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return R.error_count_alarm(ev, "ts", step="1 hour", threshold=hourly.agg(F.avg("n")).scalar())


_BREACHES = """
, tiers(sla_tier, threshold, notify_hours, credit_pct_per_hour, grace_hours) AS
    (VALUES ('CONTRACT_A', CAST(50 AS DOUBLE), 2, CAST(0.5 AS DOUBLE), 4), ('CONTRACT_B', CAST(100 AS DOUBLE), 4, CAST(0.3 AS DOUBLE), 0)),
r AS (SELECT user_id, ts, CASE WHEN user_id % 2 = 0 THEN 'CONTRACT_A' ELSE 'CONTRACT_B' END AS sla_tier,
             SUM(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 14399999999 PRECEDING AND CURRENT ROW) AS roll FROM missing),
g AS (SELECT r.user_id, r.sla_tier, t.threshold, t.notify_hours, t.credit_pct_per_hour, t.grace_hours, ROUND(MAX(roll), 2) AS max_missing_value_4h,
             COUNT(DISTINCT CASE WHEN roll > t.threshold THEN date_trunc('hour', ts) END) AS breach_hours
      FROM r LEFT JOIN tiers t ON r.sla_tier = t.sla_tier GROUP BY 1, 2, 3, 4, 5, 6)"""


def _breaches(spark, source, target):
    return R.sla_breaches(source, target, "event_id", "user_id", "ts", "value", derived.sla_contracts(spark, SLA_UNIT),
                          derived.user_tier("user_id"))


@register("r3_sla_breaches_small_limits", ids=("R3", "J12", "W4"), sql=with_ctes("ev", LOADED + _BREACHES + """
SELECT user_id, sla_tier, threshold, max_missing_value_4h, breach_hours > 0 AS breach, breach_hours, CASE WHEN breach_hours > 0 THEN notify_hours END AS notify_within_hours,
       ROUND(GREATEST(breach_hours - grace_hours, 0) * credit_pct_per_hour, 2) AS credit_pct FROM g"""))
def q_breaches(spark, sf):
    return _breaches(spark, *_src_tgt(spark, sf))


@register("r13_incident_with_breaches", ids=("R13", "R3", "R4"), sql=with_ctes("ev", LOADED + _BREACHES + """
, s AS (SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS n FROM ev GROUP BY 1),
t AS (SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS n FROM loaded GROUP BY 1),
w AS (SELECT s.hour FROM s LEFT JOIN t ON s.hour = t.hour WHERE COALESCE(t.n, 0) = 0)
SELECT (SELECT COUNT(*) FROM missing) AS records_missing, (SELECT ROUND(COALESCE(SUM(value), 0.0), 2) FROM missing) AS value_missing,
       (SELECT COUNT(DISTINCT user_id) FROM missing) AS entities_affected, (SELECT MIN(hour) FROM w) AS window_start,
       (SELECT MAX(hour) + INTERVAL 1 HOUR FROM w) AS window_end, (SELECT COUNT(*) FROM g WHERE breach_hours > 0) AS sla_breaches"""))
def q_incident(spark, sf):
    s, t = _src_tgt(spark, sf)
    return R.incident_summary(R.gap_report(s, t, "event_id", "user_id", "value"), R.failure_window(s, t, "ts"), _breaches(spark, s, t))


@register("b14_terminal_risk_score", ids=("B14", "A16", "U1"), sql=with_ctes("ev", LOADED + """
, l AS (SELECT CASE WHEN event_type <> 'error' THEN user_id || '@' || CAST(ts AS DATE) END AS merchant_id, CAST(value * 10 AS DECIMAL(18,2)) AS amount FROM loaded),
b AS (SELECT CASE WHEN event_type <> 'error' THEN user_id || '@' || CAST(ts AS DATE) END AS merchant_id, CAST(value * 10 AS DECIMAL(18,2)) AS amount FROM ev),
per AS (SELECT merchant_id, COUNT(*) AS txn_count, CAST(ROUND(CAST(AVG(amount) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_amount
        FROM (SELECT * FROM l UNION ALL SELECT * FROM b) WHERE merchant_id IS NOT NULL GROUP BY 1),
p AS (SELECT per.*, (SELECT COUNT(*) FROM l WHERE merchant_id IS NULL) AS null_merchant_rows FROM per),
q AS (SELECT *, CAST((CASE WHEN txn_count > 3 THEN 40 WHEN txn_count > 1 THEN 20 ELSE 0 END) + (CASE WHEN avg_amount < 200 THEN 40 WHEN avg_amount < 500 THEN 20 ELSE 0 END)
        + (CASE WHEN null_merchant_rows > 0 THEN 20 ELSE 0 END) AS INTEGER) AS risk_score FROM p)
SELECT *, CASE WHEN risk_score >= 50 THEN 'INVESTIGATE' ELSE 'CLEAR' END AS decision FROM q"""))
def q_terminals(spark, sf):
    s, t = _src_tgt(spark, sf)
    return M.merchant_risk_score(derived.terminal_ledger(t), derived.terminal_ledger(s))


@register("u4_method_sets_booked", ids=("U4", "E8"), sql=with_ctes("booked", """
, a AS (SELECT DISTINCT payment_method AS value FROM silver WHERE year(transaction_date) >= 1997), b AS (SELECT DISTINCT payment_method AS value FROM booked WHERE year(transaction_date) >= 1997)
SELECT COALESCE(a.value, b.value) AS value, a.value IS NOT NULL AS in_silver, b.value IS NOT NULL AS in_booked FROM a FULL OUTER JOIN b ON a.value = b.value"""))
def q_method_sets(spark, sf):
    s = silver_df(spark, sf)
    late = F.year("transaction_date") >= 1997
    return distinct_set_compare(s.where(late), derived.booked_layer(s).where(late), "payment_method", "in_silver", "in_booked")


_CONTACTS = """
, columns AS (SELECT 'customer_contacts' AS t, unnest(['mail_to', 'reach_at', 'tax_id', 'dobText', 'customer_tier']) AS c,
    unnest(['c' || customer_id || '@example.com', '9' || lpad(CAST(customer_id AS VARCHAR), 9, '0'), 'ABCDE' || right(lpad(CAST(customer_id AS VARCHAR), 8, '0'), 4) || 'F', '1990-01-01', customer_tier]) AS v FROM customers
  UNION ALL SELECT 'merchant_accounts', unnest(['settle_to', 'terminal_host', 'category']),
    unnest([lpad(CAST(merchant_id AS VARCHAR), 11, '0'), '10.0.0.' || (merchant_id % 250), category]) FROM merchants),
m AS (""" + " UNION ALL ".join(
    f"SELECT t, c, {i} AS priority, '{n}' AS pii_type, '{sens}' AS sensitivity, ROUND(COUNT(*) FILTER (regexp_matches(v, '{rx}')) / COUNT(*), 4) AS match_rate FROM columns GROUP BY 1, 2"
    for i, (n, (rx, _cat, sens)) in enumerate(PII_PATTERNS.items())) + """),
found AS (SELECT t AS table_name, c AS column_name, pii_type, sensitivity, match_rate, CASE WHEN match_rate > 0.5 THEN 'high' ELSE 'medium' END AS confidence, 'regex' AS detection_method
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY t, c ORDER BY match_rate DESC, priority) AS r FROM m) WHERE r = 1 AND match_rate > 0.2
  UNION ALL SELECT 'customer_contacts', 'dobText', 'date_of_birth', 'Confidential', NULL, NULL, 'column_name'),
surface AS (SELECT *, CASE sensitivity WHEN 'Restricted' THEN 'CRITICAL' WHEN 'Confidential' THEN 'HIGH' WHEN 'Internal' THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM found)"""


def _surface(spark, sf):
    return G.pii_surface(derived.contact_tables(ledger.customers(spark, sf), ledger.merchants(spark, sf)), by_name=True)


@register("g6_pii_surface", ids=("G6", "G1", "G2"), sql=with_ctes("customers merchants", _CONTACTS + "\nSELECT * FROM surface"))
def q_surface(spark, sf):
    return _surface(spark, sf)


@register("g6_surface_counts", ids=("G6",), sql=with_ctes("customers merchants", _CONTACTS + """
SELECT s.severity, COUNT(f.severity) AS n_columns, COUNT(DISTINCT f.table_name) AS n_tables
FROM (SELECT unnest(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW']) AS severity) s LEFT JOIN surface f ON s.severity = f.severity GROUP BY 1"""))
def q_surface_counts(spark, sf):
    return G.surface_counts(_surface(spark, sf))


_RESTRICTIONS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, CASE MAX(o) WHEN 3 THEN 'Restricted' WHEN 2 THEN 'Confidential' WHEN 1 THEN 'Internal' ELSE 'Public' END AS dataset_classification "
    f"FROM o WHERE column_name IN ({cols})" for t, cols in (
        ("customer_contacts", "'mail_to', 'reach_at', 'tax_id'"), ("reachability", "'mail_to', 'reach_at'"), ("hosts", "'terminal_host'"), ("plain", "'category'")))


@register("g3_tiers_of_contact_tables", ids=("G3", "G1"), sql=with_ctes("customers merchants", _CONTACTS + """
, o AS (SELECT column_name, CASE sensitivity WHEN 'Restricted' THEN 3 WHEN 'Confidential' THEN 2 WHEN 'Internal' THEN 1 ELSE 0 END AS o FROM surface WHERE detection_method = 'regex')
""" + _RESTRICTIONS))
def q_tiers(spark, sf):
    tables = derived.contact_tables(ledger.customers(spark, sf), ledger.merchants(spark, sf))
    c, m = tables["customer_contacts"], tables["merchant_accounts"]
    sets = {"customer_contacts": c, "reachability": c.select("mail_to", "reach_at"), "hosts": m.select("terminal_host"), "plain": m.select("category")}
    out = None
    for name, df in sets.items():
        tier = G.dataset_tier(G.pii_scan(df)).select(F.lit(name).alias("table_name"), "dataset_classification")
        out = tier if out is None else out.unionByName(tier)
    return out
