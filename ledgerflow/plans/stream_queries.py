"""Batch twins of the streaming operators, registered with oracle SQL.
The streaming runs themselves are checked against these twins in tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import derived, ledger
from ..streaming import ops
from .oracle import with_ctes
from .registry import register


@register("x2_tumbling_5min", ids=("X2", "A14"), sql=with_ctes("ev", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       COUNT(*) AS events, ROUND(SUM(value), 2) AS value_sum FROM ev GROUP BY 1, 2"""))
def q_x2(spark, sf):
    return ops.tumbling(ops.with_event_time(ledger.events(spark, sf)), "ts", "5 minutes")


@register("x3_sliding_4h_max_per_user", ids=("X3", "W4"), sql=with_ctes("ev", """
, w AS (SELECT user_id, value, UNNEST(generate_series(time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 235 MINUTE,
                                                      time_bucket(INTERVAL 5 MINUTE, ts), INTERVAL 5 MINUTE)) AS ws
        FROM ev),
g AS (SELECT user_id, ws, SUM(value) AS v FROM w GROUP BY 1, 2)
SELECT user_id, ROUND(MAX(v), 2) AS max_value_4h FROM g GROUP BY user_id"""))
def q_x3(spark, sf):
    ev = ops.with_event_time(ledger.events(spark, sf))
    return ops.sliding(ev, "ts", "4 hours", "5 minutes", ["user_id"]).groupBy("user_id").agg(F.max("value_sum").alias("max_value_4h"))


@register("x4_dedup_replayed_events", ids=("X4", "J8"), sql=with_ctes("ev", f"""
, replay AS (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE ts >= TIMESTAMP '{derived.OUTAGE_START}'
             AND ts < TIMESTAMP '{derived.OUTAGE_END}')
SELECT DISTINCT event_id, ts, user_id, event_type, value FROM replay"""))
def q_x4(spark, sf):
    ev = ledger.events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    replay = ev.unionByName(ev.where((F.col("ts") >= F.to_timestamp(F.lit(derived.OUTAGE_START)))
                                     & (F.col("ts") < F.to_timestamp(F.lit(derived.OUTAGE_END)))))
    return ops.dedup_replays(replay, "event_id", "ts")


@register("x6_enriched_hourly_by_tier", ids=("X6", "J1"), sql=with_ctes("ev customers", """
SELECT date_trunc('hour', e.ts) AS window_start, date_trunc('hour', e.ts) + INTERVAL 1 HOUR AS window_end,
       c.customer_tier, COUNT(*) AS events, ROUND(SUM(e.value), 2) AS value_sum
FROM ev e LEFT JOIN customers c ON e.user_id = c.customer_id GROUP BY 1, 2, 3"""))
def q_x6(spark, sf):
    ev = ops.with_event_time(ledger.events(spark, sf))
    e = ops.enrich_static(ev, ledger.customers(spark, sf), "user_id", "customer_id", ["customer_tier"])
    return ops.tumbling(e, "ts", "1 hour", by=["customer_tier"])


@register("x9_user_sessions", ids=("X9",), sql=with_ctes("ev", """
, o AS (SELECT *, CASE WHEN LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                         OR ts > LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS new_s FROM ev),
s AS (SELECT *, SUM(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, COUNT(*) AS events,
       ROUND(SUM(value), 2) AS value_sum FROM s GROUP BY user_id, sid"""))
def q_x9(spark, sf):
    return ops.sessions(ops.with_event_time(ledger.events(spark, sf)), "ts", "30 minutes", ["user_id"])
