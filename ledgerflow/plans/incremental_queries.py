"""Loads in batches, against a rebuild in SQL: whatever the batches, the result is that of all rows at once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import LedgerState
from ..session import ensure_checkpoint_dir
from ..sources import derived, ledger
from ..sources.indexed import IndexedTable, merge_indexed
from . import ledger_queries  # noqa: F401
from .oracle import with_ctes
from .registry import REGISTRY, register


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerflow-{name}/{uuid.uuid4().hex}"


def _batches(txn: DataFrame) -> list[tuple[str, DataFrame]]:
    """All ledger rows in three batches dealt by row, so ids come back later, on other dates and with older versions; parts of a
    batch are sent again in the next, and the second batch once more as a whole."""
    slot = F.pmod(F.xxhash64("transaction_id", "transaction_date", "src_seq", "merchant_id", "amount"), F.lit(10))
    second = txn.where(slot.isin(6, 7, 8, 0))
    return [("run-1", txn.where(slot < 6)), ("run-2", second), ("run-2", second), ("run-3", txn.where(slot.isin(9, 7)))]


def _state(spark, sf) -> LedgerState:
    state = LedgerState(spark, _folder(spark, "state"), span="yyyy")
    for name, batch in _batches(ledger.transactions(spark, sf)):
        state.apply(batch, name)
    return state


@register("b1_incremental_customer_ltv", ids=("B1", "A3", "S11"), sql=REGISTRY["a3_customer_ltv"].sql)
def q_incremental_ltv(spark, sf):
    return _state(spark, sf).customer_ltv()


@register("b2_incremental_merchant_days", ids=("B2", "B1", "A1", "S11"), sql=with_ctes("silver", """
SELECT merchant_id, transaction_date AS report_date, CAST(SUM(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END) AS DOUBLE) AS total_revenue,
       COUNT(*) AS txn_count, ROUND(COUNT(CASE WHEN status = 'FAILED' THEN 1 END) * 100.0 / COUNT(*), 2) AS failure_rate_pct
FROM silver GROUP BY 1, 2"""))
def q_incremental_days(spark, sf):
    return _state(spark, sf).merchant_days()


def _deliveries(events: DataFrame) -> list[tuple[str, DataFrame]]:
    """Events as a stream delivers them: three spans of time, each with rows of the one before, the second delivered twice."""
    at = lambda s: F.lit(s).cast("timestamp")
    ts = F.col("ts")
    first, second = ts < at(derived.OUTAGE_START), ts < at("2024-01-22")
    return [("load/0", events.where(first)), ("load/1", events.where(second & (ts >= at("2024-01-14")))), ("load/1", events.where(second)), ("load/2", events.where(ts >= at("2024-01-20")))]


def _loaded(spark, sf) -> tuple[IndexedTable, list[dict]]:
    root = _folder(spark, "merge")
    ev = ledger.events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    done = [merge_indexed(spark, root, batch, "event_id", name, ["ts"]) for name, batch in _deliveries(ev)]
    return IndexedTable(spark, root, "event_id"), done


@register("s9_indexed_merge", ids=("S9", "S10", "J8", "X5"), sql=with_ctes("ev", "SELECT event_id, ts, user_id, event_type, value FROM ev"))
def q_indexed_merge(spark, sf):
    return _loaded(spark, sf)[0].read()


@register("s9_indexed_merge_log", ids=("S9", "S10", "X5"), sql=with_ctes("ev", f"""
, b AS (SELECT 'load/0' AS batch, event_id FROM ev WHERE ts < TIMESTAMP '{derived.OUTAGE_START}'
  UNION ALL SELECT 'load/1', event_id FROM ev WHERE ts < TIMESTAMP '2024-01-22' AND ts >= TIMESTAMP '2024-01-14'
  UNION ALL SELECT 'load/2', event_id FROM ev WHERE ts >= TIMESTAMP '2024-01-20')
SELECT batch, COUNT(*) AS attempted, COUNT(*) FILTER (first) AS loaded, COUNT(*) FILTER (NOT first) AS skipped
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY batch) = 1 AS first FROM b) GROUP BY batch"""))
def q_indexed_merge_log(spark, sf):
    table, _ = _loaded(spark, sf)
    rows = [(m["batch"], m["attempted"], m["rows"], m["attempted"] - m["rows"]) for m in table.markers()]
    return spark.createDataFrame(rows, "batch string, attempted long, loaded long, skipped long")
