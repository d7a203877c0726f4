"""Silver layer: filter, keep-latest dedup, dimension enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SILVER_COLUMNS = (
    "transaction_id", "amount", "status", "merchant_id", "customer_id",
    "transaction_date", "payment_method", "merchant_name", "category", "city",
    "quality_flag",
)


def silver_filter(df: DataFrame, id_col: str = "transaction_id", amount_col: str = "amount",
                  strict_positive: bool = False) -> DataFrame:
    """P3 (id present, amount >= 0) and P4 (amount > 0 when ``strict_positive``)."""
    amount_ok = F.col(amount_col) > 0 if strict_positive else F.col(amount_col) >= 0
    return df.where(F.col(id_col).isNotNull() & amount_ok)


def _pick_one(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], latest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in list(order_cols) + rest])
    pick = F.max(packed) if latest else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("_pick"))
    return out.select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in list(order_cols) + rest]).select(*df.columns)


def keep_latest(df: DataFrame, keys: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order_cols`` (all descending).

    Written as a grouped ``max`` over a struct (order columns first, then every
    other column as tie-break) instead of ``row_number`` over a window: the
    aggregate combines map-side, so a key holding a third of all rows is
    reduced to one row per input partition before the shuffle, and the
    survivor is deterministic whatever the input partitioning.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _pick_one(df, keys, order_cols, latest=True)


def keep_first(df: DataFrame, keys: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """First occurrence per key in arrival order (smallest ``order_cols``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _pick_one(df, keys, order_cols, latest=False)


def enrich(fact: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str],
           flag_col: str = "quality_flag", matched: str = "CLEAN",
           unmatched: str = "UNMATCHED") -> DataFrame:
    """Left join to a dimension, flag rows whose key has no dimension row.

    The flag tests the *dimension-side* match marker, never the fact key.
    Whether the dimension is broadcast is left to the planner, which knows its bytes.
    """
    d = dim.select(key, *attrs).withColumn("_dim_hit", F.lit(True))
    joined = fact.join(d, key, "left")
    flag = F.when(F.col("_dim_hit").isNull(), F.lit(unmatched)).otherwise(F.lit(matched))
    return joined.withColumn(flag_col, flag).drop("_dim_hit")


LEDGER_DEDUP_ORDER = ("transaction_date", "src_seq", "merchant_id", "amount")


def build_silver(txn: DataFrame, merchants: DataFrame,
                 dedup_order: Sequence[str] = LEDGER_DEDUP_ORDER) -> DataFrame:
    """Bronze->Silver: filter (P3) -> keep latest per id (W2) -> enrich."""
    filtered = silver_filter(txn)
    latest = keep_latest(filtered, "transaction_id", dedup_order)
    enriched = enrich(latest, merchants, "merchant_id", ["merchant_name", "category", "city"])
    return enriched.select(*SILVER_COLUMNS)
