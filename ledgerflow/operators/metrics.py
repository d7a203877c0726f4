"""Semantic metric registry -> native Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_double, count_when, pct, sum_when

# Business measures from the semantic model (fixed definitions).
METRICS: dict[str, Callable[[], Column]] = {
    "total_revenue": lambda: as_double(sum_when(F.col("status") == "COMPLETED", "amount")),
    "failure_rate_pct": lambda: pct(count_when(F.col("status") == "FAILED"), F.count(F.lit(1))),
    "completed_transaction_count": lambda: count_when(F.col("status") == "COMPLETED"),
    "total_transactions": lambda: F.count(F.lit(1)),
}


def metric(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Evaluate named metrics grouped by any dimension columns (one aggregate)."""
    unknown = [n for n in names if n not in METRICS]
    if unknown:
        raise KeyError(f"unknown metrics {unknown}")
    aggs = [METRICS[n]().alias(n) for n in names]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
