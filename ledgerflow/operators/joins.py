"""Join operators: anti / orphan checks (J6, J8), latest-row join (J7), set compare (U4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (NULL keys are orphans
    only if non-null; a NULL key never matches and is reported too)."""
    return fact.join(dim.select(key).distinct(), key, "left_anti")


def exclude_loaded(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose key is not yet in ``target`` (replay candidates)."""
    return source.join(target.select(key), key, "left_anti")


def join_latest(left: DataFrame, right: DataFrame, key: str, order_col: str) -> DataFrame:
    """Left join to the right side's latest row(s) per key (ties kept, RANK = 1).

    The latest value per key is a grouped max (map-side combined, skew-safe);
    rows are matched back on (key, max) with an equi-join.
    """
    mx = right.groupBy(key).agg(F.max(order_col).alias(order_col))
    latest = right.join(mx, [key, order_col], "inner")
    return left.join(latest, key, "left")


def distinct_set_compare(a: DataFrame, b: DataFrame, column: str, in_a: str, in_b: str) -> DataFrame:
    """U4: distinct values of one column in two layers, full outer join of the sets."""
    da = a.select(F.col(column).alias("value")).distinct().withColumn("_a", F.lit(True))
    db = b.select(F.col(column).alias("value")).distinct().withColumn("_b", F.lit(True))
    j = da.join(db, "value", "full_outer")
    return j.select("value", F.col("_a").isNotNull().alias(in_a), F.col("_b").isNotNull().alias(in_b))
