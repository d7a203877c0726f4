"""Keyed difference of two whole layers (Q26, A23, Q27): what was dropped, added or changed, and in which columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layer_diff(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``measure, column_name, rows, share``: both layers compared by key, no row unread.

    Rows of a key are reduced to its greatest row by ``columns`` before anything is
    joined, combined map-side; further copies are counted (``left_copies``,
    ``right_copies``), and so are rows without a key. ``dropped`` keys are in ``left`` only, ``added``
    in ``right`` only; ``changed`` differ in a digest of all columns, ``same`` don't.
    ``drifted`` counts, per column, the keys of both layers whose value differs (null is a value). Shares are
    of the left layer's keys, of the right's for ``added``, of the keys in both for ``drifted``.
    """
    def one(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
        g = df.groupBy(F.col(key).cast("string").alias("_key")).agg(F.max(row).alias("row"), F.count(F.lit(1)).alias("n"))
        digest = F.xxhash64(*[F.col(f"row.{c}") for c in columns], *[F.col(f"row.{c}").isNull() for c in columns])
        return g.select("_key", F.struct("n", "row", digest.alias("digest")).alias(name))

    j = one(left, "a").join(one(right, "b"), "_key", "full_outer")
    keyed = F.col("_key").isNotNull()
    a, b = keyed & F.col("a").isNotNull(), keyed & F.col("b").isNotNull()
    same = (F.col("a.digest") == F.col("b.digest")) & F.col("a.row").eqNullSafe(F.col("b.row"))
    count = lambda c, name: F.count_if(c).alias(name)
    extra = lambda side, c, name: F.coalesce(F.sum(F.when(c, F.col(f"{side}.n") - 1)), F.lit(0)).alias(name)
    drift = [count(a & b & ~F.col(f"a.row.{c}").eqNullSafe(F.col(f"b.row.{c}")), f"d{k}") for k, c in enumerate(columns)]
    no_key = [F.coalesce(F.sum(F.when(~keyed, F.col(f"{s}.n"))), F.lit(0)).alias(f"{s}_null") for s in "ab"]
    row = j.agg(count(a, "ka"), count(b, "kb"), count(a & b, "both"), count(a & ~F.coalesce(b, F.lit(False)), "dropped"), count(b & ~F.coalesce(a, F.lit(False)), "added"),
                count(a & b & ~same, "changed"), count(a & b & same, "same"), extra("a", a, "xa"), extra("b", b, "xb"), *drift, *no_key)
    out = lambda m, n, of=None, c=None: F.struct(F.lit(m).alias("measure"), F.lit(c).cast("string").alias("column_name"), F.col(n).cast("long").alias("rows"),
                                                 (F.round(F.try_divide(F.col(n).cast("double"), F.col(of).cast("double")), 6) if of else F.lit(None).cast("double")).alias("share"))
    items = [out("left_keys", "ka"), out("right_keys", "kb"), out("dropped", "dropped", "ka"), out("added", "added", "kb"), out("changed", "changed", "ka"), out("same", "same", "ka"),
             out("left_copies", "xa"), out("right_copies", "xb"), out("left_null_keys", "a_null"), out("right_null_keys", "b_null"),
             *[out("drifted", f"d{k}", "both", c) for k, c in enumerate(columns)]]
    return row.select(F.inline(F.array(*items)))
