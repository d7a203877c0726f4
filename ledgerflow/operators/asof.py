"""As-of join (R11, W6): each row meets the nearest row in time, by a union and a sorted carry instead of an inequality join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, by: Sequence[str] = (), direction: str = "backward",
              out: str = "match", block_seconds: int = 3600) -> DataFrame:
    """``left`` with ``out``, the struct of the row of ``right`` with equal ``by`` that is nearest in time.

    ``backward``: the last at or before; ``forward``: the first at or after.
    Of rows of one time the greatest (backward) or smallest (forward) counts.
    Rows with a null key or time meet nothing.

    Both sides are cut into blocks of time per key. Inside a block a sorted
    pass carries the nearest right row along; from other blocks comes only their
    last one, through one summary row a block. A key that holds most rows so spreads
    over its blocks, and what is ordered per key is bounded by the calendar.
    """
    back = direction == "backward"
    keys = [f"_k{n}" for n in range(len(by))]

    def side(df: DataFrame, ts: str, name: str, other: str) -> DataFrame:
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        return df.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(keys, by, strict=True)], (us if back else -us).alias("_t"), row.alias(name)).withColumn("_side", F.lit(name))

    lhs, rhs = side(left, left_ts, "_l", "_r"), side(right, right_ts, "_r", "_l")
    rhs = rhs.where(" and ".join(f"{c} is not null" for c in [*keys, "_t"]))
    both = lhs.unionByName(rhs, allowMissingColumns=True).withColumn("_blk", F.floor(F.col("_t") / F.lit(block_seconds * 1_000_000)))
    tie = F.col("_r").asc_nulls_first() if back else F.col("_r").desc_nulls_first()
    inside = Window.partitionBy(*keys, "_blk").orderBy("_t", F.desc("_side"), tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # right before left
    near = both.withColumn("_near", F.last("_r", ignorenulls=True).over(inside))
    order = F.when(F.col("_side") == "_r", F.struct("_t", "_r") if back else F.struct(-F.col("_t"), "_r"))  # null for rows of the left
    pick = F.max_by("_r", order) if back else F.min_by("_r", order)
    blocks = both.where("_t is not null").groupBy(*keys, "_blk").agg(pick.alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.withColumn("_carry", F.last("_last", ignorenulls=True).over(before)).select(*keys, "_blk", "_carry")
    found = near.where("_side = '_l'").join(carried, [*keys, "_blk"], "left")
    match = F.when(F.col("_t").isNotNull(), F.coalesce("_near", "_carry"))
    return found.select("_l", match.alias("_m")).select("_l.*", F.col("_m").alias(out))
