"""Model-layer marts without test-data counterparts (B5, B6), SLO evaluation
(R9), completeness roster (R18) and declared column lineage (G7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import datediff_minutes, ordinal
from ..session import ensure_checkpoint_dir


def fct_payroll_ledger(workforce: DataFrame, compensation: DataFrame, key: str = "employee_id") -> DataFrame:
    """Inner workforce x left compensation.  One employee with two
    compensation rows fans out to two ledger rows (kept, as in the model);
    ``_fanout`` reports the number of rows per employee."""
    j = workforce.join(compensation, key, "left")
    n = j.groupBy(key).agg(F.count(F.lit(1)).alias("_fanout"))   # grouped count, joined back (skew-safe)
    return j.join(n, key, "left")


def fct_deliveries(orders: DataFrame, ratings: DataFrame) -> DataFrame:
    """Minutes picked-up -> delivered and placed -> delivered as minute
    boundaries crossed (warehouse DATEDIFF), rating defaults to 0."""
    j = orders.join(ratings.select("order_id", "rating"), "order_id", "left")
    return j.select("order_id", F.to_date("placed_at").alias("order_date"),
                    datediff_minutes("picked_up_at", "delivered_at").alias("delivery_minutes"),
                    datediff_minutes("placed_at", "delivered_at").alias("total_minutes"),
                    F.coalesce(F.col("rating"), F.lit(0)).alias("rating"))


# SLO targets (freshness hours, quality %, row-count band, runtime minutes).
SLOS = [("freshness_hours", "max", 24.0), ("quality_pct", "min", 99.9),
        ("row_count_change_pct", "abs_max", 20.0), ("runtime_minutes", "max", 120.0)]


def evaluate_slos(metrics: DataFrame) -> DataFrame:
    """Metrics (name, value) x SLO table -> met / breached per SLO."""
    slo = metrics.sparkSession.createDataFrame(SLOS, "name string, kind string, target double")
    j = slo.join(metrics, "name", "left")
    met = (F.when(F.col("value").isNull(), F.lit(False))
           .when(F.col("kind") == "max", F.col("value") <= F.col("target"))
           .when(F.col("kind") == "min", F.col("value") >= F.col("target"))
           .otherwise(F.abs(F.col("value")) <= F.col("target")))
    return j.withColumn("met", met)


# Roster tiers by share of expected items found.
ROSTER_ORDER = ["master", "complete", "partial", "missing"]


def completeness_roster(entities: DataFrame, expected: DataFrame, found: DataFrame, key: str,
                        item: str) -> DataFrame:
    """Per entity, how many of the expected items were found -> missing /
    partial / complete / master (complete plus extras), ranked by tier then
    found count.  Found items are matched to the expected list by a join; no
    entity x item grid is built."""
    exp = expected.select(item).distinct()
    k = exp.agg(F.count(F.lit(1))).scalar()
    items = found.select(key, item).distinct()
    hits = items.join(exp.withColumn("_exp", F.lit(True)), item, "left")
    counts = hits.groupBy(key).agg(F.count_if(F.col("_exp").isNotNull()).alias("found"),
                                   F.count_if(F.col("_exp").isNull()).alias("extras"))
    per = (entities.select(key).distinct().join(counts, key, "left")
           .select(key, F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("extras", F.lit(0)).alias("extras"))
           .withColumn("expected", k))
    tier = (F.when(F.col("found") == 0, "missing").when(F.col("found") < F.col("expected"), "partial")
            .when(F.col("extras") > 0, "master").otherwise("complete"))
    return per.withColumn("tier", tier).orderBy(ordinal("tier", ROSTER_ORDER), F.desc("found"), key)


def lineage_closure(edges: DataFrame) -> DataFrame:
    """Transitive closure of declared column lineage (target <- source).

    Semi-naive: each round joins only the pairs that the last one found with the
    edges, and keeps those not known yet; it ends when there are none, so a chain of
    any depth (or a cycle) is closed. Rounds are checkpointed.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = edges.select(F.col("target").alias("t"), F.col("source").alias("s")).distinct().checkpoint(eager=True)
    closure = new = e
    while not new.isEmpty():
        step = new.alias("c").join(e.alias("e"), F.col("c.s") == F.col("e.t")).select(
            F.col("c.t").alias("t"), F.col("e.s").alias("s")).distinct()
        new = step.join(closure, ["t", "s"], "left_anti").checkpoint(eager=True)
        closure = closure.unionByName(new).checkpoint(eager=True)
    return closure.select(F.col("t").alias("target"), F.col("s").alias("source"))
