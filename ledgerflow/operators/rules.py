"""Table-driven rules (R9, R10): metrics as long rows ``metric, subject, value``, rules as rows too."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The eight alert rules and four objectives. Operators: gt, lt and outside fire beyond a
# bound; band fires in [lo, hi); near fires within the bounds, at most 1 from one of them. Runtime
# approaches its limit from 90 % of it on (our reading; the rule names the limit alone).
RULES = [
    ("ALERT", "CRITICAL", "data_freshness_breached", "freshness_hours", "gt", None, 24.0),
    ("ALERT", "CRITICAL", "quality_threshold_breached", "quality_pct", "lt", 99.9, None),
    ("ALERT", "CRITICAL", "row_count_out_of_bounds", "daily_row_count", "outside", 17.0, 25.0),
    ("ALERT", "WARNING", "runtime_approaching_limit", "runtime_minutes", "band", 108.0, 120.0),
    ("ALERT", "WARNING", "quality_slightly_below_threshold", "quality_pct", "band", 99.85, 99.9),
    ("ALERT", "WARNING", "merchant_failure_rate_spike", "merchant_failure_pct", "gt", None, 30.0),
    ("ALERT", "INFO", "new_payment_method_detected", "unknown_method_rows", "gt", None, 0.0),
    ("ALERT", "INFO", "row_count_near_bounds", "daily_row_count", "near", 17.0, 25.0),
    ("SLO", "BREACH", "data_freshness_slo", "freshness_hours", "gt", None, 24.0),
    ("SLO", "BREACH", "quality_threshold_slo", "quality_pct", "lt", 99.9, None),
    ("SLO", "BREACH", "row_count_slo", "row_count_change_pct", "outside", -20.0, 20.0),
    ("SLO", "BREACH", "pipeline_runtime_slo", "runtime_minutes", "gt", None, 120.0),
]
RULE_SCHEMA = "kind string, severity string, rule string, metric string, operator string, lo double, hi double"


def rule_table(spark: SparkSession, rules: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(RULES if rules is None else rules, RULE_SCHEMA)


def metric(df: DataFrame, name: str, subject: Column, value: Column) -> DataFrame:
    return df.select(F.lit(name).alias("metric"), subject.cast("string").alias("subject"), value.cast("double").alias("value"))


def _fires() -> Column:
    v, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    cases = {"gt": v > hi, "lt": v < lo, "outside": (v < lo) | (v > hi), "band": (v >= lo) & (v < hi),
             "near": (v >= lo) & (v <= hi) & ((v <= lo + 1) | (v >= hi - 1))}
    return reduce(lambda c, kv: c.when(F.col("operator") == kv[0], kv[1]), cases.items(), F.when(F.lit(False), F.lit(None))).otherwise(F.lit(None))


def evaluate(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Every rule on every subject of its metric: ``kind, severity, rule, subject, value, fired``.

    A null value fires (missing data breaches); a rule whose metric has no row
    comes back once, with a null subject and ``fired`` null. Operators that are
    not known give a null. A new rule is a row, no code."""
    j = rules.join(metrics, "metric", "left")
    fired = F.when(F.col("subject").isNull() & F.col("value").isNull(), F.lit(None)).when(F.col("value").isNull(), F.lit(True)).otherwise(_fires())
    return j.select("kind", "severity", "rule", "subject", "value", fired.alias("fired"))


def rule_summary(evaluated: DataFrame) -> DataFrame:
    """Per rule: subjects, how many it fired for, and their least and greatest value."""
    return evaluated.groupBy("kind", "severity", "rule").agg(
        F.count("subject").alias("subjects"), F.count_if("fired").alias("fired"),
        F.min(F.when(F.col("fired"), F.round("value", 4))).alias("least"), F.max(F.when(F.col("fired"), F.round("value", 4))).alias("greatest"))
