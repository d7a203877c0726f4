"""Schema evolution and contracts (E1-E9, Q19).  Schema comparison is
metadata-only (driver side on StructTypes); data changes are DataFrame ops."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Widening casts that never lose information.
WIDENING = {
    ("int", "bigint"), ("int", "double"), ("float", "double"),
    ("int", "string"), ("bigint", "string"), ("double", "string"), ("float", "string"),
    ("date", "timestamp"), ("date", "string"), ("boolean", "string"),
}


@dataclass(frozen=True)
class Drift:
    new: dict[str, str]
    removed: dict[str, str]
    changed: dict[str, tuple[str, str]]
    required: frozenset[str] = frozenset()  # new columns that are not nullable


def _types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def detect_drift(expected: T.StructType, actual: T.StructType) -> Drift:
    """New / removed / type-changed columns (removed columns never index the
    actual schema)."""
    e, a = _types(expected), _types(actual)
    return Drift(new={k: v for k, v in a.items() if k not in e},
                 removed={k: v for k, v in e.items() if k not in a},
                 changed={k: (e[k], a[k]) for k in e if k in a and e[k] != a[k]},
                 required=frozenset(f.name for f in actual.fields if f.name not in e and not f.nullable))


def classify_drift(d: Drift) -> tuple[str, str]:
    """Severity NONE / LOW / HIGH / BREAKING and action ADD / FLAG / HALT.

    removed column or narrowing type change -> BREAKING / HALT; widening
    change or a new column that is not nullable -> HIGH / FLAG; only new
    nullable columns -> LOW / ADD; nothing -> NONE.
    """
    narrowing = [k for k, (old, new) in d.changed.items() if (old, new) not in WIDENING]
    if d.removed or narrowing:
        return "BREAKING", "HALT"
    if d.changed or d.required:
        return "HIGH", "FLAG"
    if d.new:
        return "LOW", "ADD"
    return "NONE", "NONE"


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def decide_columns(d: Drift) -> dict[str, tuple[str, str]]:
    """E2 per column: (action, reason).

    A removed column halts. A new numeric or non-nullable column is flagged, any
    other new one added. A widened type is added with a note, a narrowed one flagged.
    """
    out = {c: ("HALT", "removed") for c in d.removed}
    for c, kind in d.new.items():
        if c in d.required:
            out[c] = ("FLAG_ANOMALY", "new and not nullable")
        elif kind.split("(")[0] in NUMERIC:
            out[c] = ("FLAG_ANOMALY", "new and numeric")
        else:
            out[c] = ("ADD_TO_SCHEMA", "new")
    for c, (old, new) in d.changed.items():
        if (old, new) in WIDENING:
            out[c] = ("ADD_TO_SCHEMA", f"widened from {old} to {new}")
        else:
            out[c] = ("FLAG_ANOMALY", f"narrowed from {old} to {new}")
    return out


def apply_decisions(df: DataFrame, decisions: dict[str, tuple[str, str]]) -> DataFrame:
    """Drops columns of DROP_SILENTLY; a flagged column stays and gets a boolean
    ``_anomaly_<column>``, true where it holds a value. HALT raises."""
    halted = sorted(c for c, (action, _) in decisions.items() if action == "HALT")
    if halted:
        raise ValueError(f"schema drift halts the load: {', '.join(halted)}")
    gone = [c for c, (action, _) in decisions.items() if action == "DROP_SILENTLY"]
    flagged = [c for c, (action, _) in decisions.items() if action == "FLAG_ANOMALY"]
    out = df.select("*", *[F.col(f"`{c}`").isNotNull().alias(f"_anomaly_{c}") for c in flagged])
    return out.drop(*gone)


def apply_evolution(df: DataFrame, expected: T.StructType, drift: Drift) -> tuple[DataFrame, list[str]]:
    """Keep new columns (ADD), add removed ones as typed NULL and flag rows,
    cast widened columns back to the expected type when lossless; notes list."""
    notes: list[str] = []
    out = df
    for c, t in drift.removed.items():
        out = out.withColumn(c, F.lit(None).cast(t))
        notes.append(f"added missing column {c} as NULL {t}")
    for c, (old, new) in drift.changed.items():
        if (old, new) in WIDENING:
            notes.append(f"kept widened column {c} {old}->{new}")
        else:
            out = out.withColumn(c, F.expr(f"try_cast(`{c}` AS {old})"))
            notes.append(f"narrowing {c} {new}->{old} via try_cast")
    for c in drift.new:
        notes.append(f"kept new column {c}")
    if drift.removed:
        out = out.withColumn("_schema_flag", F.lit("MISSING_COLUMNS"))
    return out, notes


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Drop extra columns, add absent ones as NULL, cast to target types."""
    cols = []
    for f in target.fields:
        if f.name in df.columns:
            cols.append(F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def cast_repair(df: DataFrame, column: str, to: str = "double", fill=0) -> DataFrame:
    """E5: coerce to number, fill unparseable with ``fill``; ``_cast_repaired`` marks changed rows."""
    v = F.expr(f"try_cast(`{column}` AS {to})")
    return df.withColumn("_cast_repaired", v.isNull()).withColumn(column, F.coalesce(v, F.lit(fill).cast(to)))


def repair_record(df: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """merchant_nm -> merchant_name; DD-MM-YYYY -> YYYY-MM-DD; repair flags per row."""
    out = df
    if "merchant_nm" in df.columns:
        name = F.coalesce(F.col("merchant_name"), F.col("merchant_nm")) if "merchant_name" in df.columns \
            else F.col("merchant_nm")
        out = out.withColumn("_fixed_field", F.col("merchant_nm").isNotNull()).withColumn("merchant_name", name) \
                 .drop("merchant_nm")
    else:
        out = out.withColumn("_fixed_field", F.lit(False))
    d = F.col(date_col).cast("string")
    dmy = d.rlike(r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$")
    fixed = F.date_format(F.expr(f"try_to_date(CAST(`{date_col}` AS STRING), 'dd-MM-yyyy')"), "yyyy-MM-dd")
    return out.withColumn("_fixed_date", F.coalesce(dmy, F.lit(False))) \
              .withColumn(date_col, F.when(dmy, fixed).otherwise(d))


def migrate(df: DataFrame, steps: list[tuple]) -> DataFrame:
    """Ordered migrations: ("add", col, type) / ("rename", old, new) / ("drop", col)."""
    out = df
    for step in steps:
        if step[0] == "add":
            out = out.withColumn(step[1], F.lit(None).cast(step[2]))
        elif step[0] == "rename":
            out = out.withColumnRenamed(step[1], step[2])
        elif step[0] == "drop":
            out = out.drop(step[1])
        else:
            raise ValueError(f"unknown migration {step}")
    return out


def broken_consumers(uses: dict[str, set[str]], schema: T.StructType) -> dict[str, set[str]]:
    """Silent-break test: downstream queries whose declared columns are gone."""
    have = set(schema.names)
    return {q: cols - have for q, cols in uses.items() if cols - have}


def new_category_values(df: DataFrame, column: str, known: list[str]) -> DataFrame:
    """Distinct values of ``column`` not in the known list (anti join to the list)."""
    spark = df.sparkSession
    k = spark.createDataFrame([(v,) for v in known], f"{column} string")
    return df.select(column).distinct().join(F.broadcast(k), column, "left_anti")


def contract_checks(contract: dict):
    """Compile a contract {column: {required, values, regex, type}} to checks."""
    from . import quality as Q
    checks = []
    for col, rule in contract.items():
        if rule.get("required"):
            checks.append(Q.not_null(col))
        if rule.get("values"):
            checks.append(Q.in_set(col, rule["values"]))
        if rule.get("regex"):
            checks.append(Q.matches(col, rule["regex"]))
        if rule.get("type") in ("double", "int", "bigint"):
            checks.append(Q.between(col, rule.get("min"), rule.get("max")))
    return checks
