"""PII and governance operators."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import (HIGH_RATE, LOAD_RESTRICTION, MEDIUM_RATE, NAME_HINTS, PII_PATTERNS,
                                  REDACTION_PATTERNS, TIER_ORDER)


def pii_match_rates(df: DataFrame, columns: Sequence[str] | None = None, weight: str | None = None) -> DataFrame:
    """G1: full-column match rate of every pattern for every column, one scan.

    Values are read as strings and trimmed; the rate is over non-null values.
    Columns are unpivoted to (column, value) and all patterns evaluated in one
    aggregate grouped by column (partial aggregation map-side).  ``weight`` names the
    number of rows that a row of ``df`` stands for: values that repeat much (tokens)
    are counted first, and the patterns then tried once a value.
    """
    cols = list(columns or [c for c in df.columns if c != weight])
    n = F.col(weight) if weight else F.lit(1)
    long = df.select(*[F.col(c).cast("string") for c in cols], n.alias("_n")).unpivot(["_n"], cols, "column_name", "value") \
             .where(F.col("value").isNotNull()).withColumn("value", F.trim("value"))
    aggs = [F.sum("_n").alias("non_null")]
    for name, (rx, _cat, _sens) in PII_PATTERNS.items():
        aggs.append(F.sum(F.when(F.col("value").rlike(rx), F.col("_n")).otherwise(0)).alias(name))
    per = long.groupBy("column_name").agg(*aggs)
    parts = [F.struct(F.lit(i).alias("priority"), F.lit(n).alias("pii_type"), F.lit(cat).alias("category"),
                      F.lit(sens).alias("sensitivity"),
                      F.round(F.col(n) / F.col("non_null"), 4).alias("match_rate"))
             for i, (n, (_rx, cat, sens)) in enumerate(PII_PATTERNS.items())]
    return per.select("column_name", "non_null", F.explode(F.array(*parts)).alias("p")).select(
        "column_name", "non_null", "p.*")


def pii_scan(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """G1: per column the best pattern (highest rate; ties by pattern priority)
    with confidence high (> 0.5) / medium (> 0.2); columns without a match
    above 0.2 are left out.  Ranked by match rate."""
    rates = pii_match_rates(df, columns)
    best = rates.groupBy("column_name").agg(
        F.max_by(F.struct("pii_type", "category", "sensitivity", "match_rate"),
                 F.struct(F.col("match_rate"), -F.col("priority"))).alias("b"))
    out = best.select("column_name", "b.*").where(F.col("match_rate") > MEDIUM_RATE)
    return out.withColumn("confidence", F.when(F.col("match_rate") > HIGH_RATE, "high").otherwise("medium")) \
              .withColumn("detection_method", F.lit("regex"))


def name_hints(columns: Sequence[str]) -> list[tuple[str, str]]:
    """Dictionary rules on column names (metadata only, no data read)."""
    out = []
    for c in columns:
        # words end at signs, digits and humps: mobileNo, phone1
        tokens = "_" + "_".join(w.lower() for w in re.findall("[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", c)) + "_"
        for pii_type, keys in NAME_HINTS.items():
            if any(f"_{k}_" in tokens for k in keys):  # whole words of the name only
                out.append((c, pii_type))
                break
    return out


def dataset_tier(findings: DataFrame) -> DataFrame:
    """Dataset classification = max sensitivity over findings (Public when none)."""
    ordv = F.lit(0)
    for name, v in TIER_ORDER.items():
        ordv = F.when(F.col("sensitivity") == name, F.lit(v)).otherwise(ordv)
    m = findings.agg(F.max(ordv).alias("_o"))
    tier = F.lit("Public")
    for name, v in TIER_ORDER.items():
        tier = F.when(F.col("_o") == v, F.lit(name)).otherwise(tier)
    restr = F.lit(LOAD_RESTRICTION["Public"])
    for name, text in LOAD_RESTRICTION.items():
        restr = F.when(tier == name, F.lit(text)).otherwise(restr)
    return m.select(tier.alias("dataset_classification"), restr.alias("load_restriction"))


# --- G4 masking -------------------------------------------------------------

def mask_last4(c: Column | str, keep: int = 4, fill: str = "X") -> Column:
    """Phone / national id: keep the last ``keep`` digits; a value of no more digits is filled whole."""
    c = F.col(c) if isinstance(c, str) else c
    digits = F.regexp_replace(c.cast("string"), r"[^0-9]", "")
    shown = F.when(F.length(digits) > keep, F.right(digits, F.lit(keep))).otherwise(F.repeat(F.lit(fill), F.length(digits)))
    return F.concat(F.repeat(F.lit(fill), F.greatest(F.length(digits) - keep, F.lit(0))), shown)


def mask_email(c: Column | str, salt: str = "") -> Column:
    """Domain-preserving: local part -> 10 hex chars of sha256(salt || local); a value without @ is hashed whole."""
    c = F.col(c) if isinstance(c, str) else c
    local = F.substring_index(c, "@", 1)
    domain = F.substring_index(c, "@", -1)
    hashed = F.substring(F.sha2(F.concat(F.lit(salt), local), 256), 1, 10)
    return F.when(F.contains(c, F.lit("@")), F.concat(hashed, F.lit("@"), domain)).otherwise(hashed)


def token(c: Column | str, salt: str, prefix: str = "TKN") -> Column:
    """Salted token for account / card numbers (consistent per value)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(F.concat(F.lit(salt), c.cast("string")), 256), 1, 16))


def pan_token(c: Column | str, salt: str) -> Column:
    """Format-preserving tax-id token: 5 letters, 4 digits, 1 letter, all derived
    from sha256(salt || value) (hex digits mapped to letters / digits)."""
    c = F.col(c) if isinstance(c, str) else c
    h = F.upper(F.sha2(F.concat(F.lit(salt), c.cast("string")), 256))
    letters = F.translate(h, "0123456789", "GHIJKLMNOP")
    digits = F.translate(h, "ABCDEF", "012345")
    return F.concat(F.substring(letters, 1, 5), F.substring(digits, 6, 4), F.substring(letters, 10, 1))


def pseudonym(key: Column | str, prefix: str = "Person", salt: str = "") -> Column:
    """Consistent fake name per key and salt."""
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha2(F.concat(F.lit(salt), key.cast("string")), 256), 1, 10))


MASKERS = {
    "phone_number": lambda c, salt: mask_last4(c),
    "aadhaar_number": lambda c, salt: mask_last4(c),
    "email_address": lambda c, salt: mask_email(c, salt),
    "pan_number": lambda c, salt: pan_token(c, salt),
    "account_number": lambda c, salt: token(c, salt, "ACCT"),
    "credit_card": lambda c, salt: token(c, salt, "CARD"),
    "full_name": lambda c, salt: pseudonym(c, salt=salt),
    "ip_address": lambda c, salt: F.regexp_replace(F.col(c), r"\.[0-9]{1,3}$", ".0"),
}


def mask(df: DataFrame, plan: dict[str, str], salt: str) -> DataFrame:
    """Apply a masking plan {column: pii_type} with native expressions."""
    out = df
    for c, t in plan.items():
        out = out.withColumn(c, MASKERS[t](c, salt))
    return out


def redact_text(c: Column | str) -> Column:
    """Replace every personal-data match in free text by ``[type]``."""
    c = F.col(c) if isinstance(c, str) else c
    for name, rx in REDACTION_PATTERNS:
        c = F.regexp_replace(c, rx, f"[{name.upper()}]")
    return c


def pii_hits(c: Column | str) -> list[Column]:
    """Count of matches per redaction pattern (evaluated on the raw text in order)."""
    c = F.col(c) if isinstance(c, str) else c
    out = []
    cur = c
    for name, rx in REDACTION_PATTERNS:
        out.append(F.regexp_count(cur, F.lit(rx)).cast("bigint").alias(f"n_{name}"))
        cur = F.regexp_replace(cur, rx, f"[{name.upper()}]")
    return out


# --- G10 read-only statement guard --------------------------------------------

FORBIDDEN = ("INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE", "MERGE", "GRANT", "REVOKE")


def statement_guard(log: DataFrame, sql_col: str, known_tables: Sequence[str]) -> DataFrame:
    """Per logged statement: allowed?, reason (first failing rule)."""
    s = F.upper(F.trim(F.coalesce(F.col(sql_col), F.lit(""))))
    words = "|".join(FORBIDDEN)
    known = "|".join(t.upper() for t in known_tables)
    reason = (F.when(s == "", "empty statement")
              .when(~s.startswith("SELECT") & ~s.startswith("WITH"), "must start with SELECT")
              .when(s.rlike(rf"(^|[^A-Z_])({words})([^A-Z_]|$)"), "forbidden keyword")
              .when(~s.rlike(rf"(^|[^A-Z_])({known})([^A-Z_]|$)"), "unknown table")
              .when(~s.rlike(r"(^|[^A-Z_])WHERE([^A-Z_]|$)") & ~s.rlike(r"(^|[^A-Z_])LIMIT([^A-Z_]|$)")
                    & ~s.rlike(r"(^|[^A-Z_])GROUP BY([^A-Z_]|$)"), "unfiltered scan"))
    return log.withColumn("guard_reason", reason).withColumn("allowed", reason.isNull())


SEVERITY = {"Restricted": "CRITICAL", "Confidential": "HIGH", "Internal": "MEDIUM", "Public": "LOW"}


def pii_surface(frames: dict[str, DataFrame], by_name: bool = False) -> DataFrame:
    """PII findings over many tables (table, column, type, sensitivity, severity, how found); each table is
    scanned once.  ``by_name`` adds columns that only their names give away (G2), without a rate."""
    parts = [pii_scan(df).withColumn("table_name", F.lit(name)) for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    found = out.select("table_name", "column_name", "pii_type", "sensitivity", "match_rate", "confidence", "detection_method")
    if by_name:
        hints = [(name, c, t, PII_PATTERNS[t][2] if t in PII_PATTERNS else "Confidential")
                 for name, df in frames.items() for c, t in name_hints(df.columns)]
        named = out.sparkSession.createDataFrame(hints, "table_name string, column_name string, pii_type string, sensitivity string")
        rest = named.join(found.select("table_name", "column_name"), ["table_name", "column_name"], "left_anti")
        found = found.unionByName(rest.withColumn("detection_method", F.lit("column_name")), allowMissingColumns=True)
    severity = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    return found.withColumn("severity", severity[F.col("sensitivity")])


def surface_counts(surface: DataFrame) -> DataFrame:
    """Columns and tables per severity; the severities without a finding count 0."""
    known = surface.sparkSession.createDataFrame([(v,) for v in SEVERITY.values()], "severity string")
    per = surface.groupBy("severity").agg(F.count(F.lit(1)).alias("n_columns"), F.countDistinct("table_name").alias("n_tables"))
    return known.join(per, "severity", "left").fillna(0)
