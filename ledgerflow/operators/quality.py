"""Data-quality operators (Q1-Q28): compiled single-pass checks, per-row reasons,
quarantine split, profiles and distribution/drift comparison."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import is_blank, parse_double


def distribution_compare(a: DataFrame, b: DataFrame, columns: Sequence[str],
                         numeric: Sequence[str] = ()) -> DataFrame:
    """Per column distinct count, null rate (and mean for numerics) in both sets.

    One aggregate per dataset over all columns, unpivoted to rows, then joined
    on column name: two scans total, independent of the column count.
    """
    def stats(df: DataFrame, sfx: str) -> DataFrame:
        aggs = []
        for c in columns:
            aggs += [F.countDistinct(c).alias(f"{c}__distinct"),
                     F.round(F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)), 6).alias(f"{c}__null")]
            if c in numeric:
                aggs.append(F.round(F.avg(c), 2).cast("double").alias(f"{c}__mean"))
        row = df.agg(*aggs)
        parts = []
        for c in columns:
            mean = F.col(f"{c}__mean") if c in numeric else F.lit(None).cast("double")
            parts.append(F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__distinct").alias(f"distinct_{sfx}"),
                                  F.col(f"{c}__null").alias(f"null_rate_{sfx}"), mean.alias(f"mean_{sfx}")))
        return row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")

    return stats(a, "a").join(stats(b, "b"), "column_name")


# ---------------------------------------------------------------------------
# Check model (Q2-Q13): a check list compiled into ONE aggregate pass.
# ---------------------------------------------------------------------------

ROW_KINDS = {"not_null", "unique", "between", "in_set", "regex"}
DATASET_KINDS = {"row_count_between", "mean_between", "min_at_least", "duplicate_count_max",
                 "duplicate_values_max", "missing_count_max", "invalid_count_max"}


@dataclass(frozen=True)
class Check:
    """One expectation.  ``kind`` picks the rule, ``params`` its arguments."""

    kind: str
    column: str | None = None
    params: dict = field(default_factory=dict)
    severity: str = "critical"
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind


def not_null(c, severity="critical"):
    return Check("not_null", c, severity=severity, name="expect_column_values_to_not_be_null")


def unique(c, severity="critical"):
    return Check("unique", c, severity=severity, name="expect_column_values_to_be_unique")


def between(c, lo=None, hi=None, severity="critical"):
    return Check("between", c, {"lo": lo, "hi": hi}, severity, "expect_column_values_to_be_between")


def in_set(c, values, severity="critical"):
    return Check("in_set", c, {"values": tuple(values)}, severity, "expect_column_values_to_be_in_set")


def matches(c, regex, severity="critical"):
    return Check("regex", c, {"regex": regex}, severity, "expect_column_values_to_match_regex")


def _row_fail(df: DataFrame, chk: Check) -> Column | None:
    """Per-row failure predicate (never NULL) for row-level checks."""
    c = F.col(chk.column)
    if chk.kind == "not_null":                       # Q2: blank counts as null
        return is_blank(c)
    if chk.kind == "between":                        # Q4: unparseable / null fails
        v = parse_double(chk.column)
        bad = v.isNull()
        if chk.params.get("lo") is not None:
            bad = bad | (v < F.lit(float(chk.params["lo"])))
        if chk.params.get("hi") is not None:
            bad = bad | (v > F.lit(float(chk.params["hi"])))
        return bad
    if chk.kind == "in_set":                         # Q5: null fails (stringified)
        if not chk.params["values"]:                 # nothing to check against
            return F.lit(False)
        return ~F.coalesce(c.cast("string").isin(*chk.params["values"]), F.lit(False))
    if chk.kind == "regex":                          # Q6: start-anchored match
        rx = chk.params["regex"]
        return ~F.coalesce(c.cast("string").rlike("^(?:" + rx + ")"), F.lit(False))
    if chk.kind == "unique":
        return F.col(_dup_col(chk.column))
    return None


def quoted(c: str) -> str:
    """A column name as an expression, dots and back quotes included."""
    return "`" + c.replace("`", "``") + "`"


def _dup_col(c: str) -> str:
    return f"__dup_{c}"


def key_counts(df: DataFrame, c: str) -> DataFrame:
    """Rows per value of ``c`` (NULL is one group), combined map-side: a hot key,
    NULL included, leaves each map task as a single partial count."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))


NULL_SALTS = 64


def with_duplicate_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q3: flag every member of a duplicate group (keep=False semantics; NULLs
    duplicate each other).

    Two scans a column: one grouped count gives the keys seen more than once (one row a
    key; AQE skew-join splits a hot one on the row side), and the rows join them by the column itself, so that no
    second copy of it is shuffled.  The NULL group is one of those keys: it is repeated ``NULL_SALTS`` times and
    NULL rows pick a copy by their hash, so they never meet in one join task; other keys have salt 0.
    """
    out = df
    hashed = [quoted(c) for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    for c in columns:
        key, mine, theirs, dup = "__key_" + c, "__salt_" + c, "__salts_" + c, _dup_col(c)
        some, null = F.coalesce(F.col(c).cast("string"), F.lit("")), F.col(c).isNull()
        salts = F.when(null, F.sequence(F.lit(1), F.lit(NULL_SALTS))).otherwise(F.array(F.lit(0)))
        dups = key_counts(df, c).where(F.col("_n") > 1).select(some.alias(key), F.explode(salts).alias(theirs), F.lit(True).alias(dup))
        salt = F.when(null, F.pmod(F.xxhash64(*hashed), F.lit(NULL_SALTS)).cast("int") + 1).otherwise(F.lit(0))
        out = (out.withColumn(mine, salt).join(dups, (some == F.col(quoted(key))) & (F.col(quoted(mine)) == F.col(quoted(theirs))), "left")
               .withColumn(dup, F.coalesce(F.col(quoted(dup)), F.lit(False))).drop(key, mine, theirs))
    return out


def flag_rows(df: DataFrame, checks: list[Check]) -> tuple[DataFrame, list[tuple[Check, str]]]:
    """Add one boolean failure column per row-level check; missing columns are skipped (Q10)."""
    present = set(df.columns)
    usable = [c for c in checks if c.kind in ROW_KINDS and c.column in present]
    uniq = sorted({c.column for c in usable if c.kind == "unique"})
    flagged = with_duplicate_flags(df, uniq) if uniq else df
    cols = [(chk, f"__fail_{i}") for i, chk in enumerate(usable)]
    # one projection for all flags (a withColumn chain re-analyses the plan per column)
    flagged = flagged.select("*", *[_row_fail(flagged, chk).alias(name) for chk, name in cols])
    return flagged, cols


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Q13: one row per check (check, column, severity, failed_row_count,
    observed_value, passed, error) from one scan of the data.

    Duplicate figures need the rows per value.  If one is asked for, the other checks' partial sums
    ride along in that grouped count (per value, combined map-side), and a second aggregate adds
    up both; with several such columns a row is counted once per column and the
    other checks see its first copy only.  Without one it is a single aggregate."""
    present = set(df.columns)
    usable = [c for c in checks if c.column is None or c.column in present]
    row_cols = [(c, f"__fail_{i}") for i, c in enumerate(usable) if c.kind in ROW_KINDS]
    ds = [(c, f"__ds_{i}") for i, c in enumerate(usable) if c.kind in DATASET_KINDS]
    keyed = ("unique", "duplicate_count_max", "duplicate_values_max")
    keys = sorted({c.column for c, _ in row_cols + ds if c.kind in keyed})

    # per row: a flag or number per check; then (partial, total) aggregates of it
    cols, partial, total = [F.lit(1).alias("__one")], [F.count("__one").alias("__rows")], [F.sum("__rows").alias("__rows")]

    def counted(cond: Column, name: str) -> None:
        cols.append(cond.alias(name))
        partial.append(F.count_if(F.col(name)).alias(name))
        total.append(F.sum(name).alias(name))

    for c, name in row_cols:
        if c.kind != "unique":
            counted(_row_fail(df, c), name)
    for c, name in ds:
        col = F.col(c.column) if c.column else None
        if c.kind == "missing_count_max":
            counted(is_blank(col), name)
        elif c.kind == "invalid_count_max":
            counted(col.isNotNull() & ~col.cast("string").isin(*c.params["values"]), name)
        elif c.kind == "mean_between":
            cols.append(parse_double(c.column).alias(name))
            partial += [F.sum(name).alias(name + "s"), F.count(name).alias(name + "c")]
            total.append(F.try_divide(F.sum(name + "s"), F.sum(name + "c")).alias(name))
        elif c.kind == "min_at_least":
            cols.append(parse_double(c.column).alias(name))
            partial.append(F.min(name).alias(name))
            total.append(F.min(name).alias(name))
        elif c.kind == "row_count_between":
            total.append(F.sum("__rows").alias(name))
    if len(keys) > 1:
        slim = df.select(*cols, *[F.col(k).cast("string").alias(f"__key{j}") for j, k in enumerate(keys)])
        rest = [n for n in slim.columns if not n.startswith("__key")]
        copies = F.array(*[F.struct(F.lit(j).alias("__tag"), F.col(f"__key{j}").alias("__key"),
                                    *[(F.col(n) if j == 0 else F.when(F.lit(False), F.col(n))).alias(n) for n in rest])
                           for j in range(len(keys))])
        grouped = slim.select(F.inline(copies)).groupBy("__tag", "__key")
    elif keys:
        grouped = df.select(*cols, F.lit(0).alias("__tag"), F.col(keys[0]).alias("__key")).groupBy("__tag", "__key")
    else:
        grouped = df.select(*cols).groupBy()
    if keys:
        # copies beyond the first have no row flags, so the row count is of __one, the group's size of its rows
        per = grouped.agg(F.count(F.lit(1)).alias("_n"), *partial)
        for c, name in row_cols + ds:
            here = F.col("__tag") == (keys.index(c.column) if c.kind in keyed else 0)
            some = here & F.col("__key").isNotNull()
            if c.kind == "unique":
                total.append(F.sum(F.when(here & (F.col("_n") > 1), F.col("_n"))).alias(name))
            elif c.kind == "duplicate_count_max":    # Q9: count - distinct
                total.append(F.sum(F.when(some, F.col("_n") - 1)).alias(name))
            elif c.kind == "duplicate_values_max":   # Q11: distinct values seen more than once
                total.append(F.count_if(some & (F.col("_n") > 1)).alias(name))
    else:
        per = grouped.agg(*partial)
    row = per.agg(*total)
    numbers = {n for c, n in ds if c.kind in ("mean_between", "min_at_least")}
    row = row.select(*[F.col(n) if n in numbers else F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n)
                       for n in row.columns])
    row = row.select(*[F.col(n) for n in row.columns if n not in {m for _, m in ds}], *[F.col(n).cast("double").alias(n) for _, n in ds])
    structs = []
    for chk, name in row_cols:
        n = F.col(name)
        structs.append(F.struct(F.lit(chk.label).alias("check_name"), F.lit(chk.column).alias("column_name"),
                                F.lit(chk.severity).alias("severity"), n.alias("failed_row_count"),
                                F.lit(None).cast("double").alias("observed_value"), (n == 0).alias("passed"),
                                F.lit(None).cast("string").alias("error")))
    for chk, a in ds:
        v = F.col(a)
        p = chk.params
        if chk.kind in ("row_count_between", "mean_between"):
            ok = F.lit(True)
            if p.get("lo") is not None:
                ok = ok & (v >= F.lit(float(p["lo"])))
            if p.get("hi") is not None:
                ok = ok & (v <= F.lit(float(p["hi"])))
            ok = F.coalesce(ok, F.lit(False))
        elif chk.kind == "min_at_least":
            ok = F.coalesce(v >= F.lit(float(p.get("lo", 0))), F.lit(True))
        else:
            ok = v <= F.lit(float(p.get("max", 0)))
        structs.append(F.struct(F.lit(chk.label).alias("check_name"), F.lit(chk.column).alias("column_name"),
                                F.lit(chk.severity).alias("severity"), F.lit(None).cast("bigint").alias("failed_row_count"),
                                F.round(v, 4).alias("observed_value"), ok.alias("passed"),
                                F.lit(None).cast("string").alias("error")))
    for chk in checks:                              # Q10: missing column -> check error row
        if chk.column and chk.column not in present:
            structs.append(F.struct(F.lit(chk.label).alias("check_name"), F.lit(chk.column).alias("column_name"),
                                    F.lit(chk.severity).alias("severity"), F.lit(None).cast("bigint").alias("failed_row_count"),
                                    F.lit(None).cast("double").alias("observed_value"), F.lit(False).alias("passed"),
                                    F.lit(f"Column '{chk.column}' not found").alias("error")))
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def quarantine_split(df: DataFrame, checks: list[Check], run_ts: str,
                     severities: tuple[str, ...] = ("critical",)) -> tuple[DataFrame, DataFrame]:
    """Q14: (clean, quarantined).  Quarantined rows fail at least one check of the
    given severities; ``_quarantine_reason`` lists them as "check:column; ..." in
    check order, ``_quarantine_ts`` is the run timestamp.  Checks run on the raw
    rows; clean + quarantined = input."""
    flagged, row_cols = flag_rows(df, checks)
    sel = [(c, n) for c, n in row_cols if c.severity in severities]
    reasons = F.array_compact(F.array(*[F.when(F.col(n), F.lit(f"{c.name or c.kind}:{c.column}"))
                                        for c, n in sel])) if sel else F.array().cast("array<string>")
    tagged = flagged.withColumn("_reasons", reasons)
    base = [quoted(c) for c in df.columns]
    clean = tagged.where(F.size("_reasons") == 0).select(*base)
    quarantined = tagged.where(F.size("_reasons") > 0).select(
        *base, F.concat_ws("; ", "_reasons").alias("_quarantine_reason"),
        F.to_timestamp(F.lit(run_ts)).alias("_quarantine_ts"))
    return clean, quarantined


def split_counts(df: DataFrame, checks: list[Check], severities: tuple[str, ...] = ("critical",)) -> DataFrame:
    """Q14/Q16: clean and quarantined row counts in one aggregate (no second pass).  The checks of single rows are
    made before the duplicates are looked up, so a row is shuffled as its key and one flag."""
    present = set(df.columns)
    usable = [c for c in checks if c.kind in ROW_KINDS and c.column in present and c.severity in severities]
    uniq = sorted({c.column for c in usable if c.kind == "unique"})
    bad = F.lit(False)
    for c in usable:
        if c.kind != "unique":
            bad = bad | _row_fail(df, c)
    hashed = [quoted(c) for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    flagged = df.select(*uniq, bad.alias("__bad"), *([F.xxhash64(*hashed).alias("__row")] if uniq else []))
    flagged = with_duplicate_flags(flagged, uniq)
    bad = F.col("__bad")
    for c in uniq:
        bad = bad | F.col(_dup_col(c))
    return flagged.agg(F.count_if(~bad).alias("clean_rows"), F.count_if(bad).alias("quarantined_rows"))


def load_decision(total: Column, quarantined: Column, critical_failed: Column) -> list[Column]:
    """Q16: reject_all above 20 % quarantined, else quarantine_and_load / load_clean;
    alert above 10 % or when any critical check failed (fixed thresholds)."""
    share = F.round(F.try_divide(quarantined * 100.0, total.cast("double")), 1)
    decision = (F.when(share > 20, "reject_all").when(quarantined > 0, "quarantine_and_load")
                .otherwise("load_clean"))
    return [share.alias("quarantine_pct"), decision.alias("load_decision"),
            ((share > 10) | critical_failed).alias("alert_required")]


# ---------------------------------------------------------------------------
# Q1 profile, Q18 scorecard
# ---------------------------------------------------------------------------

def value_counts(df: DataFrame) -> DataFrame:
    """Q1: rows per (column, value as text), NULL a value like any other: one scan, combined map-side."""
    cols = df.columns
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_n"))


def profile(df: DataFrame) -> DataFrame:
    """Q1: per-column profile, one row per column (zero counts for a table without rows).

    null = NULL or blank; unique = distinct non-null values; numeric when more
    than half the rows parse as numbers, then min / max / mean / negatives.
    All of it comes from one count per (column, value), added up per column.
    """
    known = df.sparkSession.createDataFrame([(c, df.schema[c].dataType.simpleString()) for c in df.columns],
                                            "column_name string, dtype string")
    num, rows, nulls = F.col("_num"), F.col("total_rows"), F.col("null_count")
    per = (value_counts(df).withColumn("_num", parse_double("value")).groupBy("column_name").agg(
        F.sum("_n").alias("total_rows"), F.coalesce(F.sum(F.when(is_blank(F.col("value")), F.col("_n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("unique_count"), F.coalesce(F.sum(F.when(num.isNotNull(), F.col("_n"))), F.lit(0)).alias("_parsed"),
        F.min(num).alias("_min"), F.max(num).alias("_max"), F.sum(num * F.col("_n")).alias("_sum"),
        F.coalesce(F.sum(F.when(num < 0, F.col("_n"))), F.lit(0)).alias("_neg")))
    row = known.join(per, "column_name", "left").fillna(0, ["total_rows", "null_count", "unique_count", "_parsed", "_neg"])
    numeric = F.col("_parsed") > rows * 0.5
    return row.select(
        "column_name", "dtype", "total_rows", "null_count", pct_exact(nulls, rows, 1).alias("null_pct"),
        F.when(numeric, "numeric").otherwise("string").alias("inferred_type"),
        F.when(numeric, F.col("_min")).alias("min_value"), F.when(numeric, F.col("_max")).alias("max_value"),
        F.when(numeric, F.round(F.col("_sum") / F.col("_parsed"), 2)).alias("mean_value"),
        F.when(numeric, F.col("_neg")).alias("negative_count"), "unique_count",
        pct_exact(F.col("unique_count"), rows, 1).alias("uniqueness_pct"))


def top_values(df: DataFrame, k: int = 5) -> DataFrame:
    """Q1: the ``k`` most frequent non-blank values per column (ties: smaller text), with rank and share.
    Spark cuts each map task to ``k`` rows a column before the ranking's shuffle."""
    counts = value_counts(df)
    total = df.agg(F.count(F.lit(1))).scalar()
    w = Window.partitionBy("column_name").orderBy(F.desc("_n"), "value")
    return (counts.where(~is_blank(F.col("value"))).withColumn("value_rank", F.row_number().over(w))
            .where(F.col("value_rank") <= k).withColumn("_total", total)
            .select("column_name", "value_rank", "value", F.col("_n").alias("n"), pct_exact(F.col("_n"), F.col("_total"), 1).alias("share_pct")))


def pct_exact(num: Column, den: Column, digits: int) -> Column:
    """Half-up rounded percentage of two counts in integer arithmetic (exact)."""
    scale = 10 ** digits
    k = (num.cast("bigint") * (200 * scale) + den.cast("bigint")).cast("bigint")
    r = F.when(den > 0, F.floor(k / (den.cast("bigint") * 2)))
    return (r / F.lit(float(scale))).cast("double")


def completeness_pct(df: DataFrame) -> DataFrame:
    """Q1 summary: share of non-null cells, one row."""
    n_cols = len(df.columns)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("total_rows"), nulls.alias("null_cells")).select(
        "total_rows", F.lit(n_cols).alias("total_columns"),
        F.round((1 - F.col("null_cells") / (F.col("total_rows") * n_cols)) * 100, 1).alias("completeness_pct"))


def scorecard(df: DataFrame, run_date: str, required: list[str], key: str,
              null_columns: list[str]) -> DataFrame:
    """Q18: null rate (sum of nulls over ``null_columns`` / rows, fractions),
    duplicate rate, schema match, score = 100 - (null*40 + dup*40 + (1-schema)*20)
    clamped to 0..100; HALTED below 60; schema alert when schema fails but the
    score passes."""
    schema_match = 1 if set(required).issubset(df.columns) else 0
    present = [c for c in null_columns if c in df.columns]
    nulls = sum((F.count_if(F.col(c).isNull()) for c in present), F.lit(0))
    agg = df.agg(F.count(F.lit(1)).alias("_n"), nulls.alias("_nulls"),
                 F.countDistinct(key).alias("_d") if key in df.columns else F.lit(0).alias("_d"))
    null_rate = F.round(F.col("_nulls") / F.col("_n"), 6)
    dup_rate = F.round((F.col("_n") - F.col("_d")) / F.col("_n"), 6)
    score = F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0),
                    100 - (null_rate * 40 + dup_rate * 40 + (1 - schema_match) * 20))), 4)
    return agg.select(F.to_date(F.lit(run_date)).alias("run_date"), F.lit("ALL").alias("column_name"),
                      null_rate.alias("null_rate"), dup_rate.alias("duplicate_rate"),
                      F.lit(schema_match).alias("schema_match"), score.alias("overall_quality_score"),
                      F.when(score < 60, "HALTED").otherwise("SUCCESS").alias("pipeline_status"),
                      ((F.lit(schema_match) == 0) & (score >= 60)).alias("schema_alert"))


def column_null_rates(df: DataFrame, run_date: str) -> DataFrame:
    """Q18: null rate per column (NULL or blank), one aggregate turned into rows; an empty table has NULL rates."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(is_blank(F.col(c))).alias(f"_{i}") for i, c in enumerate(cols)])
    per = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(cols)])
    return row.select(F.to_date(F.lit(run_date)).alias("run_date"), "_n", F.inline(per)).select(
        "run_date", "column_name", "nulls", F.round(F.try_divide(F.col("nulls").cast("double"), F.col("_n")), 6).alias("null_rate"))


def load_decisions(df: DataFrame, checks: list[Check], by: str, severities: tuple[str, ...] = ("critical",)) -> DataFrame:
    """Q16 per part of a load (a day, a source): row checks in one grouped count, one decision a part."""
    flagged, row_cols = flag_rows(df, checks)
    bad = F.lit(False)
    for c, n in row_cols:
        if c.severity in severities:
            bad = bad | F.col(n)
    per = flagged.groupBy(by).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(bad).alias("quarantined_rows"))
    return per.select("*", *load_decision(F.col("total_rows"), F.col("quarantined_rows"), F.col("quarantined_rows") > 0))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Q19: raise with the missing set when required columns are absent."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


# ---------------------------------------------------------------------------
# A18 exact median without collecting a group: iterative bucket narrowing.
# ---------------------------------------------------------------------------

def _ranked_values(values: DataFrame, ks: list[int], lo: float, hi: float, below: int,
                   buckets: int, direct_max: int) -> dict[int, float]:
    """Values at 0-based ranks ``ks`` (adjacent ranks resolve together).

    Each round is one distributed pass: a width-bucket histogram (at most
    ``buckets`` + 1 rows, with per-bucket min/max) narrows [lo, hi] to the
    bucket holding the ranks.  Bucketing is monotone in v, so [bmin, bmax] of
    that bucket holds exactly its values.  Once that bucket has at most
    ``direct_max`` rows, its (value, count) pairs finish the search.  Ranks
    that land in different buckets are resolved separately.
    """
    out: dict[int, float] = {}
    while True:
        if lo == hi:
            return {k: lo for k in ks}
        sub = values.where((F.col("v") >= lo) & (F.col("v") <= hi))
        b = F.width_bucket(F.col("v"), F.lit(lo), F.lit(hi), F.lit(buckets))
        hist = sorted((r["b"], r["c"], r["bmin"], r["bmax"]) for r in sub.groupBy(b.alias("b")).agg(
            F.count(F.lit(1)).alias("c"), F.min("v").alias("bmin"), F.max("v").alias("bmax")).collect())
        start = below
        for _b, c, bmin, bmax in hist:
            if start + c > ks[0]:
                break
            start += c
        if start + c <= ks[-1]:                      # ranks split across buckets
            for k in ks:
                out.update(_ranked_values(values, [k], lo, hi, below, buckets, direct_max))
            return out
        below, lo, hi = start, bmin, bmax
        if c <= direct_max or lo == hi:
            pairs = sorted((r["v"], r["c"]) for r in values.where((F.col("v") >= lo) & (F.col("v") <= hi))
                           .groupBy("v").agg(F.count(F.lit(1)).alias("c")).collect())
            seen = below
            for v, cnt in pairs:
                for k in ks:
                    if seen <= k < seen + cnt:
                        out[k] = v
                seen += cnt
            return out


def exact_median(df: DataFrame, column: str, buckets: int = 4096, direct_max: int = 20_000):
    """Exact (interpolated) median of a numeric column -> (median or None, n).

    Spark's exact ``median`` keeps every distinct value of the group in one
    buffer; this version bounds each step by ``buckets``/``direct_max`` rows.
    The single value column is checkpointed once to the session checkpoint
    folder (lineage cut, survives executor loss) and re-read by each pass.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    values = df.select(F.expr(f"try_cast(`{column}` AS DOUBLE)").alias("v")).where(F.col("v").isNotNull())
    values = values.checkpoint(eager=True)
    st = values.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    n = st["n"]
    if not n:
        return None, 0
    k1, k2 = (n - 1) // 2, n // 2
    got = _ranked_values(values, sorted({k1, k2}), st["lo"], st["hi"], 0, buckets, direct_max)
    return (got[k1] + got[k2]) / 2.0, n


# ---------------------------------------------------------------------------
# Q15 auto-fix, Q20 normalisers, Q22-Q25 row rules, Q21 domain rules
# ---------------------------------------------------------------------------

def auto_fix(df: DataFrame, amount_col: str = "amount", date_col: str = "transaction_date",
             median: float | None = None) -> DataFrame:
    """Q15: fill blank amounts with the (exact) median, mark unparseable
    yyyy-MM-dd dates as INVALID_DATE, trim strings.  Adds ``_fixes``."""
    med = exact_median(df, amount_col)[0] if median is None else median
    blank_amt = is_blank(F.col(amount_col))
    parsed = F.expr(f"try_to_date(CAST(`{date_col}` AS STRING), 'yyyy-MM-dd')")
    bad_date = parsed.isNull() & F.col(date_col).isNotNull()
    out = df.withColumn("_fixes", F.array_compact(F.array(
        F.when(blank_amt, F.lit("null_amount_filled_with_median")),
        F.when(bad_date, F.lit("invalid_dates_marked")))))
    out = out.withColumn(amount_col, F.when(blank_amt, F.lit(med).cast("string")).otherwise(F.col(amount_col).cast("string")))
    out = out.withColumn(date_col, F.when(bad_date, F.lit("INVALID_DATE")).otherwise(F.col(date_col).cast("string")))
    for c, t in df.dtypes:
        if t == "string" and c not in (amount_col, date_col):
            out = out.withColumn(c, F.trim(F.col(c)))
    return out


def fix_log(fixed: DataFrame) -> DataFrame:
    """Q15: rows affected per fix that ``auto_fix`` noted."""
    return fixed.select(F.explode("_fixes").alias("fix")).groupBy("fix").agg(F.count(F.lit(1)).alias("rows_affected"))


# Date formats tried in order, currency aliases, valid codes.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "dd/MM/yyyy"]
CURRENCY_ALIASES = {"IND": "INR", "RS": "INR", "US$": "USD"}


def normalise(df: DataFrame, amount_col="amount", date_col="transaction_date", currency_col="currency",
              status_col="status") -> DataFrame:
    """Q20: comma amounts, date ladder (first format that parses), currency
    aliases, upper-case status.  Unparseable values become NULL (then flagged)."""
    amt = F.expr(f"try_cast(regexp_replace(CAST(`{amount_col}` AS STRING), ',', '') AS DECIMAL(18,2))")
    dates = [F.expr(f"try_to_date(CAST(`{date_col}` AS STRING), '{fmt}')") for fmt in DATE_FORMATS]
    out = df.withColumn(amount_col + "_norm", amt).withColumn(date_col + "_norm", F.coalesce(*dates))
    if currency_col in df.columns:
        cur = F.upper(F.trim(F.col(currency_col)))
        mapped = cur
        for k, v in CURRENCY_ALIASES.items():
            mapped = F.when(cur == k, F.lit(v)).otherwise(mapped)
        out = out.withColumn(currency_col + "_norm", mapped)
    if status_col in df.columns:
        out = out.withColumn(status_col + "_norm", F.upper(F.trim(F.col(status_col))))
    return out


def classify_issue(df: DataFrame, id_col="transaction_id", amount_col="amount", date_col="transaction_date",
                   currency_col="currency", status_col="status", name_col="merchant_name",
                   valid_currencies=("INR", "USD"), outlier_factor: float = 100.0) -> DataFrame:
    """Q20: first issue per row with severity H/M/L and auto-fixable flag
    (rules from the labelled rows: blank id, negative / zero amount, duplicate
    id, bad date, currency alias or unsupported, status casing, comma amount,
    blank merchant, outlier above ``outlier_factor`` x mean)."""
    n = normalise(df, amount_col, date_col, currency_col, status_col)
    mean = n.agg(F.avg(amount_col + "_norm")).scalar()
    raw_amt = F.col(amount_col).cast("string")
    rules = [
        (is_blank(F.col(id_col)), "blank transaction_id", "H", False),
        (F.col(amount_col + "_norm") < 0, "negative amount", "H", False),
        (None, "duplicate id", "H", False),
        (F.col(amount_col + "_norm") > mean * outlier_factor, "outlier amount", "H", False),
        (F.col(date_col + "_norm").isNull(), "invalid date", "H", True),
        (~F.col(date_col).cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$"), "non-standard date format", "M", True),
        (F.col(amount_col + "_norm") == 0, "zero amount", "M", False),
        (is_blank(F.col(name_col)), "blank merchant_name", "M", False),
        (raw_amt.contains(","), "comma in amount", "M", True),
    ]
    if currency_col in df.columns:
        rules += [(F.col(currency_col) != F.col(currency_col + "_norm"), "currency alias", "M", True),
                  (~F.coalesce(F.col(currency_col + "_norm").isin(*valid_currencies), F.lit(False)),
                   "unsupported currency", "M", True)]
    if status_col in df.columns:
        rules.append((F.col(status_col) != F.col(status_col + "_norm"), "status casing", "L", True))
    # the rules of single rows are tried before the duplicates are looked up: a row is shuffled with the number of its first
    first = F.lit(len(rules))
    for k, (cond, *_) in reversed(list(enumerate(rules))):
        if cond is not None:
            first = F.when(F.coalesce(cond, F.lit(False)), F.lit(k)).otherwise(first)
    dup = next(k for k, (cond, *_) in enumerate(rules) if cond is None)
    n = with_duplicate_flags(n.select(*[quoted(c) for c in df.columns], first.alias("__rule")), [id_col])
    rule = F.when(F.col(_dup_col(id_col)), F.least(F.col("__rule"), F.lit(dup))).otherwise(F.col("__rule"))
    n = n.withColumn("__rule", rule)
    pick = lambda at, kind: F.element_at(F.array(*[F.lit(r[at]) for r in rules], F.lit(None).cast(kind)), F.col("__rule") + 1)
    return n.select(*[quoted(c) for c in df.columns], pick(1, "string").alias("issue_found"), pick(2, "string").alias("severity"), pick(3, "boolean").alias("auto_fixable"))


def row_decision(df: DataFrame, as_of: str, valid_currencies=("INR", "USD", "EUR"),
                 flag_over: float = 500000.0, context_col: str | None = "note") -> DataFrame:
    """Q22: PASS / QUARANTINE (negative, unknown currency, date after as_of) /
    FLAG (above ``flag_over`` with no context note)."""
    amt = F.col("amount").cast("double")
    d = F.to_date(F.col("transaction_date"))
    ctx = is_blank(F.col(context_col)) if context_col and context_col in df.columns else F.lit(True)
    dec = (F.when(amt < 0, "QUARANTINE")
           .when(~F.coalesce(F.col("currency").isin(*valid_currencies), F.lit(False)), "QUARANTINE")
           .when(d > F.to_date(F.lit(as_of)), "QUARANTINE")
           .when((amt > flag_over) & ctx, "FLAG").otherwise("PASS"))
    return df.withColumn("decision", dec)


def outliers(df: DataFrame, col: str, factor: float = 3.0) -> DataFrame:
    """Q23: rows above ``factor`` x the column average (scalar average is one
    row, broadcast)."""
    avg = df.agg(F.avg(F.col(col))).scalar()
    return df.withColumn("is_outlier", F.col(col) > avg * factor)


def future_dated(df: DataFrame, date_col: str, as_of: str) -> DataFrame:
    """Q24: rows dated after ``as_of``."""
    return df.where(F.col(date_col) > F.to_date(F.lit(as_of)))


def repair_nulls(df: DataFrame, columns: list[str], value: str = "UNKNOWN") -> DataFrame:
    """Q25: NULL -> 'UNKNOWN', with a per-row count of repaired cells."""
    fixed = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    out = df.withColumn("_repaired_cells", fixed)
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(value)))
    return out


# Domain-impossibility rules (Q21), fixed values: UPI limit 100000, valid
# statuses COMPLETED / FAILED / PENDING.
UPI_LIMIT = 100000


def impossible_rows(txn: DataFrame, merchants: DataFrame, as_of: str) -> DataFrame:
    """Q21: one finding per (row, rule) with severity; union of rule filters."""
    known = merchants.select("merchant_id").distinct().withColumn("_known", F.lit(True))
    t = txn.join(known, "merchant_id", "left")
    rules = [
        ("UPI_OVER_LIMIT", "CRITICAL", (F.col("payment_method") == "UPI") & (F.col("amount") > UPI_LIMIT)),
        ("FUTURE_DATE", "CRITICAL", F.col("transaction_date") > F.to_date(F.lit(as_of))),
        ("INVALID_STATUS", "CRITICAL", ~F.coalesce(F.col("status").isin("COMPLETED", "FAILED", "PENDING"), F.lit(False))),
        ("ORPHAN_MERCHANT", "CRITICAL", F.col("_known").isNull()),
        ("ZERO_COMPLETED", "MINOR", (F.col("status") == "COMPLETED") & (F.col("amount") == 0)),
    ]
    findings = F.array_compact(F.array(*[
        F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity")))
        for r, s, cond in rules]))
    return (t.select("transaction_id", "merchant_id", "amount", "transaction_date", F.explode(findings).alias("f"))
            .select("transaction_id", "merchant_id", "amount", "transaction_date", "f.rule", "f.severity"))


def verdict(findings: DataFrame) -> DataFrame:
    """Q21: NOT SAFE if any CRITICAL finding."""
    return findings.agg(F.count(F.lit(1)).alias("issues"),
                        F.count_if(F.col("severity") == "CRITICAL").alias("critical")).withColumn(
        "verdict", F.when(F.col("critical") > 0, "NOT SAFE").otherwise("SAFE"))


# ---------------------------------------------------------------------------
# Q26 drift: categorical set drift + PSI on fixed bins
# ---------------------------------------------------------------------------

def psi(reference: DataFrame, current: DataFrame, col: str, lo: float, hi: float, bins: int = 10,
        floor: float = 1e-6) -> DataFrame:
    """Q26: population stability index over ``bins`` fixed-width bins on [lo, hi]
    (values outside clamp to the edge bins).  One grouped count per side, joined on
    bin; the total is the sum of a side's bins."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        raw = F.floor(F.lit(float(bins)) * (F.col(col).cast("double") - F.lit(lo)) / F.lit(hi - lo)) + 1
        b = F.least(F.greatest(raw, F.lit(1)), F.lit(bins)).cast("bigint")
        c = df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("_c"))
        total = F.sum("_c").over(Window.partitionBy())  # at most ``bins`` rows
        return c.select("bin", (F.col("_c") / total).alias(name))
    spine = reference.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    j = spine.join(shares(reference, "p_ref"), "bin", "left").join(shares(current, "p_cur"), "bin", "left")
    p = F.greatest(F.coalesce(F.col("p_ref"), F.lit(0.0)), F.lit(floor))
    q = F.greatest(F.coalesce(F.col("p_cur"), F.lit(0.0)), F.lit(floor))
    return j.agg(F.round(F.sum((q - p) * F.log(q / p)), 6).alias("psi"))


def categorical_drift(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Q26/U4: per categorical column, values new in current and values gone.

    Each side is read once: its columns become (column, value) rows, which are
    reduced to distinct ones with the sides that hold them.  NULL is a value like any other."""
    def values(df: DataFrame, side: int) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
        return df.select(F.inline(F.array(*pairs))).withColumn("_side", F.lit(side))

    sides = (values(reference, 1).unionByName(values(current, 2)).groupBy("column_name", "value")
             .agg(F.bit_or("_side").alias("_sides")))
    known = reference.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    out = known.join(sides, "column_name", "left").groupBy("column_name").agg(
        F.count_if(F.col("_sides") == 2).alias("new_values"), F.count_if(F.col("_sides") == 1).alias("missing_values"))
    return out.withColumn("drifted", (F.col("new_values") + F.col("missing_values")) > 0)


def claim_check(claims: DataFrame, actual: DataFrame, tolerance: float = 0.01, min_n: int = 30) -> DataFrame:
    """Q28: claims (metric, claimed_value) vs recomputed (metric, actual_value, n):
    VERIFIED within relative tolerance, MISLEADING when n < min_n, else WRONG."""
    j = claims.join(actual, "metric", "left")
    rel = F.abs(F.col("claimed_value") - F.col("actual_value")) / F.greatest(F.abs(F.col("actual_value")), F.lit(1e-9))
    return j.withColumn("verdict", F.when(F.col("actual_value").isNull(), "UNKNOWN")
                        .when(F.col("n") < min_n, "MISLEADING")
                        .when(rel <= tolerance, "VERIFIED").otherwise("WRONG"))


# ---------------------------------------------------------------------------
# A24 decision accuracy
# ---------------------------------------------------------------------------

def decision_accuracy(decisions: DataFrame, expected_col: str = "expected", got_col: str = "decision",
                      latency_col: str = "latency_ms", tokens_col: str = "tokens") -> DataFrame:
    """Share of correct decisions, total latency and tokens (one aggregate)."""
    return decisions.agg(
        F.round(F.avg(F.when(F.col(expected_col) == F.col(got_col), 1.0).otherwise(0.0)), 4).alias("accuracy"),
        F.count(F.lit(1)).alias("decisions"),
        F.sum(latency_col).alias("total_latency_ms"), F.sum(tokens_col).alias("total_tokens"))
