"""Repair rounds over a catalogue, each attempt a committed row set and state rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import path_exists
from .quality import Check, is_blank, quarantine_split, run_suite

ACTIONS = ("add_column", "cast_column", "fill_default", "drop_bad_rows")     # also their order within an attempt
STATE = ("attempt int, check_name string, column_name string, action string, failed_before bigint, "
         "rows_changed bigint, rows_after bigint")
FINAL = ("validated", "unresolved")


def _cast(column: str, to: str) -> Column:
    """Thousands commas go; what still isn't a ``to`` becomes NULL."""
    return F.expr(f"try_cast(replace(CAST(`{column}` AS STRING), ',', '') AS {to})")


def _cast_changes(column: str, to: str) -> Column:
    """Rows that a cast makes readable, and rows with text that it makes NULL."""
    before, after = F.expr(f"try_cast(CAST(`{column}` AS STRING) AS {to})"), _cast(column, to)
    return (before.isNull() & after.isNotNull()) | (~is_blank(F.col(column)) & after.isNull())


def repair_loop(df: DataFrame, checks: list[Check], catalogue: dict[tuple[str, str], list[tuple[str, object]]],
                root: str, max_attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """(repaired rows, state).  ``catalogue`` lists per (check, column) the (action, argument) pairs to try, one an
    attempt; a check that has used up its own is escalated.  An attempt runs the suite, repairs every failing check
    that has an action left, and writes rows, then state, under ``root`` (a shared folder): both are read back by
    the next one (the rows of the first are written as attempt 0: their plan runs once, not once a scan), so lineage stays short and a run cut off goes on after the last attempt whose state was written.

    State columns: attempt, check, column, action, rows failing before (NULL if the column is missing), rows
    changed, rows left.  The last row says ``validated`` or ``unresolved`` (no action left, or no attempt left).
    An empty table passes what holds for no rows; extra columns are kept as they are."""
    spark = df.sparkSession

    def rows_of(attempt: int) -> str:
        return f"{root.rstrip('/')}/rows/{attempt}"

    def state_of(attempt: int) -> str:
        return f"{root.rstrip('/')}/state/{attempt}"

    done = 0
    while path_exists(spark, state_of(done + 1) + "/_SUCCESS"):
        done += 1
    log = [r for a in range(1, done + 1) for r in spark.read.schema(STATE).parquet(state_of(a)).collect()]
    if not done:
        df.write.mode("overwrite").parquet(rows_of(0))
    cur = spark.read.parquet(rows_of(done))
    by_name = {(c.label, c.column): c for c in checks}
    attempt = done
    while not any(r.action in FINAL for r in log):
        attempt += 1
        failing = [r for r in run_suite(cur, checks).collect() if not r.passed]
        todo, news = [], []
        for r in failing:
            name = (r.check_name, r.column_name)
            used = sum((s.check_name, s.column_name) == name for s in log)
            steps = catalogue.get(name, [])
            if used < len(steps) and attempt <= max_attempts:
                todo.append((r, *steps[used]))
            elif used == len(steps):
                news.append((attempt, *name, "escalate", r.failed_row_count, 0))
        casts = {r.column_name: F.count_if(_cast_changes(r.column_name, arg)) for r, action, arg in todo if action == "cast_column"}
        blanks = {r.column_name: F.count_if(is_blank(F.col(r.column_name)))
                  for r, action, _ in todo if action == "fill_default" and r.column_name in cur.columns}
        counts = cur.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(f"cast {n}") for n, c in casts.items()],
                         *[c.alias(f"fill {n}") for n, c in blanks.items()]).first()
        drops = []
        for r, action, arg in sorted(todo, key=lambda t: ACTIONS.index(t[1])):
            c, changed = r.column_name, r.failed_row_count
            if action == "add_column":
                cur, changed = cur.withColumn(c, F.lit(None).cast(arg)), counts["rows"]
            elif action == "cast_column":
                cur, changed = cur.withColumn(c, _cast(c, arg)), counts[f"cast {c}"]
            elif action == "fill_default":
                cur, changed = cur.withColumn(c, F.when(is_blank(F.col(c)), F.lit(arg)).otherwise(F.col(c))), counts[f"fill {c}"]
            else:
                drops.append(by_name[r.check_name, c])
            news.append((attempt, r.check_name, c, action, r.failed_row_count, changed))
        if todo:
            if drops:
                cur, _bad = quarantine_split(cur, drops, "1970-01-01 00:00:00", tuple({c.severity for c in drops}))
            cur.write.mode("overwrite").parquet(rows_of(attempt))
            left = spark.read.parquet(rows_of(attempt)).count()
        else:
            news.append((attempt, None, None, "unresolved" if failing else "validated", len(failing), 0))
            left = counts["rows"]
            cur.write.mode("overwrite").parquet(rows_of(attempt))
        rows = spark.createDataFrame([(*n, left) for n in news], STATE)
        rows.coalesce(1).write.mode("overwrite").parquet(state_of(attempt))
        log += rows.collect()
        cur = spark.read.parquet(rows_of(attempt))
    return cur, spark.read.schema(STATE).parquet(*[state_of(a) for a in range(1, attempt + 1)])
