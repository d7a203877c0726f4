"""Spark-vs-DuckDB result comparison used by tests and ``check_oracle.py``.

Order-insensitive: columns are sorted by name, values normalised (floats
rounded, dates as ISO text), rows sorted, then compared.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
from dataclasses import dataclass

from ..sources.tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return tuple(_norm(x, digits) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return str(v)


def _rows(columns, rows, digits):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@dataclass
class Outcome:
    name: str
    ok: bool
    detail: str
    spark_rows: int
    oracle_rows: int


_SPARK_FAMILY = [("decimal", "DECIMAL"), ("bigint", "BIGINT"), ("smallint", "INT"), ("tinyint", "INT"),
                 ("int", "INT"), ("double", "DOUBLE"), ("float", "FLOAT"), ("string", "VARCHAR"),
                 ("timestamp", "TIMESTAMP"), ("date", "DATE"), ("boolean", "BOOLEAN"), ("array", "LIST")]
_DUCK_FAMILY = [("DECIMAL", "DECIMAL"), ("HUGEINT", "HUGEINT"), ("BIGINT", "BIGINT"), ("INTEGER", "INT"),
                ("SMALLINT", "INT"), ("DOUBLE", "DOUBLE"), ("FLOAT", "FLOAT"), ("VARCHAR", "VARCHAR"),
                ("TIMESTAMP", "TIMESTAMP"), ("DATE", "DATE"), ("BOOLEAN", "BOOLEAN"), ("[]", "LIST")]


def _family(t: str, table) -> str:
    for k, v in table:
        if (t.lower().startswith(k)) if table is _SPARK_FAMILY else (k in t.upper()):
            return v
    return t


def compare(name: str, spark_df, con, sql: str, digits: int = 6) -> Outcome:
    s_cols = spark_df.columns
    s_types = {f.name: _family(f.dataType.simpleString(), _SPARK_FAMILY) for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    o_cols = list(rel.columns)
    o_types = {c: _family(str(t), _DUCK_FAMILY) for c, t in zip(o_cols, rel.types)}
    o_rows = rel.fetchall()
    if sorted(s_cols) != sorted(o_cols):
        return Outcome(name, False, f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}",
                       len(s_rows), len(o_rows))
    bad = {c: (s_types[c], o_types[c]) for c in s_cols if s_types[c] != o_types[c]}
    if bad:
        return Outcome(name, False, f"type families differ: {bad}", len(s_rows), len(o_rows))
    if len(s_rows) != len(o_rows):
        return Outcome(name, False, "row counts differ", len(s_rows), len(o_rows))
    a, b = _rows(s_cols, s_rows, digits), _rows(o_cols, o_rows, digits)
    for x, y in zip(a, b):
        if x != y:
            return Outcome(name, False, f"first diff: spark={x} oracle={y} cols={sorted(s_cols)}",
                           len(s_rows), len(o_rows))
    return Outcome(name, True, "match", len(s_rows), len(o_rows))
