"""Small Column builders shared by the operators.

All of these compile to built-in Catalyst expressions, so they stay inside
whole-stage codegen.  ANSI mode is on in Spark 4: anything that may divide by
zero or parse junk goes through ``try_*``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Money is summed as DECIMAL(18,2) so totals are exact and engine-independent."""
    return col_(c).cast(MONEY)


def as_double(c: Column | str) -> Column:
    return col_(c).cast("double")


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """round(100 * num / NULLIF(den, 0), digits) as DOUBLE (NULL on zero denominator)."""
    n = col_(num).cast("double") * F.lit(100.0)
    return F.round(F.try_divide(n, col_(den).cast("double")), digits)


def pct_or_zero(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """Percentage that is 0.0 when the denominator is 0 (reference python rule)."""
    return F.coalesce(pct(num, den, digits), F.lit(0.0))


def avg_rate(c: Column | str, digits: int) -> Column:
    """Average of 2-decimal rates, exact: DECIMAL average (scale 6, HALF_UP) then
    rounded to ``digits``; float ties cannot flip between engines."""
    return F.round(F.avg(col_(c).cast("decimal(12,2)")), digits).cast("double")


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END) as BIGINT."""
    return F.count(F.when(cond, F.lit(1)))


def sum_when(cond: Column, value: Column | str, zero: bool = True) -> Column:
    """SUM(CASE WHEN cond THEN value ELSE 0 END)."""
    other = F.lit(0).cast(MONEY) if zero else F.lit(None)
    return F.sum(F.when(cond, col_(value)).otherwise(other))


def is_blank(c: Column | str) -> Column:
    """NULL or only whitespace: the reference counts blank strings as missing."""
    c = col_(c)
    return c.isNull() | (F.trim(c.cast("string")) == F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    c = col_(c)
    return F.when(is_blank(c), F.lit(None)).otherwise(c)


# --- boundary-crossing date differences (warehouse DATEDIFF semantics) -------
# Spark's timestampdiff counts whole elapsed units; the reference's warehouse
# counts calendar boundaries crossed.  These helpers give the latter.

def datediff_years(start: Column | str, end: Column | str) -> Column:
    return F.year(col_(end)) - F.year(col_(start))


def datediff_months(start: Column | str, end: Column | str) -> Column:
    s, e = col_(start), col_(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def datediff_days(start: Column | str, end: Column | str) -> Column:
    return F.datediff(F.to_date(col_(end)), F.to_date(col_(start)))


def _epoch_floor(c: Column, unit: str) -> Column:
    return F.unix_seconds(F.date_trunc(unit, col_(c).cast("timestamp")))


def datediff_minutes(start: Column | str, end: Column | str) -> Column:
    return ((_epoch_floor(col_(end), "minute") - _epoch_floor(col_(start), "minute")) / 60).cast("bigint")


def datediff_hours(start: Column | str, end: Column | str) -> Column:
    return ((_epoch_floor(col_(end), "hour") - _epoch_floor(col_(start), "hour")) / 3600).cast("bigint")


def ordinal(c: Column | str, order: list[str]) -> Column:
    """Map a code to its position in a custom order (T3); unknown codes sort last."""
    c = col_(c)
    expr = F.lit(len(order))
    for i, v in reversed(list(enumerate(order))):
        expr = F.when(c == F.lit(v), F.lit(i)).otherwise(expr)
    return expr


# Numeric text: optional sign, digits with optional fraction (or a bare
# fraction), optional exponent, surrounding blanks allowed.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def parse_double(c: Column | str) -> Column:
    """Lenient string -> DOUBLE (NULL when not a number).

    ``try_cast`` alone is correct but costs a JVM exception per malformed
    value; the shape test first keeps junk-heavy text columns on the fast path.
    """
    s = col_(c).cast("string")
    return F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double"))


def avg_cents_half_up(c: Column | str, digits: int = 6) -> Column:
    """Average of 2-decimal non-negative values, exact: sum in integer cents,
    rounded half-up to ``digits`` with integer division (no float ties)."""
    cents = F.round(col_(c) * 100).cast("bigint")
    s, n = F.sum(cents), F.count(cents)
    scale = 10 ** (digits - 2)
    num = s * F.lit(2 * scale) + n
    return F.when(n > 0, F.floor(num.cast("decimal(38,0)") / (n * 2).cast("decimal(38,0)"))) \
        / F.lit(float(10 ** digits))
