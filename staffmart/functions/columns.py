"""Column expressions shared by the jobs (all built-in functions, so they stay in codegen)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from staffmart.config import UNKNOWN


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unknown_member(c: str | Column, label: str = UNKNOWN) -> Column:
    """``isnull(cast(c as varchar), 'Onbekend')`` with the full label (no char truncation)."""
    return F.coalesce(col(c).cast("string"), F.lit(label))


def not_in(c: str | Column, values: Iterable[str]) -> Column:
    """SQL ``c NOT IN (...)``: NULL yields NULL, so a filter or join condition drops the row."""
    return ~col(c).isin(list(values))


def not_in_or_null(c: str | Column, values: Iterable[str], null_as: str = "") -> Column:
    """``isnull(c, '') NOT IN (...)``: NULL passes unless ``null_as`` is listed."""
    return ~F.coalesce(col(c), F.lit(null_as)).isin(list(values))


def period_key(year: str | Column, month: str | Column) -> Column:
    """``cast(jaar as varchar(4)) + right('00' + cast(maand as varchar(2)), 2)`` -> 'YYYYMM'."""
    return F.concat(col(year).cast("string"), F.lpad(col(month).cast("string"), 2, "0"))


def in_years(month_id: str | Column, years: Iterable[int]) -> Column:
    """``left(maand_id, 4) IN (years)`` as an integer range per year, which parquet can push down."""
    cond = None
    for y in sorted(set(years)):
        part = col(month_id).between(y * 100 + 1, y * 100 + 12)
        cond = part if cond is None else cond | part
    return cond


def fte(days: str | Column, days_in_month: str | Column) -> Column:
    """``days / days_in_month`` as ``decimal(18,8)``, rounded half up.

    Days are summed exactly first: all rows of a month share its length, so one division per
    group gives what dividing every row would, without its rounding. A missing or zero length
    yields NULL instead of a divide-by-zero error; ``zero_denominators`` counts those months.
    """
    dim = col(days_in_month)
    return F.when(dim > 0, (col(days).cast("decimal(24,6)") / dim.cast("decimal(10,0)")).cast("decimal(18,8)"))


def monthly_average(ytd: str | Column, month: str | Column) -> Column:
    """A year-to-date sum over the month number as ``decimal(18,8)``; NULL for month 0."""
    m = col(month).cast("int")
    return F.when(m > 0, (col(ytd).cast("decimal(24,8)") / m.cast("decimal(10,0)")).cast("decimal(18,8)"))


def ratio_pct(numerator: str | Column, denominator: str | Column) -> Column:
    """``(sum(a) / sum(b)) * 100`` on doubles; NULL when the denominator is 0 or NULL."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double")) * F.lit(100.0)


def zero_decimal(precision: int = 18, scale: int = 8) -> Column:
    """Typed zero (``@placeholder decimal(18,8)``)."""
    return F.lit(0).cast(f"decimal({precision},{scale})")
