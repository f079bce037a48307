"""Month pivots (A6-A8): one conditional aggregation per pivot, and exact per-row percentage
rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffmart.functions.columns import col

MONTHS = list(range(1, 13))


def monthly_sums(df: DataFrame, group_cols: Sequence[str], month_col: str, value_cols: Sequence[str]) -> DataFrame:
    """``sum(CASE WHEN month = k THEN v END)`` for every value column and month, named
    ``<v>_<k>``, in one aggregation. Ratios and labels are computed on the sums afterwards, so a
    month pivot of ratios needs no second aggregation. A month without rows sums to NULL."""
    month = F.col(month_col)
    cells = [F.sum(F.when(month == m, F.col(v))).alias(f"{v}_{m}") for v in value_cols for m in MONTHS]
    return df.groupBy(*group_cols).agg(*cells)


def sums_by_cost_centre(mart: DataFrame, sums: Sequence[str], *more: Column) -> DataFrame:
    """The mart summed to (cost centre, year, month), the grain of every lookup join: joins and
    labels then touch a few rows per cost centre, however large the mart is."""
    return mart.groupBy("kostenplaats_code", "jaar", "maand").agg(*[F.sum(c).alias(c) for c in sums], *more)


def pct_cents_half_up(numerator: str | Column, denominator: str | Column) -> Column:
    """``cast((a / b) * 100 as decimal(18,2))`` for exact decimal inputs with scale <= 6, rounded
    half away from zero by a whole-number division, so no intermediate rounding can move a tie.

    Returns the percentage in hundredths as a long; NULL when ``b`` is not positive.
    """
    a, b = col(numerator).cast("decimal(28,6)"), col(denominator).cast("decimal(28,6)")
    quotient = F.call_function("div", F.abs(a) * F.lit(20_000) + b, b * F.lit(2))
    return F.when(b > 0, F.signum(a).cast("long") * quotient)


def cents_as_decimal(cents: str | Column) -> Column:
    """Hundredths (a long) as ``decimal(18,2)``."""
    return (col(cents).cast("decimal(16,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")
