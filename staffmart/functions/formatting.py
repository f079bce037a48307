"""Display formatting used by the reports and chart datasets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staffmart.config import FORMAT_THOUSANDS
from staffmart.functions.columns import col


def thousands(c: str | Column) -> Column:
    """``format(x, '#,##0;-#,##0')``: rounds half away from zero first (``format_number`` alone
    rounds ties to even), then groups thousands."""
    return F.call_function("format_number", F.round(col(c), 0), F.lit(FORMAT_THOUSANDS))


def percent_2(cents: str | Column) -> Column:
    """``format(x, '0.00')`` of a percentage in hundredths (a whole number, rounded half up from
    exact figures), so that no tie is lost to a double."""
    return (col(cents).cast("decimal(16,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)").cast("string")


def report_decimal(c: str | Column, scale: int = 2) -> Column:
    """``cast(x as decimal(18, scale))`` for report cells."""
    return col(c).cast(f"decimal(18,{scale})")


def date_label(c: str | Column) -> Column:
    """``format(d, 'yyyy-MM-dd')``."""
    return F.date_format(col(c), "yyyy-MM-dd")


def datetime_label_12h(c: str | Column) -> Column:
    """``format(d, 'yyyy-MM-dd hh:mm')`` (12-hour clock, as in the original pattern)."""
    return F.date_format(col(c), "yyyy-MM-dd hh:mm")


def clamp(c: str | Column, lo: float = 0.0, hi: float = 100.0) -> Column:
    """``y < lo ? lo : y > hi ? hi : y`` (NULL stays NULL)."""
    v = col(c)
    return F.when(v < lo, F.lit(lo)).when(v > hi, F.lit(hi)).otherwise(v)


def with_unit(c: str | Column, decimals: int, unit: str) -> Column:
    """``v.toFixed(decimals) + unit`` (axis tick labels), rounded half up as a decimal."""
    return F.concat(report_decimal(c, decimals).cast("string"), F.lit(unit))


def day_label(c: str | Column) -> Column:
    """Time-axis label ``%m/%d``."""
    return F.date_format(col(c), "MM/dd")


def epoch_ms_to_ts(c: str | Column) -> Column:
    return F.timestamp_millis(col(c))


def date_to_epoch_ms(c: str | Column) -> Column:
    """Midnight UTC of a date in epoch milliseconds (independent of the session time zone)."""
    return F.unix_date(col(c)).cast("long") * F.lit(86_400_000)
