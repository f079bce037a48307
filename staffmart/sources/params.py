"""Report parameters (``dwh_rap_periode``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.config import REPORT_PACKAGE, ReportYears


def report_end_date(rap_periode: DataFrame, package: str = REPORT_PACKAGE):
    """The package's report end date. Exactly one row must exist (the warehouse silently took
    the last of several)."""
    rows = rap_periode.filter(F.col("package_naam") == package).select("rapport_einddatum").limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected exactly one report period row for {package!r}, found {len(rows)}")
    return rows[0][0]


def report_period(rap_periode: DataFrame, package: str = REPORT_PACKAGE):
    """End date and report years from one small job."""
    d = report_end_date(rap_periode, package)
    prev = d.replace(year=d.year - 1) if not (d.month == 2 and d.day == 29) else d.replace(year=d.year - 1, day=28)
    return d, ReportYears(current=d.year, previous=prev.year)
