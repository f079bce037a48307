"""Stored layouts that let the fact joins run without moving facts.

* :func:`store_bucketed`: facts and the contract dimension in the same buckets of the contract id.
  Their join, the only one between two large tables, then needs no exchange.
* :func:`store_by_month`: facts partitioned by month beside a stored calendar. A job that filters
  the calendar by anything (quarter, length, weekday count) prunes the months at run time, when
  Spark has read the calendar.
* :func:`store_analyzed`: all tables in the catalogue with their row counts (S13).

The jobs take the stored tables like any others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from staffmart.sources.tables import FACTS, NAMES, Tables

CONTRACT_TABLES = ("fact_fte_realisatie", "fact_fte_ziekteverzuim", "dim_dienstverbanden")
CONTRACT_KEY = "dienstverband_id"
BUCKETS = 64


def with_stored(t: Tables, stored: dict[str, DataFrame]) -> Tables:
    """The tables, some of them from their stored copies."""
    others: dict[str, Callable[[], DataFrame]] = {n: (lambda n=n: getattr(t, n)) for n in NAMES if t.has(n) and n not in stored}
    return Tables(**others, **stored)


def store_bucketed(t: Tables, base: str, prefix: str = "", buckets: int = BUCKETS) -> Tables:
    """Write facts and contracts in ``buckets`` buckets of the contract id, one sorted file each."""
    stored = {}
    for name in CONTRACT_TABLES:
        df = getattr(t, name)
        (df.repartition(buckets, CONTRACT_KEY).write.mode("overwrite").bucketBy(buckets, CONTRACT_KEY).sortBy(CONTRACT_KEY)
         .option("path", f"{base}/{prefix}{name}").saveAsTable(f"{prefix}{name}"))
        stored[name] = df.sparkSession.table(f"{prefix}{name}")
    return with_stored(t, stored)


def store_by_month(t: Tables, base: str, prefix: str = "", facts: Iterable[str] = FACTS) -> Tables:
    """Write the facts by month, and the calendar."""
    stored = {}
    for name in [*facts, "ref_datum"]:
        df = getattr(t, name)
        by = ["maand_id"] if name in FACTS else []
        rows = df.hint("rebalance", *by) if by else df.coalesce(1)
        rows.write.mode("overwrite").partitionBy(*by).option("path", f"{base}/{prefix}{name}").saveAsTable(f"{prefix}{name}")
        stored[name] = df.sparkSession.table(f"{prefix}{name}")
    return with_stored(t, stored)


def store_analyzed(t: Tables, base: str, prefix: str = "") -> dict[str, str]:
    """Write every table and its row count into the catalogue; returns their catalogue names."""
    out = {}
    for name, df in t.views().items():
        table = f"{prefix}{name}"
        df.write.mode("overwrite").option("path", f"{base}/{table}").saveAsTable(table)
        df.sparkSession.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        out[name] = table
    return out
