"""The personnel star schema as a bundle of DataFrames.

Jobs take a :class:`Tables` and never open files themselves, so the same job runs over fixtures,
over the synthetic binding (:mod:`staffmart.sources.binding`) or over catalogue tables
(:mod:`staffmart.sources.loaders`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.sources.schemas import SCHEMAS

FACTS = ("fact_fte_begroting", "fact_fte_realisatie", "fact_fte_ziekteverzuim")
NAMES = tuple(SCHEMAS)


class Tables:
    """Personnel tables by name, each a DataFrame or a function that opens it. A table is opened
    when a job first asks for it, so a job pays for no table it does not read. Tables that were not
    given are None."""

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame] | None):
        if unknown := set(tables) - set(NAMES):
            raise TypeError(f"no personnel tables: {sorted(unknown)}")
        self._given = {n: tables[n] for n in NAMES if tables.get(n) is not None}

    def __getattr__(self, name: str) -> DataFrame | None:
        if name not in NAMES:
            raise AttributeError(name)
        table = self._given.get(name)
        if callable(table):
            table = self._given[name] = table()
        return table

    def has(self, name: str) -> bool:
        return name in self._given

    def replace(self, **changes: DataFrame | Callable[[], DataFrame]) -> "Tables":
        return type(self)(**{**self._given, **changes})

    def for_periods(self, first_month: int, last_month: int) -> "Tables":
        """Restrict the facts to ``maand_id`` in [first, last].

        On stored fact tables ``maand_id`` is a column, so this range reaches the scan as a
        pushed filter (or prunes partitions when the fact is partitioned by month). Jobs keep
        their own period filters; this only avoids reading months no job will use.
        """
        cond = F.col("maand_id").between(first_month, last_month)
        return self.replace(**{n: (lambda n=n: getattr(self, n).filter(cond)) for n in FACTS if self.has(n)})

    def views(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in NAMES if self.has(n)}
