"""The FTE mart (C5-C7) and its year-to-date columns.

Plan shape at scale:

* Actual and sick facts are projected to one schema with zero-filled measures and stacked *before*
  they are joined, so each dimension is joined once (:func:`staging.actual_and_sick_rows`); budget
  rows (C7) are stacked on the result. One hash aggregation (partial on the map side, one exchange
  on the mart key) then replaces three aggregations plus a full outer join.
* The year-to-date sums are one window over (employee, cost centre, function, year) ordered by
  month. After aggregation a window partition holds at most 12 rows, so a hot employee or cost
  centre cannot skew it; the triangular self-join of the warehouse load is kept only as
  :func:`ytd_by_self_join` for cross-checking.
* Days stay exact decimals through every sum. FTE is days over the month's length, divided once
  per mart row (a row lies in one month) and kept as ``decimal(18,8)``, like the published columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffmart.config import MART_KEYS, UNKNOWN, MartOptions, ReportYears
from staffmart.functions.columns import fte, monthly_average, zero_decimal
from staffmart.operators.staging import actual_and_sick_rows, budget_rows
from staffmart.sources.tables import Tables

DAYS = ("begroot_dagen", "dagen_ziek_ex_zwanger", "dienstverband_dagen")
MEASURES = ("fte_begroot", "fte_realisatie", "dagen_ziek_ex_zwanger", "dienstverband_dagen")


def _stackable(df: DataFrame, periode, medewerker, kostenplaats, functie, **measures) -> DataFrame:
    zero = zero_decimal(18, 6)
    cols = [
        F.col(periode).cast("string").alias("periode") if isinstance(periode, str) else periode.alias("periode"),
        F.col(medewerker).cast("string").alias("medewerker_id") if isinstance(medewerker, str) else medewerker.alias("medewerker_id"),
        F.col(kostenplaats).alias("kostenplaats_code"),
        F.col(functie).alias("functie_code"),
        F.col("aantal_dagen_maand"),
    ]
    for m in DAYS:
        cols.append((F.col(measures[m]) if m in measures else zero).cast("decimal(18,6)").alias(m))
    return df.select(*cols)


Passing = Callable[[DataFrame], DataFrame]     # rows on their way, observed


def stacked_rows(t: Tables, years: ReportYears, opts: MartOptions = MartOptions(), watch: Passing = lambda df: df) -> DataFrame:
    """Actual and sick rows (and budget rows when ``include_budget``) in one schema."""
    parts = [
        _stackable(watch(actual_and_sick_rows(t, years, opts)), "periode", "medewerker_id", "kostenplaats_code", "functiecode",
                   dienstverband_dagen="dienstverband_dagen", dagen_ziek_ex_zwanger="dagen_ziek_ex_zwanger"),
    ]
    if opts.include_budget:
        # The dormant budget insert carries no employee; it lands on the unknown member.
        parts.append(
            _stackable(budget_rows(t, years, opts), "maand_id", F.lit(UNKNOWN), "kostenplaats_code",
                       "medewerker_functie_code", begroot_dagen="begroot_dagen")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def day_sums(rows: DataFrame) -> DataFrame:
    """Stacked rows summed to one row per year, month, employee, cost centre and function: the
    mart's additive part."""
    return rows.groupBy(
        F.substring("periode", 1, 4).alias("jaar"),
        F.substring("periode", -2, 2).alias("maand"),
        "medewerker_id",
        "kostenplaats_code",
        "functie_code",
    ).agg(*[F.sum(m).alias(m) for m in DAYS], F.max("aantal_dagen_maand").alias("aantal_dagen_maand"), F.count(F.lit(1)).alias("feiten"))


def mart_totals(t: Tables, years: ReportYears, opts: MartOptions = MartOptions(), watch: Passing = lambda df: df) -> DataFrame:
    """C5 without YTD: one row per year, month, employee, cost centre and function."""
    return measures(day_sums(stacked_rows(t, years, opts, watch)))


def measures(sums: DataFrame) -> DataFrame:
    """The mart's measures from the additive sums."""
    return sums.select(
        "jaar", "maand", "medewerker_id", "kostenplaats_code", "functie_code",
        fte("begroot_dagen", "aantal_dagen_maand").alias("fte_begroot"),
        fte("dienstverband_dagen", "aantal_dagen_maand").alias("fte_realisatie"),
        "dagen_ziek_ex_zwanger",
        "dienstverband_dagen",
    )


def with_ytd(mart: DataFrame) -> DataFrame:
    """Running sums per (employee, cost centre, function, year) up to the row's month.

    Rows whose key has a NULL never match in an equality join, so the warehouse left them at
    their initial values (own FTE, zero days); the ``keys_ok`` guard keeps that.
    """
    w = Window.partitionBy(*MART_KEYS).orderBy("maand").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys_ok = F.lit(True)
    for k in MART_KEYS:
        keys_ok = keys_ok & F.col(k).isNotNull()
    zero = zero_decimal(38, 6)
    return mart.select(
        "*",
        F.when(keys_ok, F.sum("fte_realisatie").over(w)).otherwise(F.col("fte_realisatie")).alias("fte_realisatie_ytd"),
        F.when(keys_ok, F.sum("dagen_ziek_ex_zwanger").over(w)).otherwise(zero).alias("dagen_ziek_ex_zwanger_ytd"),
        F.when(keys_ok, F.sum("dienstverband_dagen").over(w)).otherwise(zero).alias("dienstverband_dagen_ytd"),
    )


def ytd_by_self_join(mart: DataFrame) -> DataFrame:
    """The warehouse's triangular self-join form of :func:`with_ytd` (for checks only).

    It pairs every month with every earlier month of the same key. The input is the aggregated
    mart, unique per (key, year, month), so a key-year has at most 12 rows and at most 78 pairs
    however the facts are skewed; NULL keys never match, as in the original."""
    a = mart.alias("a")
    b = mart.alias("b")
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in MART_KEYS] + [F.col("a.maand") >= F.col("b.maand")]
    sums = (
        a.join(b, cond)
        .groupBy(*[F.col(f"a.{k}").alias(k) for k in MART_KEYS], F.col("a.maand").alias("maand"))
        .agg(
            F.sum("b.fte_realisatie").alias("fte_realisatie_ytd"),
            F.sum("b.dagen_ziek_ex_zwanger").alias("dagen_ziek_ex_zwanger_ytd"),
            F.sum("b.dienstverband_dagen").alias("dienstverband_dagen_ytd"),
        )
    )
    zero = zero_decimal(38, 6)
    return mart.join(sums, [*MART_KEYS, "maand"], "left").select(
        *mart.columns,
        F.coalesce("fte_realisatie_ytd", "fte_realisatie").alias("fte_realisatie_ytd"),
        F.coalesce("dagen_ziek_ex_zwanger_ytd", zero).alias("dagen_ziek_ex_zwanger_ytd"),
        F.coalesce("dienstverband_dagen_ytd", zero).alias("dienstverband_dagen_ytd"),
    )


def fte_mart(t: Tables, years: ReportYears, opts: MartOptions = MartOptions(), watch: Passing = lambda df: df) -> DataFrame:
    """C6 with exact measures: mart rows plus the undivided year-to-date sums."""
    return with_ytd(mart_totals(t, years, opts, watch))


def display(mart: DataFrame, with_load_time: bool = False) -> DataFrame:
    """W2 and the published column set: YTD sums divided by the month number (the year-to-date
    monthly average). FTE and averages are ``decimal(18,8)``, days ``decimal(18,6)``."""
    days = lambda c: F.col(c).cast("decimal(18,6)").alias(c)
    cols = [
        "jaar", "maand", "medewerker_id", "kostenplaats_code", "functie_code",
        "fte_begroot",
        "fte_realisatie",
        monthly_average("fte_realisatie_ytd", "maand").alias("fte_realisatie_cum"),
        days("dagen_ziek_ex_zwanger"),
        days("dienstverband_dagen"),
        monthly_average("dagen_ziek_ex_zwanger_ytd", "maand").alias("dagen_ziek_ex_zwanger_cum"),
        monthly_average("dienstverband_dagen_ytd", "maand").alias("dienstverband_dagen_cum"),
    ]
    if with_load_time:
        cols.append(F.current_timestamp().alias("loaddatime"))
    return mart.select(*cols)


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as the nearest doubles, for consumers without decimals."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema.fields])


def fte_mart_plain(t: Tables, years: ReportYears, opts: MartOptions = MartOptions()) -> DataFrame:
    """C5 as first published, before the YTD update: cum columns hold their initial values."""
    m = mart_totals(t, years, opts)
    zero = zero_decimal()
    return m.select(
        "jaar", "maand", "medewerker_id", "kostenplaats_code", "functie_code",
        "fte_begroot",
        "fte_realisatie",
        F.col("fte_realisatie").alias("fte_realisatie_cum"),
        F.col("dagen_ziek_ex_zwanger").cast("decimal(18,6)").alias("dagen_ziek_ex_zwanger"),
        F.col("dienstverband_dagen").cast("decimal(18,6)").alias("dienstverband_dagen"),
        zero.alias("dagen_ziek_ex_zwanger_cum"),
        zero.alias("dienstverband_dagen_cum"),
    )
