"""Control totals and absence / FTE reports over the mart.

Every report first sums the mart to (cost centre, year, month) and only then joins the division
lookup, so joins and labels touch a few rows per cost centre whatever the mart's size, and no
hint or size switch is needed. Totals are aggregated, never collected; where a total and
per-division rows come from the same figures, one aggregation produces both.

Report cells are ``decimal(18,2)``, rounded half up on exact figures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.config import (
    FTE_TOTAL_LABEL,
    MONTH_LABELS_ABSENCE,
    MONTH_LABELS_SHORT,
    ROWPCT_TOTAL_LABEL,
    TOTAL_LABEL,
    MartOptions,
    ReportYears,
)
from staffmart.functions.columns import ratio_pct
from staffmart.functions.formatting import percent_2, report_decimal, thousands
from staffmart.operators.pivots import MONTHS, cents_as_decimal, monthly_sums, pct_cents_half_up, sums_by_cost_centre
from staffmart.operators.publish import update_from
from staffmart.sources.tables import Tables

ABSENCE_COLUMNS = tuple(label.lower().replace(" ", "_") for label in MONTH_LABELS_ABSENCE)
FTE_COLUMNS = tuple(label.lower() for label in MONTH_LABELS_SHORT)

ABSENCE_SUMS = ("dagen_ziek_ex_zwanger", "dienstverband_dagen", "dagen_ziek_ex_zwanger_ytd", "dienstverband_dagen_ytd")


def divisions(lookup: DataFrame) -> DataFrame:
    """Cost centre -> division."""
    return lookup.select("kostenplaats_code", "zorgbedrijf")


# --------------------------------------------------------------------------- R1 / R2
def control_total(mart: DataFrame) -> DataFrame:
    """Yearly sick days, employment days and absence %, formatted as in the control query."""
    g = mart.groupBy("jaar").agg(
        F.sum("dagen_ziek_ex_zwanger").alias("ziek"), F.sum("dienstverband_dagen").alias("dagen")
    )
    return g.select(
        F.lit(TOTAL_LABEL).alias("divisie"),
        "jaar",
        thousands("ziek").alias("dagen_ziek_ex_zwanger"),
        thousands("dagen").alias("dienstverband_dagen"),
        percent_2(pct_cents_half_up("ziek", "dagen")).alias("verzuim_ex_zwanger"),
    ).orderBy("jaar", "divisie")


def control_division(mart: DataFrame, lookup: DataFrame, years: ReportYears, division: str) -> DataFrame:
    """R2: R1 per month for one division and the two report years, plus summed actual FTE."""
    m = mart.filter(F.col("jaar").isin([str(y) for y in years.both]))
    sums = sums_by_cost_centre(m, ("dagen_ziek_ex_zwanger", "dienstverband_dagen", "fte_realisatie"))
    g = (
        sums.join(divisions(lookup).filter(F.col("zorgbedrijf") == division), "kostenplaats_code")
        .groupBy("zorgbedrijf", "jaar", "maand")
        .agg(
            F.sum("dagen_ziek_ex_zwanger").alias("ziek"),
            F.sum("dienstverband_dagen").alias("dagen"),
            F.sum("fte_realisatie").alias("fte_realisatie"),
        )
    )
    return g.select(
        "zorgbedrijf",
        "jaar",
        "maand",
        thousands("ziek").alias("dagen_ziek_ex_zwanger"),
        thousands("dagen").alias("dienstverband_dagen"),
        percent_2(pct_cents_half_up("ziek", "dagen")).alias("verzuim_ex_zwanger"),
        F.col("fte_realisatie").cast("decimal(28,8)").alias("fte_realisatie"),
    ).orderBy("jaar", "maand")


# --------------------------------------------------------------------------- R3 / R4
def with_total_and_divisions(sums: DataFrame, lookup: DataFrame, total_label: str = TOTAL_LABEL) -> DataFrame:
    """Label each cost centre's sums with the total plus each division it maps to.

    One aggregation on ``divisie`` then yields the total (every row, including cost centres
    without a lookup row or with a NULL code) and the per-division figures of an inner join
    (a cost centre listed twice counts twice there, once in the total). ``sums`` is already at
    cost-centre grain, so the labels multiply a handful of rows.
    """
    groups = lookup.groupBy("kostenplaats_code").agg(
        F.collect_list(F.struct(F.col("zorgbedrijf").alias("divisie"))).alias("_divisies")
    )
    total = F.array(F.struct(F.lit(total_label).alias("divisie")))
    labels = F.when(F.col("_divisies").isNull(), total).otherwise(F.concat(total, F.col("_divisies")))
    j = sums.join(groups, "kostenplaats_code", "left")
    return j.select("*", F.explode(labels).alias("_label")).select(
        F.col("_label.divisie").alias("divisie"), *[c for c in sums.columns if c != "kostenplaats_code"]
    )


def _absence_sums(mart: DataFrame, lookup: DataFrame) -> DataFrame:
    labelled = with_total_and_divisions(sums_by_cost_centre(mart, ABSENCE_SUMS), lookup)
    return labelled.groupBy("divisie", "jaar", "maand").agg(*[F.sum(c).alias(c) for c in ABSENCE_SUMS])


def absence_monthly(mart: DataFrame, lookup: DataFrame) -> DataFrame:
    """Month and year-to-date absence % for the whole organisation and per division.

    The total covers every mart row; divisions come from an inner join, so cost centres without
    a lookup row (e.g. 'Onbekend') count only in the total. ``zvc`` is the ratio of the summed
    year-to-date averages; within a month the divisor is the same for every row and cancels.
    """
    return _absence_sums(mart, lookup).select(
        "divisie",
        "jaar",
        "maand",
        ratio_pct("dagen_ziek_ex_zwanger", "dienstverband_dagen").alias("zv"),
        ratio_pct("dagen_ziek_ex_zwanger_ytd", "dienstverband_dagen_ytd").alias("zvc"),
    )


def absence_pivot(mart: DataFrame, lookup: DataFrame, years: ReportYears) -> DataFrame:
    """R4 (flagship): R3 as twelve month columns, one row per division, year and measure.

    The monthly figures are unpivoted into (bron, waarde) and pivoted once with twelve
    conditional ``max`` cells, so both measures share one pass. The second measure is labelled
    'zvc' (the original labelled both 'zv'). Cells are ``decimal(18,2)``; months without rows
    stay NULL.
    """
    sums = _absence_sums(mart.filter(F.col("jaar").cast("int").isin(list(years.both))), lookup)
    monthly = sums.select(
        "divisie",
        "jaar",
        "maand",
        pct_cents_half_up("dagen_ziek_ex_zwanger", "dienstverband_dagen").alias("zv"),
        pct_cents_half_up("dagen_ziek_ex_zwanger_ytd", "dienstverband_dagen_ytd").alias("zvc"),
    )
    long = monthly.unpivot(["divisie", "jaar", "maand"], ["zv", "zvc"], "bron", "waarde")
    month = F.col("maand").cast("int")
    cells = [cents_as_decimal(F.max(F.when(month == k, F.col("waarde")))).alias(n) for k, n in zip(MONTHS, ABSENCE_COLUMNS)]
    return (
        long.groupBy(F.col("divisie").alias("zorgbedrijf"), "jaar", "bron")
        .agg(*cells)
        .orderBy("zorgbedrijf", "jaar", "bron")
    )


def seasonal_days(t: Tables, opts: MartOptions, months: Sequence[int]) -> DataFrame:
    """Employment days per year over some calendar months of every year. The months are chosen on
    the calendar alone; on facts stored by month (``layout.store_by_month``) Spark prunes the others
    at run time."""
    cal = t.ref_datum.filter(F.col("maandnummer").isin(list(months)))
    facts = t.fact_fte_realisatie.filter(F.col("groepering_id") == opts.budget_group)
    return (facts.join(cal.select("maand_id", "jaar"), "maand_id").groupBy("jaar")
            .agg(F.count(F.lit(1)).alias("rijen"), F.sum("dienstverband_dagen").alias("dienstverband_dagen")).orderBy("jaar"))


# --------------------------------------------------------------------------- R5 / R6
def _division_sums(mart: DataFrame, lookup: DataFrame, year: int, sums: tuple[str, ...]) -> DataFrame:
    """Cost-centre sums of one year with their (non-NULL) division; month as a number."""
    return (
        sums_by_cost_centre(mart.filter(F.col("jaar") == str(year)), sums)
        .join(divisions(lookup).filter(F.col("zorgbedrijf").isNotNull()), "kostenplaats_code")
        .withColumn("maand", F.col("maand").cast("int"))
    )


def _fte_cells(rows: DataFrame, group_cols: list[str]) -> DataFrame:
    sums = monthly_sums(rows, group_cols, "maand", ["fte_realisatie"])
    return sums.select(
        *group_cols,
        *[report_decimal(F.coalesce(f"fte_realisatie_{k}", F.lit(0))).alias(n) for k, n in zip(MONTHS, FTE_COLUMNS)],
    )


def fte_pivot(mart: DataFrame, lookup: DataFrame, year: int) -> DataFrame:
    """Actual FTE per division (with a division) x 12 months of one year; missing -> 0."""
    return _fte_cells(_division_sums(mart, lookup, year, ("fte_realisatie",)), ["zorgbedrijf", "jaar"]).orderBy("zorgbedrijf")


def fte_pivot_with_total(mart: DataFrame, lookup: DataFrame, year: int) -> DataFrame:
    """R5 plus a total row over the same join. Each joined row is counted under its division
    and under the total label in the same aggregation (exact decimals)."""
    rows = _division_sums(mart, lookup, year, ("fte_realisatie",))
    labels = F.array(F.col("zorgbedrijf"), F.lit(FTE_TOTAL_LABEL))
    both = rows.select(F.explode(labels).alias("zorgbedrijf"), "jaar", "maand", "fte_realisatie")
    return _fte_cells(both, ["zorgbedrijf", "jaar"]).orderBy("zorgbedrijf")


# --------------------------------------------------------------------------- R7-R10
def _row_pct(mart: DataFrame) -> DataFrame:
    return mart.withColumn("cents", F.coalesce(pct_cents_half_up("dagen_ziek_ex_zwanger", "dienstverband_dagen"), F.lit(0)))


def absence_rowpct_pivot(mart: DataFrame, lookup: DataFrame, year: int) -> DataFrame:
    """Per division x month, the sum of per-row absence % (each row rounded to 2 decimals,
    rows without employment days count 0). Rows are rounded and summed before any join."""
    rows = _division_sums(_row_pct(mart), lookup, year, ("cents",))
    sums = monthly_sums(rows, ["zorgbedrijf", "jaar"], "maand", ["cents"])
    return sums.select(
        "zorgbedrijf",
        "jaar",
        *[cents_as_decimal(F.coalesce(f"cents_{k}", F.lit(0))).alias(n) for k, n in zip(MONTHS, FTE_COLUMNS)],
    ).orderBy("zorgbedrijf")


def absence_rowpct_total(mart: DataFrame, year: int) -> DataFrame:
    """January's sum of per-row rounded absence % over all rows with employment days."""
    rows = _row_pct(mart.filter((F.col("jaar") == str(year)) & (F.col("dienstverband_dagen") > 0)))
    return rows.groupBy("jaar").agg(
        cents_as_decimal(F.sum(F.when(F.col("maand").cast("int") == 1, F.col("cents")).otherwise(F.lit(0)))).alias("jan")
    ).select(F.lit(ROWPCT_TOTAL_LABEL).alias("divisie"), "jaar", "jan")


def absence_total_pivot(mart: DataFrame, year: int) -> DataFrame:
    """R9 (intent of an invalid scratch query): organisation-wide ratio-of-sums absence % per
    month over rows with employment days, as 12 columns; months without data are 0."""
    rows = mart.filter((F.col("jaar") == str(year)) & (F.col("dienstverband_dagen") > 0)).withColumn(
        "maand", F.col("maand").cast("int")
    )
    sums = monthly_sums(rows, ["jaar"], "maand", ["dagen_ziek_ex_zwanger", "dienstverband_dagen"])
    cents = lambda k: pct_cents_half_up(f"dagen_ziek_ex_zwanger_{k}", f"dienstverband_dagen_{k}")
    return sums.select(
        F.lit(ROWPCT_TOTAL_LABEL).alias("divisie"),
        "jaar",
        *[cents_as_decimal(F.coalesce(cents(k), F.lit(0))).alias(n) for k, n in zip(MONTHS, FTE_COLUMNS)],
    )


def absence_year_total(mart: DataFrame, year: int) -> DataFrame:
    """Ratio-of-sums absence % for one year over rows with sick days (the scratch query
    filters on an absence column the mart does not have; read as sick days > 0)."""
    return (
        mart.filter((F.col("jaar") == str(year)) & (F.col("dagen_ziek_ex_zwanger") > 0))
        .groupBy("jaar")
        .agg(ratio_pct(F.sum("dagen_ziek_ex_zwanger"), F.sum("dienstverband_dagen")).alias("verzuim_ex_zwanger"))
        .select(F.lit(ROWPCT_TOTAL_LABEL).alias("divisie"), "jaar", "verzuim_ex_zwanger")
    )


# --------------------------------------------------------------------------- R11-R14
def kpi_lookup(dashboard: DataFrame, period: str, item: str, code: str) -> DataFrame:
    """KPI rows of one period, item and code."""
    return dashboard.filter(
        (F.col("rap_periode") == period) & (F.col("rap_item") == item) & (F.col("rap_code") == code)
    ).orderBy("rap_item")


def kpi_since(dashboard: DataFrame, code: str, after_period: int, item5: str) -> DataFrame:
    """KPI rows of one code after a period (periods compared as numbers)."""
    return dashboard.filter(
        (F.col("rap_code") == code) & (F.col("rap_periode").cast("int") > after_period) & (F.col("rap_item5") == item5)
    ).orderBy("rap_item")


def relation_counts(source: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rows per employment relation with its description (LEFT join: unknown codes keep a
    NULL description; a code listed under two descriptions counts under each). Rows are counted
    per code first, so the join sees one row per code."""
    counts = source.groupBy("dienstbetrekking").agg(F.count(F.lit(1)).alias("n"))
    lk = lookup.select(F.col("tabelwaarde_code").alias("dienstbetrekking"), "omschrijving")
    return (
        counts.join(lk, "dienstbetrekking", "left")
        .groupBy("dienstbetrekking", "omschrijving")
        .agg(F.sum("n").alias("aantal"))
        .orderBy("dienstbetrekking")
    )


def relation_enrich(contracts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Contract dimension with the relation description filled from the lookup; rows without
    a matching code keep their old description (UPDATE ... FROM ... JOIN: never more rows)."""
    updates = lookup.select(F.col("tabelwaarde_code").alias("dienstbetrekking"), F.col("omschrijving").alias("dienstbetrekking_oms"))
    return update_from(contracts, updates, ["dienstbetrekking"], ["dienstbetrekking_oms"])


def leave_reasons(periods: DataFrame) -> DataFrame:
    """Distinct leave-reason codes."""
    return periods.select("reden_uit_dienst_code").distinct()
