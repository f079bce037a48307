"""Datasets behind the dashboard charts.

The dashboard pages only name what each panel shows; the series below bind those panels to the
mart and to the event stream. Each dataset is an aggregate whose size is bounded by its axis
(quarters, years, divisions, days), so windows over the aggregated result are cheap.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staffmart.config import LOAD_OK, LOAD_PROBLEM, TOTAL_LABEL, UNKNOWN
from staffmart.functions.columns import ratio_pct
from staffmart.functions.formatting import clamp, date_label, date_to_epoch_ms, datetime_label_12h, day_label, with_unit
from staffmart.operators.quality import count_keys, distinct_keys
from staffmart.plans.reports import divisions


def quarter_of(jaar: str, maand: str):
    return F.concat(F.col(jaar), F.lit(" Q"), F.ceil(F.col(maand).cast("int") / F.lit(3)).cast("string"))


# --------------------------------------------------------------------------- G1-G5
def quarterly_series(mart: DataFrame) -> DataFrame:
    """G1 (area chart): per quarter, FTE-months, employment days and sick days. Sick days are
    NULL for a quarter without absence (a gap in the chart, not a zero)."""
    g = mart.groupBy(quarter_of("jaar", "maand").alias("periode")).agg(
        F.sum("fte_realisatie").alias("fte_maanden"),
        F.sum("dienstverband_dagen").alias("dagen"),
        F.sum(F.when(F.col("dagen_ziek_ex_zwanger") > 0, F.col("dagen_ziek_ex_zwanger"))).alias("ziek"),
    )
    return g.select(
        "periode",
        F.col("fte_maanden").cast("double").alias("fte_maanden"),
        F.col("dagen").cast("double").alias("dienstverband_dagen"),
        F.col("ziek").cast("double").alias("dagen_ziek_ex_zwanger"),
    )


def _sick_by_division(mart: DataFrame, lookup: DataFrame) -> DataFrame:
    return (
        mart.groupBy("kostenplaats_code").agg(F.sum("dagen_ziek_ex_zwanger").alias("z"))
        .join(divisions(lookup), "kostenplaats_code")
        .groupBy(F.coalesce("zorgbedrijf", F.lit(UNKNOWN)).alias("label"))
        .agg(F.sum("z").alias("z"))
    )


def sick_days_by_division(mart: DataFrame, lookup: DataFrame) -> DataFrame:
    """G2 (donut): sick days per division."""
    return _sick_by_division(mart, lookup).select("label", F.col("z").cast("double").alias("value"))


def share_of_total(df: DataFrame, label: str, value: str) -> DataFrame:
    """G5 (pie): each category's percentage of the total. The total is a scalar subquery (one
    row, from partial sums), so the categories stay distributed."""
    total = df.agg(F.sum(value)).scalar()
    return df.select(
        F.col(label).alias("label"),
        F.col(value).cast("double").alias("value"),
        ratio_pct(F.col(value), total).alias("pct"),
    )


def sick_share_by_division(mart: DataFrame, lookup: DataFrame) -> DataFrame:
    return share_of_total(_sick_by_division(mart, lookup), "label", "z")


def budget_vs_actual_by_year(mart_with_budget: DataFrame) -> DataFrame:
    """G3 (bar): budgeted (a) and actual (b) FTE-months per year."""
    g = mart_with_budget.groupBy("jaar").agg(F.sum("fte_begroot").alias("a"), F.sum("fte_realisatie").alias("b"))
    return g.select(F.col("jaar").alias("y"), F.col("a").cast("double").alias("a"), F.col("b").cast("double").alias("b"))


def days_by_year(mart: DataFrame) -> DataFrame:
    """G4 (line): sick days (a) and employment days (b) per year."""
    g = mart.groupBy("jaar").agg(F.sum("dagen_ziek_ex_zwanger").alias("a"), F.sum("dienstverband_dagen").alias("b"))
    return g.select(F.col("jaar").alias("y"), F.col("a").cast("double").alias("a"), F.col("b").cast("double").alias("b"))


# --------------------------------------------------------------------------- G6 / G7 / O3 / G12
def _day(events: DataFrame) -> DataFrame:
    return events.withColumn("dag", F.to_date("ts"))


def daily_two_series(events: DataFrame, type_a: str = "purchase", type_b: str = "view") -> DataFrame:
    """Two irregular daily series on one time axis, from one scan (a day that only one series
    has keeps NULL in the other; a day with neither is left out)."""
    is_a, is_b = F.col("event_type") == type_a, F.col("event_type") == type_b
    # amounts carry cents: sum them as decimals so the total does not depend on summation order
    days = _day(events.filter(is_a | is_b)).groupBy("dag").agg(
        F.sum(F.when(is_a, F.col("value").cast("decimal(18,2)"))).cast("double").alias("a_waarde"),
        F.nullif(F.count_if(is_b), F.lit(0)).alias("b_aantal"),
    )
    return days.select(
        date_label("dag").alias("dag"),
        date_to_epoch_ms("dag").alias("x_ms"),
        "a_waarde",
        "b_aantal",
    )


def two_series(events: DataFrame, type_a: str = "purchase", type_b: str = "view") -> DataFrame:
    """G6 on exact timestamps: two irregular series aligned on every moment that either has, from
    one scan. A series without a point there keeps NULL. ``x`` is the moment in microseconds since the epoch;
    ``tijd`` and ``a_label`` are the tooltip's time and the second axis' text with its unit."""
    is_a, is_b = F.col("event_type") == type_a, F.col("event_type") == type_b
    value = F.col("value").cast("decimal(18,2)")
    points = events.filter((is_a | is_b) & F.col("ts").isNotNull()).groupBy("ts").agg(
        F.sum(F.when(is_a, value)).alias("a"), F.sum(F.when(is_b, value)).alias("b")
    )
    return points.select(
        F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts)").alias("x"),
        datetime_label_12h("ts").alias("tijd"),
        F.col("a").cast("double").alias("a"),
        F.col("b").cast("double").alias("b"),
        with_unit("a", 2, "€").alias("a_label"),
    ).orderBy("x")


def daily_bars(events: DataFrame) -> DataFrame:
    """Events per day as time bars with an ``MM/dd`` label."""
    return (
        _day(events)
        .groupBy("dag")
        .agg(F.count(F.lit(1)).alias("aantal"))
        .select(
            date_label("dag").alias("dag"),
            date_to_epoch_ms("dag").alias("x_ms"),
            day_label("dag").alias("label"),
            "aantal",
        )
    )


def latest_rows(events: DataFrame, n: int = 8) -> DataFrame:
    """O3: the newest ``n`` rows by id (a top-n report: Spark plans TakeOrderedAndProject, each
    task keeps only its own top ``n``)."""
    return events.orderBy(F.col("event_id").desc()).limit(n).select(
        F.col("event_id").alias("id"),
        date_label("ts").alias("datum"),
        F.date_format("ts", "HH:mm").alias("tijd"),
        F.col("value").alias("aantal"),
    )


def load_feed(events: DataFrame, n: int = 8) -> DataFrame:
    """Status feed, newest first: one entry per day, with the problem text when the day had
    error events."""
    g = _day(events).groupBy("dag").agg(
        F.max("ts").alias("ts"), F.count_if(F.col("event_type") == "error").alias("fouten")
    )
    return g.orderBy(F.col("ts").desc()).limit(n).select(
        F.when(F.col("fouten") > 0, F.lit(LOAD_PROBLEM)).otherwise(F.lit(LOAD_OK)).alias("status"),
        F.date_format("ts", "d-M-yyyy H:mm").alias("tijd"),
        "fouten",
    )


# --------------------------------------------------------------------------- G9-G11
def absence_current_year(monthly: DataFrame, year: int) -> DataFrame:
    """Organisation-wide absence % by month of the current year."""
    return monthly.filter((F.col("divisie") == TOTAL_LABEL) & (F.col("jaar") == str(year))).select(
        F.col("maand").cast("int").alias("maand"), "zv", "zvc"
    )


def absence_by_year(mart: DataFrame) -> DataFrame:
    """Absence % per year."""
    return mart.groupBy("jaar").agg(
        ratio_pct(F.sum("dagen_ziek_ex_zwanger"), F.sum("dienstverband_dagen")).alias("verzuim_ex_zwanger")
    )


def absence_by_function(mart: DataFrame) -> DataFrame:
    """Share of sick days per function (the page's 'type' panel)."""
    g = mart.groupBy("functie_code").agg(F.sum("dagen_ziek_ex_zwanger").alias("z"))
    return share_of_total(g, "functie_code", "z")


def contracts_per_year(actual_facts: DataFrame) -> DataFrame:
    """Contracts with actual days per year as bitmaps (``quality.distinct_keys``): kept, a year's need
    no second look at its facts, and another load of the year is merged in."""
    return distinct_keys(actual_facts.select(F.substring(F.col("maand_id").cast("string"), 1, 4).alias("jaar"), "dienstverband_id"), "dienstverband_id", "jaar")


def contracts_by_relation(actual_facts: DataFrame, contracts: DataFrame) -> DataFrame:
    """Distinct contracts with actual days per year and employment relation, with each
    relation's share of the year."""
    return contracts_by_relation_of(contracts_per_year(actual_facts), contracts)


def contracts_by_relation_of(per_year: DataFrame, contracts: DataFrame) -> DataFrame:
    """G10 from the years' bitmaps: a year's contracts and a relation's contracts meet bucket by
    bucket of 32,768 ids, so no row of either is joined."""
    of_relation = distinct_keys(contracts, "dienstverband_id", "dienstbetrekking").withColumnRenamed("kaart", "_kaart")
    met = per_year.join(of_relation, "emmer").select("jaar", "dienstbetrekking", "emmer", F.explode(F.array("kaart", "_kaart")).alias("kaart"))
    both = met.groupBy("jaar", "dienstbetrekking", "emmer").agg(F.bitmap_and_agg("kaart").alias("kaart"))
    g = count_keys(both, "jaar", "dienstbetrekking").withColumnRenamed("unieke_sleutels", "contracten").where("contracten > 0")
    total = F.sum("contracten").over(Window.partitionBy("jaar"))
    return g.select("jaar", "dienstbetrekking", "contracten", ratio_pct(F.col("contracten"), total).alias("pct"))


def service_years(periods: DataFrame, reference_date) -> DataFrame:
    """Employees per completed year of service at the report date (first start date per
    employee; a year counts once its anniversary has passed)."""
    ref = F.lit(reference_date)
    start = periods.groupBy("medewerker_id").agg(F.min("datum_in").alias("start"))
    before_anniversary = (F.month(ref) < F.month("start")) | (
        (F.month(ref) == F.month("start")) & (F.dayofmonth(ref) < F.dayofmonth("start"))
    )
    years = F.year(ref) - F.year("start") - F.when(before_anniversary, 1).otherwise(0)
    return start.groupBy(years.alias("dienstjaren")).agg(F.count(F.lit(1)).alias("medewerkers"))


def service_years_by_year(periods: DataFrame, reference_date) -> DataFrame:
    """G11 (all years): for every year from the first start to the report year, employees already
    in service at its reference date (31 December, or the report end date for the report year)
    per completed year of service. Employees are counted per start date first, so each date, not
    each employee, is spread over the years."""
    last = F.lit(reference_date)
    starts = (
        periods.groupBy("medewerker_id").agg(F.min("datum_in").alias("start"))
        .groupBy("start").agg(F.count(F.lit(1)).alias("n")).where(F.col("start") <= last)
    )
    per_year = starts.select("start", "n", F.explode(F.sequence(F.year("start"), F.year(last))).alias("jaar"))
    ref, begin = F.when(F.col("jaar") == F.year(last), last).otherwise(F.make_date("jaar", F.lit(12), F.lit(31))), F.col("start")
    before_anniversary = (F.month(ref) < F.month(begin)) | (
        (F.month(ref) == F.month(begin)) & (F.dayofmonth(ref) < F.dayofmonth(begin))
    )
    served = F.year(ref) - F.year(begin) - F.when(before_anniversary, 1).otherwise(0)
    return per_year.groupBy("jaar", served.alias("dienstjaren")).agg(F.sum("n").alias("medewerkers"))


# --------------------------------------------------------------------------- G8 / T1 helpers
def function_grid(spark: SparkSession, stop: float = 12.0, step: float = 0.2, offset: float = 0.0) -> DataFrame:
    """sin/cos over a regular grid ``0, step, ... < stop`` (computed from the index, so the
    grid has ``ceil(stop/step)`` points without accumulated float error). Fixed input, so it is
    a library helper and not a registered query."""
    n = int(math.ceil(round(stop / step, 9)))
    x = F.col("id") * F.lit(step)
    return spark.range(n).select(x.alias("x"), F.sin(x + offset).alias("sin"), F.cos(x + offset).alias("cos"))


def rolling_buffer(events: DataFrame, n: int, key: str = "user_id", keep_value: bool = False) -> DataFrame:
    """T1 (batch form): each key's newest ``n`` values clamped to [0, 100], re-indexed oldest
    first (x = 0..n-1). ``row_number() <= n`` lets Spark insert a partial per-group limit before
    the shuffle, so a hot key ships at most ``n`` rows per map task."""
    newest_first = Window.partitionBy(key).orderBy(F.col("ts").desc(), F.col("event_id").desc())
    last = events.select(key, "ts", "event_id", "value").withColumn("_rn", F.row_number().over(newest_first)).filter(
        F.col("_rn") <= n
    )
    cnt = F.count(F.lit(1)).over(Window.partitionBy(key))
    return last.select(
        key,
        (cnt - F.col("_rn")).cast("int").alias("x"),
        clamp("value").alias("y"),
        "ts",
        "event_id",
        *(["value"] if keep_value else []),
    )
