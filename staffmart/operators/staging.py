"""Staging jobs: budget (C1), actuals (C2, C3) and sick absence (C4).

Join strategy: no hints. Spark broadcasts a calendar or dimension when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE switches a sort-merge join to broadcast at
runtime once the actual size is known; beyond that they sort-merge, with AQE's skew-join
splitting a hot key. Dimension exclusions are applied to the dimension before the join
(Catalyst pushes them into the dimension scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.config import MartOptions, ReportYears
from staffmart.functions.columns import (
    fte,
    in_years,
    not_in,
    not_in_or_null,
    period_key,
    unknown_member,
    zero_decimal,
)
from staffmart.sources.tables import Tables


def calendar(t: Tables, years: ReportYears | None = None) -> DataFrame:
    """The month calendar (one row per month; ``dimension_key_duplicates`` checks that)."""
    cal = t.ref_datum.select("maand_id", "jaar", "maandnummer", "aantal_dagen_maand")
    if years is not None:
        cal = cal.filter(F.col("jaar").isin(list(years.both)))
    return cal


def functions_kept(t: Tables, opts: MartOptions) -> DataFrame:
    return t.dim_medewerker_functies.filter(not_in("medewerker_functie_code", opts.exclusions.functions)).select(
        "medewerker_functie_id", "medewerker_functie_code", "medewerker_functie_naam"
    )


def org_units_kept(t: Tables, opts: MartOptions) -> DataFrame:
    return t.dim_organisatie_eenheid.filter(not_in("cluster_code", opts.exclusions.clusters)).select(
        "organisatie_eenheid_id", "kostenplaats_code", "afdeling_code"
    )


def contracts_kept(t: Tables, opts: MartOptions) -> DataFrame:
    ex = opts.exclusions
    return t.dim_dienstverbanden.filter(
        not_in("werkgever_code", ex.employers)
        & not_in("dienstbetrekking", ex.relations)
        & not_in_or_null("type_werknemer", ex.worker_types)
    ).select("dienstverband_id")


# --------------------------------------------------------------------------- C1
def budget_rows(t: Tables, years: ReportYears, opts: MartOptions = MartOptions()) -> DataFrame:
    """Budget facts joined to calendar, kept functions and kept org units (inner joins: excluded
    dimensions drop the row)."""
    fact = t.fact_fte_begroting.filter(
        (F.col("groepering_id") == opts.budget_group) & in_years("maand_id", years.both)
    )
    return (
        fact.join(calendar(t, years), "maand_id")
        .join(functions_kept(t, opts), "medewerker_functie_id")
        .join(org_units_kept(t, opts), "organisatie_eenheid_id")
        .withColumn("begroot_dagen", F.coalesce("fte_begroot_dagen", zero_decimal(18, 6)))
    )


def budget_fte(t: Tables, years: ReportYears, opts: MartOptions = MartOptions()) -> DataFrame:
    """Budgeted FTE per cost centre, department, function and month."""
    return (
        budget_rows(t, years, opts)
        .groupBy(
            "kostenplaats_code", "afdeling_code", "medewerker_functie_code", "medewerker_functie_naam",
            "jaar", "maandnummer", "maand_id",
        )
        .agg(F.sum("begroot_dagen").alias("begroot_dagen"), F.max("aantal_dagen_maand").alias("aantal_dagen_maand"))
        .select(
            "kostenplaats_code",
            "afdeling_code",
            F.col("medewerker_functie_code").alias("functiecode_excl"),
            F.col("medewerker_functie_code").alias("functiecode"),
            F.col("medewerker_functie_naam").alias("oms_functie"),
            fte("begroot_dagen", "aantal_dagen_maand").cast("double").alias("formatie"),
            zero_decimal().cast("double").alias("gem_realisatie_cum"),
            "jaar",
            "maandnummer",
            F.col("maand_id").alias("periode"),
        )
    )


# --------------------------------------------------------------------------- C2 / C3
def actual_rows(t: Tables, years: ReportYears, opts: MartOptions = MartOptions()) -> DataFrame:
    """Actual-FTE facts with unknown members: function and org unit are LEFT joins whose
    exclusions sit in the ON clause, so excluded or missing members become 'Onbekend' instead of
    dropping the row; the contract join is inner and drops excluded contracts."""
    fact = t.fact_fte_realisatie.filter(
        (F.col("groepering_id") == opts.budget_group) & in_years("maand_id", years.both)
    )
    # the contract join filters rows, so it goes first; the LEFT joins only label
    joined = (
        fact.join(contracts_kept(t, opts), "dienstverband_id")
        .join(calendar(t), "maand_id")
        .join(functions_kept(t, opts), "medewerker_functie_id", "left")
        .join(org_units_kept(t, opts), "organisatie_eenheid_id", "left")
    )
    return joined.select(
        unknown_member("medewerker_id").alias("medewerker_id"),
        unknown_member("dienstverband_id").alias("dienstverband_id"),
        unknown_member("kostenplaats_code").alias("kostenplaats_code"),
        unknown_member("afdeling_code").alias("afdeling_code"),
        unknown_member("medewerker_functie_code").alias("functiecode"),
        unknown_member("medewerker_functie_naam").alias("oms_functie"),
        unknown_member("jaar").alias("jaar"),
        unknown_member("maandnummer").alias("maandnummer"),
        F.col("maand_id").alias("periode"),
        "aantal_dagen_maand",
        F.coalesce("dienstverband_dagen", zero_decimal(18, 6)).alias("dienstverband_dagen"),
    )


def actual_fte(t: Tables, years: ReportYears, opts: MartOptions = MartOptions()) -> DataFrame:
    """Actual FTE and employment days per employee x contract x cost centre x department x
    function x month."""
    return (
        actual_rows(t, years, opts)
        .groupBy(
            "medewerker_id", "dienstverband_id", "kostenplaats_code", "afdeling_code",
            "functiecode", "oms_functie", "jaar", "maandnummer", "periode",
        )
        .agg(F.sum("dienstverband_dagen").alias("dienstverband_dagen"), F.max("aantal_dagen_maand").alias("aantal_dagen_maand"))
        .select(
            "medewerker_id",
            "dienstverband_id",
            "kostenplaats_code",
            "afdeling_code",
            F.col("functiecode").alias("functiecode_excl"),
            "functiecode",
            "oms_functie",
            F.lit(0.0).alias("plan_formatie"),
            fte("dienstverband_dagen", "aantal_dagen_maand").cast("double").alias("realisatie"),
            F.col("dienstverband_dagen").cast("double").alias("dienstverband_dagen"),
            F.lit(0.0).alias("gem_realisatie"),
            "jaar",
            "maandnummer",
            "periode",
        )
    )


def actual_fte_by_function(t: Tables, years: ReportYears, opts: MartOptions = MartOptions()) -> DataFrame:
    """Actuals at employee x cost centre x function x month (one aggregation straight from
    the joined facts; summing C2 again gives the same exact decimals)."""
    return (
        actual_rows(t, years, opts)
        .groupBy("periode", "medewerker_id", "kostenplaats_code", F.col("functiecode").alias("functie_code"))
        .agg(F.sum("dienstverband_dagen").alias("dienstverband_dagen"), F.max("aantal_dagen_maand").alias("aantal_dagen_maand"))
        .select(
            "periode",
            "medewerker_id",
            "kostenplaats_code",
            "functie_code",
            F.lit(0.0).alias("formatie"),
            fte("dienstverband_dagen", "aantal_dagen_maand").cast("double").alias("realisatie"),
            F.lit(0.0).alias("dagen_ziek_ex_zwanger"),
            F.col("dienstverband_dagen").cast("double").alias("dienstverband_dagen"),
        )
    )


# --------------------------------------------------------------------------- C4
def sick_rows(t: Tables, years: ReportYears, opts: MartOptions = MartOptions()) -> DataFrame:
    """Sick-absence facts: every dimension is an inner join, and the employee dimension acts as
    an existence check that supplies the employee key."""
    fact = t.fact_fte_ziekteverzuim.filter(in_years("maand_id", years.both) & (F.col("ziektepercentage") != 0))
    joined = (
        fact.join(contracts_kept(t, opts), "dienstverband_id")
        .join(calendar(t), "maand_id")
        .join(functions_kept(t, opts), "medewerker_functie_id")
        .join(org_units_kept(t, opts), "organisatie_eenheid_id")
        .join(t.dim_medewerkers.select("medewerker_id"), "medewerker_id")
    )
    return joined.select(
        period_key("jaar", "maandnummer").alias("periode"),
        "kostenplaats_code",
        F.col("medewerker_functie_code").alias("functiecode"),
        F.col("medewerker_id").cast("string").alias("medewerker_id"),
        "aantal_dagen_maand",
        F.coalesce("dagen_ziek_ex_zwanger", zero_decimal(18, 6)).alias("dagen_ziek_ex_zwanger"),
    )


ACTUAL, SICK = "actual", "sick"


def actual_and_sick_rows(t: Tables, years: ReportYears, opts: MartOptions = MartOptions()) -> DataFrame:
    """:func:`actual_rows` and :func:`sick_rows` under one chain of joins, told apart by ``soort``.

    Both facts meet the same contracts and calendar (inner) and the same functions, org units and
    employees. The latter only label an actual row, which stays as an unknown member without them;
    a sick row needs all three. So the facts are stacked first, every dimension is joined once, and
    a test afterwards drops the sick rows that lack one."""
    zero = zero_decimal(18, 6)
    ids = ["maand_id", "dienstverband_id", "medewerker_functie_id", "organisatie_eenheid_id", "medewerker_id"]
    actual = t.fact_fte_realisatie.filter((F.col("groepering_id") == opts.budget_group) & in_years("maand_id", years.both)).select(
        *ids, F.lit(ACTUAL).alias("soort"), F.coalesce("dienstverband_dagen", zero).alias("dienstverband_dagen"), zero.alias("dagen_ziek_ex_zwanger"))
    sick = t.fact_fte_ziekteverzuim.filter(in_years("maand_id", years.both) & (F.col("ziektepercentage") != 0)).select(
        *ids, F.lit(SICK).alias("soort"), zero.alias("dienstverband_dagen"), F.coalesce("dagen_ziek_ex_zwanger", zero).alias("dagen_ziek_ex_zwanger"))
    there = lambda df, mark: df.withColumn(mark, F.lit(True))
    joined = (
        actual.unionByName(sick)
        .join(contracts_kept(t, opts), "dienstverband_id")
        .join(calendar(t), "maand_id")
        .join(there(functions_kept(t, opts).drop("medewerker_functie_naam"), "_functie"), "medewerker_functie_id", "left")
        .join(there(org_units_kept(t, opts).drop("afdeling_code"), "_eenheid"), "organisatie_eenheid_id", "left")
        .join(there(t.dim_medewerkers.select("medewerker_id"), "_medewerker"), "medewerker_id", "left")
    )
    is_actual = F.col("soort") == ACTUAL
    label = lambda c: F.when(is_actual, unknown_member(c)).otherwise(F.col(c).cast("string"))
    return joined.where(is_actual | (F.col("_functie") & F.col("_eenheid") & F.col("_medewerker"))).select(
        "soort",
        F.when(is_actual, F.col("maand_id").cast("string")).otherwise(period_key("jaar", "maandnummer")).alias("periode"),
        label("medewerker_id").alias("medewerker_id"),
        label("kostenplaats_code").alias("kostenplaats_code"),
        label("medewerker_functie_code").alias("functiecode"),
        "aantal_dagen_maand",
        "dienstverband_dagen",
        "dagen_ziek_ex_zwanger",
    )


def sick_days(t: Tables, years: ReportYears, opts: MartOptions = MartOptions()) -> DataFrame:
    """C4: sick days excluding pregnancy per employee x cost centre x function x month."""
    return (
        sick_rows(t, years, opts)
        .groupBy("periode", "kostenplaats_code", "functiecode", "medewerker_id")
        .agg(F.sum("dagen_ziek_ex_zwanger").cast("double").alias("dagen_ziek_ex_zwanger"))
    )

