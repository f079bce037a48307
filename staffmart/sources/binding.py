"""Personnel tables as Spark views over the synthetic star schema in ``/root/testdata``.

The warehouse itself is not available, so each personnel table is defined as a projection of
the given tables (rules below). All rules are plain column expressions and joins, so Catalyst
prunes columns and pushes filters into the parquet scans, and no job runs while they are bound.

===========================  ==============================================================
personnel table              bound from
===========================  ==============================================================
ref_datum                    every month of the years from the first to the last order date
fact_fte_realisatie          lineitem: employee ``l_suppkey`` (unknown when ``l_tax = 0``),
                             contract ``l_orderkey``, function ``l_partkey``, org unit
                             ``l_suppkey``, days ``l_quantity``, group '3' for finished lines
                             (``l_linestatus = 'F'``) and '1' for open ones, month of ``l_shipdate``
fact_fte_ziekteverzuim       lineitem lines with ``l_returnflag = 'R'``: sick days
                             ``l_quantity * l_discount``, sickness percentage ``l_discount``
fact_fte_begroting           lineitem lines with ``l_returnflag = 'N'``: budget days ``l_quantity``
dim_medewerker_functies      part: code ``p_type``, name ``'Functie ' || p_type``
dim_organisatie_eenheid      supplier ⋈ nation ⋈ region: cost centre and department ``n_name``,
                             cluster ``r_name``
dim_dienstverbanden          orders: employer ``o_orderpriority``, relation ``o_orderstatus``,
                             worker type unknown for contracts dated the 31st, trainee for the
                             1st and 2nd, employee otherwise; an old description for contracts
                             dated the 7th
dim_medewerkers              supplier keys
dwh_budgetplaatsen           nation ⋈ region: division ``r_name``, none for 'MIDDLE EAST'
dwh_rap_periode              one row: report end date = last order date
dwh_dashboard                orders counted per month, priority and status
afas_mdw_formatie            orders: employee ``o_custkey``, relation ``o_orderstatus``
afas_dienstbetrekking        relation code lookup (two codes, one of them twice; 'P' stays
                             unmatched)
afas_dienstperiodes          orders: employee ``o_custkey``, start ``o_orderdate``, leave reason
                             ``o_orderstatus`` unless the order is still open
===========================  ==============================================================

The exclusion lists of the warehouse refer to its own codes; :data:`EXCLUSIONS` holds the
equivalents in this binding (promo functions, the AFRICA cluster, low-priority employers,
pending relations, trainees).
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffmart.config import EXCLUDED_WORKER_TYPES, REPORT_PACKAGE, Exclusions
from staffmart.sources.schemas import RAW_SCHEMAS
from staffmart.sources.tables import Tables

EXCLUSIONS = Exclusions(
    functions=("PROMO",),
    clusters=("AFRICA",),
    employers=("5-LOW",),
    relations=("P",),
    worker_types=EXCLUDED_WORKER_TYPES,
)
WORKER = "Werknemer"
NO_DIVISION_REGION = "MIDDLE EAST"
# relation code -> description (fixed lookup rows of this binding)
RELATION_LOOKUP = (("F", "Vast dienstverband"), ("O", "Oproepcontract"), ("O", "Oproep (oud)"))
OLD_DESCRIPTION = "Oude omschrijving"


def month_id(col: str) -> F.Column:
    return (F.year(col) * 100 + F.month(col)).cast("int")


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


class SyntheticTables(Tables):
    """Tables bound to the synthetic data; period restriction works on the raw ship date."""

    def __init__(self, line: Callable[[], DataFrame], **tables):
        super().__init__(**tables)
        self._line = line

    def replace(self, **changes) -> "SyntheticTables":
        return SyntheticTables(self._line, **{**self._given, **changes})

    def for_periods(self, first_month: int, last_month: int) -> "SyntheticTables":
        # ``maand_id`` is computed here, so a filter on it cannot reach the scan. Filter the raw
        # ship date instead: a plain range that parquet evaluates against row-group statistics.
        lo = dt.date(first_month // 100, first_month % 100, 1)
        hi_year, hi_month = divmod(last_month, 100)
        hi = dt.date(hi_year + (hi_month == 12), hi_month % 12 + 1, 1)
        in_period = (F.col("l_shipdate") >= F.lit(lo)) & (F.col("l_shipdate") < F.lit(hi))
        return self.replace(**_facts(lambda: self._line().filter(in_period)))


def _actuals(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.when(F.col("l_tax") != 0, F.col("l_suppkey")).alias("medewerker_id"),
        F.col("l_orderkey").alias("dienstverband_id"),
        F.col("l_partkey").alias("medewerker_functie_id"),
        F.col("l_suppkey").alias("organisatie_eenheid_id"),
        F.col("l_quantity").cast("decimal(18,6)").alias("dienstverband_dagen"),
        _group_id().alias("groepering_id"),
        month_id("l_shipdate").alias("maand_id"),
    )


def _absence(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_returnflag") == "R").select(
        F.col("l_suppkey").alias("medewerker_id"),
        F.col("l_orderkey").alias("dienstverband_id"),
        F.col("l_partkey").alias("medewerker_functie_id"),
        F.col("l_suppkey").alias("organisatie_eenheid_id"),
        (F.col("l_quantity").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)"))
        .cast("decimal(18,6)")
        .alias("dagen_ziek_ex_zwanger"),
        F.col("l_discount").alias("ziektepercentage"),
        month_id("l_shipdate").alias("maand_id"),
    )


def _budget(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_returnflag") == "N").select(
        month_id("l_shipdate").alias("maand_id"),
        F.col("l_partkey").alias("medewerker_functie_id"),
        F.col("l_suppkey").alias("organisatie_eenheid_id"),
        F.col("l_quantity").cast("decimal(18,6)").alias("fte_begroot_dagen"),
        _group_id().alias("groepering_id"),
    )


def _group_id() -> F.Column:
    return F.when(F.col("l_linestatus") == "F", F.lit("3")).otherwise(F.lit("1"))


def _facts(line: Callable[[], DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    return {
        "fact_fte_realisatie": lambda: _actuals(line()),
        "fact_fte_ziekteverzuim": lambda: _absence(line()),
        "fact_fte_begroting": lambda: _budget(line()),
    }


def calendar(orders: DataFrame) -> DataFrame:
    """Dense month calendar over whole years, one row per month. Only the order-date column is read."""
    years = orders.agg(F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi"))
    months = years.select(
        F.explode(
            F.sequence(F.make_date("lo", F.lit(1), F.lit(1)), F.make_date("hi", F.lit(12), F.lit(1)),
                       F.expr("interval 1 month"))
        ).alias("m")
    )
    return months.select(
        month_id("m").alias("maand_id"),
        F.year("m").alias("jaar"),
        F.month("m").alias("maandnummer"),
        F.dayofmonth(F.last_day("m")).alias("aantal_dagen_maand"),
    )


def _org_units(raw: Callable[[str], DataFrame]) -> DataFrame:
    return raw("supplier").join(_geography(raw), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("organisatie_eenheid_id"),
        F.col("n_name").alias("kostenplaats_code"),
        F.col("n_name").alias("afdeling_code"),
        F.col("r_name").alias("cluster_code"),
    )


def _geography(raw: Callable[[str], DataFrame]) -> DataFrame:
    return raw("nation").join(raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))


def _contracts(orders: DataFrame) -> DataFrame:
    order_day = F.dayofmonth("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("dienstverband_id"),
        F.col("o_orderpriority").alias("werkgever_code"),
        F.col("o_orderstatus").alias("dienstbetrekking"),
        F.when(order_day == 31, F.lit(None).cast("string"))
        .when(order_day <= 2, F.lit(EXCLUDED_WORKER_TYPES[0]))
        .otherwise(F.lit(WORKER))
        .alias("type_werknemer"),
        F.when(order_day == 7, F.lit(OLD_DESCRIPTION)).alias("dienstbetrekking_oms"),
    )


def _functions(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("medewerker_functie_id"),
        F.col("p_type").alias("medewerker_functie_code"),
        F.concat(F.lit("Functie "), F.col("p_type")).alias("medewerker_functie_naam"),
    )


def _dashboard(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(
            F.date_format("o_orderdate", "yyyyMM").alias("rap_periode"),
            F.col("o_orderpriority").alias("rap_item"),
            F.col("o_orderstatus").alias("rap_code"),
        )
        .agg(F.count(F.lit(1)).alias("rap_waarde"))
        .withColumn("rap_item5", F.when(F.col("rap_item") == "1-URGENT", F.lit("MGT_RAP")).otherwise(F.lit("AFD_RAP")))
    )


def bind(spark: SparkSession, sf_dir: str) -> SyntheticTables:
    """The personnel tables over one folder of raw files; nothing is opened here."""
    raw = functools.cache(lambda name: read_raw(spark, sf_dir, name))
    orders = lambda: raw("orders")
    return SyntheticTables(
        lambda: raw("lineitem"),
        ref_datum=lambda: calendar(orders()),
        dim_medewerker_functies=lambda: _functions(raw("part")),
        dim_organisatie_eenheid=lambda: _org_units(raw),
        dim_dienstverbanden=lambda: _contracts(orders()),
        dim_medewerkers=lambda: raw("supplier").select(F.col("s_suppkey").alias("medewerker_id")),
        dwh_budgetplaatsen=lambda: _geography(raw).select(
            F.col("n_name").alias("kostenplaats_code"),
            F.when(F.col("r_name") != NO_DIVISION_REGION, F.col("r_name")).alias("zorgbedrijf"),
        ),
        dwh_rap_periode=lambda: orders().agg(F.to_date(F.max("o_orderdate")).alias("rapport_einddatum")).select(
            F.lit(REPORT_PACKAGE).alias("package_naam"), "rapport_einddatum"
        ),
        dwh_dashboard=lambda: _dashboard(orders()),
        afas_mdw_formatie=lambda: orders().select(
            F.col("o_custkey").alias("medewerker_id"),
            F.col("o_orderstatus").alias("dienstbetrekking"),
        ),
        afas_dienstbetrekking=lambda: spark.createDataFrame(list(RELATION_LOOKUP), "tabelwaarde_code string, omschrijving string"),
        afas_dienstperiodes=lambda: orders().select(
            F.col("o_custkey").alias("medewerker_id"),
            F.to_date("o_orderdate").alias("datum_in"),
            F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("reden_uit_dienst_code"),
        ),
        **_facts(lambda: raw("lineitem")),
    )
