"""Sinks and stored layouts written and read back as queries (S4-S7, S9, S10, S13, S14 and the
layouts of ``operators.layout``): what a consumer of the written tables sees."""

from __future__ import annotations

import uuid
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.config import UNKNOWN
from staffmart.operators import layout, maintain
from staffmart.operators import mart as M
from staffmart.operators import quality as Q
from staffmart.operators import staging as S
from staffmart.operators.publish import append, materialize, publish_table, truncate, update_partitions
from staffmart.plans import charts as G
from staffmart.plans import reports as R
from staffmart.session import warehouse_path
from staffmart.sources.loaders import stored_inventory as inventory_of
from staffmart.sources.tables import FACTS, Tables

if TYPE_CHECKING:
    from staffmart.plans.registry import Context


SEASON = (1, 2, 3)        # calendar months of the seasonal report


def _place(df: DataFrame, name: str) -> str:
    return warehouse_path(df.sparkSession, f"sinks/{name}-{uuid.uuid4().hex}")


def _loaded(df: DataFrame) -> DataFrame:
    """The load time itself differs from run to run; that it is there does not."""
    return df.withColumn("geladen", F.col("loaddatime").isNotNull()).drop("loaddatime")


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def published_mart(c: Context) -> DataFrame:
    """The mart under its public name, partitioned by year, with its load time. An
    earlier, different version of the table is gone."""
    exact = c.mart()
    mart = M.display(materialize(exact.sparkSession, exact, f"sinks/{_name('exact')}"), with_load_time=True)
    base, table = warehouse_path(mart.sparkSession, "sinks"), _name("mart")
    publish_table(mart.withColumn("jaar", F.lit("1900")).where(F.col("maand") == "01"), base, table)
    return M.as_doubles(_loaded(publish_table(mart, base, table)))


def refreshed_mart(c: Context) -> DataFrame:
    """A refresh of the current year alone, here without the unknown employee, beside the
    previous year as published."""
    mart = M.display(c.mart(), with_load_time=True)
    base, table = warehouse_path(mart.sparkSession, "sinks"), _name("mart")
    publish_table(mart, base, table)
    current = mart.where((F.col("jaar") == str(c.years.current)) & (F.col("medewerker_id") != UNKNOWN))
    back = publish_table(current, base, table, only_its_partitions=True)
    return back.groupBy("jaar").agg(F.count(F.lit(1)).alias("rijen"), F.sum("dienstverband_dagen").cast("double").alias("dienstverband_dagen"),
                                    F.count_if(F.col("medewerker_id") == UNKNOWN).alias("onbekend"))


def appended_contracts(c: Context) -> DataFrame:
    """The contract dimension inserted twice."""
    t = c.tables.dim_dienstverbanden
    path = _place(t, "contracts")
    append(t, path)
    append(t, path)
    return t.sparkSession.read.schema(t.schema).parquet(path).groupBy("dienstbetrekking").agg(F.count(F.lit(1)).alias("aantal"))


def truncated_contracts(c: Context) -> DataFrame:
    """Rows of the contract dimension before and after it is emptied."""
    t = c.tables.dim_dienstverbanden
    path = _place(t, "contracts")
    append(t, path)
    before = t.sparkSession.read.schema(t.schema).parquet(path).count()
    truncate(t.sparkSession, path, t.schema)
    after = t.sparkSession.read.parquet(path)
    return after.agg(F.lit(before).cast("long").alias("voor"), F.count(F.lit(1)).alias("na"), F.lit(len(after.columns)).alias("kolommen"))


def updated_contracts(c: Context) -> DataFrame:
    """The contract dimension, stored by employment relation, after an update in place that
    rewrites the matched relations alone."""
    t = c.tables.dim_dienstverbanden
    lookup = c.tables.afas_dienstbetrekking.select(F.col("tabelwaarde_code").alias("dienstbetrekking"), F.col("omschrijving").alias("dienstbetrekking_oms"))
    path = _place(t, "contracts")
    t.write.partitionBy("dienstbetrekking").parquet(path)
    update_partitions(t.sparkSession, path, t.schema, ["dienstbetrekking"], lookup, ["dienstbetrekking"], ["dienstbetrekking_oms"])
    return t.sparkSession.read.schema(t.schema).parquet(path).groupBy("dienstbetrekking", "dienstbetrekking_oms").agg(F.count(F.lit(1)).alias("aantal"))


def appended_mart(c: Context) -> DataFrame:
    """S6 -> C6: the mart of all months but one, to which that month is then added from its own
    facts; the load is offered twice and counts once."""
    t, years = c.period, c.years
    spark, late = t.fact_fte_realisatie.sparkSession, c.years.current * 100 + 2
    others = F.col("maand_id") != late
    base, table = warehouse_path(spark, "sinks"), _name("mart")
    rest = t.replace(**{n: getattr(t, n).where(others) for n in FACTS})
    maintain.start(rest, years, base, table, c.options)
    month = c.tables.for_periods(late, late)
    for _ in range(2):
        stored = maintain.add_load(spark, month, years, base, table, f"maand {late}", c.options)
    return M.as_doubles(M.display(maintain.mart_of(stored)))


def observed_checks(c: Context) -> DataFrame:
    """Q4, Q5: the figures observed while the mart is published."""
    watch = Q.Watch()
    mart = watch.mart(M.fte_mart(c.period, c.years, c.options, watch.facts))
    publish_table(mart, warehouse_path(mart.sparkSession, "sinks"), _name("mart"))
    return mart.sparkSession.createDataFrame(list(watch.figures.items()), "controle string, aantal long")


def contracts_by_relation_kept(c: Context) -> DataFrame:
    """G10 from stored bitmaps: those of all years but the last, then the last year's added from its
    own facts in two halves, merged when read."""
    facts = c.tables.fact_fte_realisatie.select("maand_id", "dienstverband_id")
    path, last = _place(facts, "contract-years"), c.years.current * 100
    for part in (F.col("maand_id") < last, F.col("maand_id").between(last, last + 6), F.col("maand_id") > last + 6):
        G.contracts_per_year(facts.where(part)).write.mode("append").partitionBy("jaar").parquet(path)
    kept = facts.sparkSession.read.schema("emmer long, kaart binary, jaar string").parquet(path)
    return G.contracts_by_relation_of(Q.merge_keys(kept, "jaar"), c.tables.dim_dienstverbanden)


def _bucketed(c: Context) -> Tables:
    t = c.period
    return layout.store_bucketed(t, warehouse_path(t.dim_dienstverbanden.sparkSession, "layout"), _name("b") + "_")


def actual_fte_bucketed(c: Context) -> DataFrame:
    """C2 from facts and contracts stored in buckets of the contract id."""
    return S.actual_fte(_bucketed(c), c.years, c.options)


def sick_days_bucketed(c: Context) -> DataFrame:
    """C4 from facts and contracts stored in buckets of the contract id."""
    return S.sick_days(_bucketed(c), c.years, c.options)


def seasonal_days(c: Context) -> DataFrame:
    """Days of each year's first quarter from facts stored by month, pruned by the calendar."""
    t = c.tables
    stored = layout.store_by_month(t, warehouse_path(t.ref_datum.sparkSession, "layout"), _name("m") + "_", ["fact_fte_realisatie"])
    return M.as_doubles(R.seasonal_days(stored, c.options, SEASON))


def stored_inventory(c: Context) -> DataFrame:
    """The inventory of the stored tables from the catalogue's own row counts."""
    spark = c.tables.ref_datum.sparkSession
    return inventory_of(spark, layout.store_analyzed(c.tables, warehouse_path(spark, "layout"), _name("i") + "_"))
