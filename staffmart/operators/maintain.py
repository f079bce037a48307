"""Keeping the mart up to date as facts are appended (S6 -> C5 / C6), without a rebuild.

Days are additive, so a load's own sums are enough: they are built from the new files alone, by the
same joins as the mart, and merged into the stored sums of the same keys. A load can also be taken
back (``sign=-1``); a key whose facts are all gone leaves the mart. Year-to-date sums follow from a
key's months, so they are redone for the keys of the load and no others.

The stored mart holds the sums beside the measures, partitioned by year and by a bucket of the key,
so that a key's months lie in one partition. A load replaces the partitions of its keys; the files
of all others stay. New sums, year-to-date sums and the load's name become visible in one step
(:func:`staffmart.operators.publish.publish_table`): a run that fails changes nothing, and a load
that is offered again is known by its name and left out.
"""

from __future__ import annotations

import functools
import operator
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffmart.config import MART_KEYS, MartOptions, ReportYears
from staffmart.functions.columns import fte
from staffmart.operators.mart import DAYS, day_sums, stacked_rows, with_ytd
from staffmart.operators.publish import partition_is, publish_table, published
from staffmart.sources.tables import Tables

BUCKETS = 16
PARTS = ("jaar", "emmer")
MONTH_KEYS = ("jaar", "maand", "medewerker_id", "kostenplaats_code", "functie_code")
SUMS = (*MONTH_KEYS, *DAYS, "aantal_dagen_maand", "feiten")


def bucket() -> Column:
    return F.pmod(F.hash("medewerker_id", "kostenplaats_code", "functie_code"), F.lit(BUCKETS)).alias("emmer")


def complete(sums: DataFrame) -> DataFrame:
    """Stored rows from the sums of whole keys: measures, year-to-date sums and the bucket."""
    measured = sums.select(*SUMS, fte("begroot_dagen", "aantal_dagen_maand").alias("fte_begroot"),
                           fte("dienstverband_dagen", "aantal_dagen_maand").alias("fte_realisatie"))
    return with_ytd(measured).select("*", bucket())


def load_sums(t: Tables, years: ReportYears, opts: MartOptions = MartOptions(), sign: int = 1) -> DataFrame:
    """What a load of facts adds to the mart (or, with ``sign=-1``, takes from it)."""
    sums = day_sums(stacked_rows(t, years, opts))
    signed = {c: F.col(c) * F.lit(sign) for c in (*DAYS, "feiten")}
    return sums.select(*[signed[c].cast(sums.schema[c].dataType).alias(c) if c in signed else F.col(c) for c in SUMS])


def merge(old: DataFrame, delta: DataFrame) -> DataFrame:
    """Stored rows of the touched partitions after a load: keys of the load summed and completed
    anew, all others as they are."""
    keys = delta.select(*[F.col(k).alias(f"_{k}") for k in MART_KEYS]).distinct()
    same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in MART_KEYS])
    months = old.join(keys, same, "left_semi").select(*SUMS).unionByName(delta.select(*SUMS))
    kinds = {f.name: f.dataType for f in old.schema.fields}
    sums = months.groupBy(*MONTH_KEYS).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in DAYS], F.max("aantal_dagen_maand").alias("aantal_dagen_maand"),
                                           F.sum("feiten").alias("feiten")).where("feiten <> 0")
    return old.join(keys, same, "left_anti").unionByName(complete(sums).select(*old.columns))


def start(t: Tables, years: ReportYears, base: str, table: str, opts: MartOptions = MartOptions(), load: str = "start") -> DataFrame:
    """Publish the mart of the facts at hand, ready for loads."""
    rows = complete(load_sums(t, years, opts))
    return publish_table(rows, base, table, PARTS, notes={"loads": load})


def add_load(spark: SparkSession, t: Tables, years: ReportYears, base: str, table: str, load: str, opts: MartOptions = MartOptions(), sign: int = 1) -> DataFrame:
    """Publish the mart after a load; ``t`` holds the new facts only (and the dimensions). ``load``
    names it: a name that the mart already holds changes nothing."""
    loads = published(spark, table).get("loads", "").split(",")
    if "," in load or "'" in load:
        raise ValueError("a load's name holds no comma and no quote")
    stored = spark.table(table)
    if load in loads:
        return stored
    # read three times below, and a cut of the lineage: the joins run once
    path = os.path.join(base, f"{table}_loads", uuid.uuid4().hex)
    load_sums(t, years, opts, sign).select("*", bucket()).write.parquet(path)
    delta = spark.read.parquet(path)
    touched = [tuple(r) for r in delta.select(*PARTS).distinct().collect()]      # years x buckets at most
    merged = merge(stored.where(partition_is(PARTS, touched)), delta)
    return publish_table(merged, base, table, PARTS, only_its_partitions=True, emptied=touched, notes={"loads": ",".join([*loads, load])})


def mart_of(stored: DataFrame) -> DataFrame:
    """The exact mart (as :func:`staffmart.operators.mart.fte_mart`) from the stored rows."""
    return stored.drop("begroot_dagen", "aantal_dagen_maand", "feiten", "emmer")
