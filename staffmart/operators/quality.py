"""Data-quality checks implied by the warehouse (Q1-Q6). Each returns a small DataFrame; none
collects data to the driver."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from staffmart.config import UNKNOWN, MartOptions, ReportYears
from staffmart.functions.columns import in_years
from staffmart.operators import staging as S
from staffmart.sources.tables import Tables


LANES = 4                     # wide hash: so many sums of 64-bit hashes each
_LANE_SEEDS = (42, 1009, 7919, 104729)


def row_lanes(cols: Sequence[str]) -> list[Column]:
    """A row's wide hash: ``LANES`` 64-bit hashes under different seeds. Every value takes part with
    its column's place and whether it is NULL, so a NULL and a value moved by one column differ."""
    tagged = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *tagged) for seed in _LANE_SEEDS[:LANES]]


def load_fingerprint(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """An order-free multiset fingerprint of a load: rows, and sums of the rows' wide hashes. Equal
    multisets of rows have equal fingerprints; a row more, less or changed moves every sum. It adds
    up: the fingerprint of two loads together is the sum of theirs.

    Sums are decimals, so they do not wrap; tasks send one row each, whatever the columns."""
    cols = list(cols or df.columns)
    lanes = [F.sum(h.cast("decimal(20,0)")).alias(f"som{i}") for i, h in enumerate(row_lanes(cols))]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rijen"), *lanes)


def repeated_load(load: DataFrame, earlier: DataFrame, cols: Sequence[str] | None = None) -> bool:
    """Whether a load brings exactly the rows of an earlier one, however they are ordered or
    dealt. Two one-row aggregates; no rows are grouped or shuffled."""
    cols = list(cols or load.columns)
    a, b = load_fingerprint(load, cols).first(), load_fingerprint(earlier, cols).first()
    return a["rijen"] > 0 and tuple(a) == tuple(b)


def duplicate_load(df: DataFrame, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Q1: rows vs. distinct rows. A table loaded twice has ``rijen = 2 * unieke_rijen``.

    Rows are grouped by their wide hash (``LANES`` longs) instead of by all their columns, so what
    is shuffled is map-side counts of fixed width; that two different rows share all 256 bits is not
    to be expected at any size (2**-196 for 2**30 rows). Whole loads are compared without grouping
    anything by :func:`load_fingerprint`.
    """
    lanes = [f"_h{i}" for i in range(LANES)]
    hashed = df.select(*[h.alias(n) for n, h in zip(lanes, row_lanes(list(cols or df.columns)))])
    per_row = hashed.groupBy(*lanes).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(
        F.sum("n").alias("rijen"),
        F.count(F.lit(1)).alias("unieke_rijen"),
        F.sum(F.col("n") - 1).alias("dubbele_rijen"),
        F.count_if(F.col("n") > 1).alias("dubbele_groepen"),
    ).select(F.lit(name).alias("tabel"), F.coalesce("rijen", F.lit(0)).alias("rijen"), "unieke_rijen",
             F.coalesce("dubbele_rijen", F.lit(0)).alias("dubbele_rijen"), "dubbele_groepen")


def key_duplicates(df: DataFrame, name: str, key: str) -> DataFrame:
    """Q2: dimension keys that occur more than once (a LEFT/inner join would multiply facts)."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("aantal"))
        .filter(F.col("aantal") > 1)
        .select(F.lit(name).alias("tabel"), F.col(key).cast("string").alias("sleutel"), "aantal")
    )


# reasons for which the load leaves a fact out, in the order in which they are told
REASONS_DAYS = ("maand", "contract")
REASONS_SICK = ("maand", "contract", "functie", "eenheid", "medewerker", "percentage")


def reconciliation(t: Tables, years: ReportYears, opts: MartOptions, mart: DataFrame) -> DataFrame:
    """Q3: per year, the raw facts' employment and sick days, what the load excludes (``uit``, and a
    figure per reason; a fact counts under its first one: month, contract, function, org unit,
    employee, no sickness percentage) and the mart's totals; ``sluit`` if facts less exclusions
    equal the mart.

    Exclusions are found by existence of a kept key, apart from the load's joins, so a join that
    loses or multiplies rows shows."""
    zero = F.lit(0).cast("decimal(28,6)")

    def kept(df: DataFrame, key: str) -> DataFrame:
        return df.select(F.col(key), F.lit(True).alias(f"_{key}")).distinct()

    months = kept(S.calendar(t), "maand_id")
    contracts = kept(S.contracts_kept(t, opts), "dienstverband_id")
    functions = kept(S.functions_kept(t, opts), "medewerker_functie_id")
    units = kept(S.org_units_kept(t, opts), "organisatie_eenheid_id")
    people = kept(t.dim_medewerkers, "medewerker_id")

    def facts(fact: DataFrame, days: str, name: str, reasons: Sequence[str], keys: Sequence[DataFrame], more: Column | None = None) -> DataFrame:
        tests = [] if more is None else [more]
        for k in reversed(keys):
            tests.insert(0, F.col(k.columns[1]))
            fact = fact.join(k, k.columns[0], "left")
        reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(r)) for ok, r in zip(tests, reasons)])
        d = F.coalesce(F.col(days), zero)
        sums = [F.sum(F.when(reason == r, d)).alias(f"uit_{name}_{r}") for r in reasons]
        return fact.groupBy(F.floor(F.col("maand_id") / 100).cast("string").alias("jaar")).agg(
            F.sum(d).alias(f"bron_{name}"), F.sum(F.when(reason.isNotNull(), d)).alias(f"uit_{name}"), *sums)

    actual = facts(t.fact_fte_realisatie.filter((F.col("groepering_id") == opts.budget_group) & in_years("maand_id", years.both)),
                   "dienstverband_dagen", "dagen", REASONS_DAYS, [months, contracts])
    sick = facts(t.fact_fte_ziekteverzuim.filter(in_years("maand_id", years.both)), "dagen_ziek_ex_zwanger", "ziek", REASONS_SICK,
                 [months, contracts, functions, units, people], F.col("ziektepercentage") != 0)
    loaded = mart.groupBy("jaar").agg(F.sum("dienstverband_dagen").alias("mart_dagen"), F.sum("dagen_ziek_ex_zwanger").alias("mart_ziek"))
    src = actual.unionByName(sick, allowMissingColumns=True).unionByName(loaded, allowMissingColumns=True)
    names = [c for c in src.columns if c != "jaar"]
    g = src.groupBy("jaar").agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in names])
    return g.select(
        "jaar",
        *[F.col(c).cast("double").alias(c) for c in names],
        ((F.col("bron_dagen") - F.col("uit_dagen") == F.col("mart_dagen"))
         & (F.col("bron_ziek") - F.col("uit_ziek") == F.col("mart_ziek"))).alias("sluit"),
    )


def zero_denominators(calendar: DataFrame, mart: DataFrame) -> DataFrame:
    """Q4: months whose length is missing, zero or not a calendar month length (FTE would be
    NULL or wrong), and mart rows without employment days (absence % undefined)."""
    dim = F.col("aantal_dagen_maand")
    cal = calendar.agg(
        F.count_if(dim.isNull() | (dim <= 0)).alias("maanden_zonder_dagen"),
        F.count_if((dim > 0) & ~dim.between(28, 31)).alias("maanden_afwijkende_lengte"),
    )
    mrt = mart.agg(
        F.count_if(F.coalesce(F.col("dienstverband_dagen"), F.lit(0)) <= 0).alias("mart_rijen_zonder_dagen"),
        F.count(F.lit(1)).alias("mart_rijen"),
    )

    def long(df: DataFrame) -> DataFrame:
        return df.unpivot([], df.columns, "controle", "aantal")

    return long(cal).unionByName(long(mrt))


def unknown_member_rate(rows: DataFrame, cols: Sequence[str], label: str = UNKNOWN) -> DataFrame:
    """Q5: share of rows carrying the unknown member, per dimension column."""
    return rows.agg(
        F.count(F.lit(1)).alias("rijen"),
        *[F.avg(F.when(F.col(c) == label, 1.0).otherwise(0.0)).alias(f"{c}_onbekend") for c in cols],
    )


def distinct_keys(df: DataFrame, key: str, *by: str) -> DataFrame:
    """Distinct whole-number keys per group as bitmaps of 32,768 keys each (``emmer``, ``kaart``): a
    mergeable summary, exact whatever repeats, for dense keys such as a warehouse's surrogate keys.
    NULL is no key."""
    emmer = F.bitmap_bucket_number(F.col(key)).alias("emmer")
    return df.where(F.col(key).isNotNull()).groupBy(*by, emmer).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("kaart"))


def merge_keys(parts: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of several loads or years together."""
    return parts.groupBy(*by, "emmer").agg(F.bitmap_or_agg("kaart").alias("kaart"))


def count_keys(maps: DataFrame, *by: str) -> DataFrame:
    return maps.groupBy(*by).agg(F.sum(F.bitmap_count("kaart")).alias("unieke_sleutels"))


def key_counts(df: DataFrame, name: str, key: str) -> DataFrame:
    """Q2 in passing: rows and distinct keys of a dimension, without grouping its rows by key; a
    table with more rows than keys has duplicates (:func:`key_duplicates` names them)."""
    keys = distinct_keys(df, key).agg(F.coalesce(F.sum(F.bitmap_count("kaart")), F.lit(0))).scalar()
    rows = df.agg(F.count(F.lit(1)).alias("rijen"), F.count_if(F.col(key).isNull()).alias("zonder_sleutel")).select("*", keys.alias("unieke_sleutels"))
    return rows.select(F.lit(name).alias("tabel"), "rijen", "unieke_sleutels", "zonder_sleutel",
                       (F.col("rijen") - F.col("zonder_sleutel") - F.col("unieke_sleutels")).alias("dubbel"))


def times_loaded(df: DataFrame, load: DataFrame, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Q1 by fingerprints: how often a table holds exactly the rows of a load and nothing else
    (``keer``; 0 if it holds other rows, or some of them more often). Two one-row aggregates; no
    rows are grouped or shuffled."""
    cols = list(cols or df.columns)
    sums = ["rijen", *[f"som{i}" for i in range(LANES)]]
    one = load_fingerprint(load, cols).select(F.struct(*sums)).scalar()
    both = load_fingerprint(df, cols).withColumn("een", one).withColumn("k", F.expr("try_divide(rijen, een.rijen)").cast("long"))
    same = functools.reduce(operator.and_, [F.col(c).cast("decimal(38,0)") == F.col(f"een.{c}").cast("decimal(38,0)") * F.col("k") for c in sums])
    return both.select(F.lit(name).alias("tabel"), "rijen", F.when(same, F.col("k")).otherwise(F.lit(0)).alias("keer"))


# figures taken while rows pass (Q4 / Q5)
def mart_figures() -> list[Column]:
    return [F.count(F.lit(1)).alias("mart_rijen"), F.count_if(F.coalesce(F.col("dienstverband_dagen"), F.lit(0)) <= 0).alias("mart_rijen_zonder_dagen")]


def fact_figures(label: str = UNKNOWN) -> list[Column]:
    is_actual = F.col("soort") == S.ACTUAL
    return [F.count_if(is_actual).alias("feit_rijen"), *[F.count_if(is_actual & (F.col(c) == label)).alias(f"{c}_onbekend") for c in ("medewerker_id", "kostenplaats_code", "functiecode")]]


class Watch:
    """Observed figures of one load: the mart's rows as they are written, and the actual facts that
    enter it, without a scan of their own. Ready once the load has been written."""

    def __init__(self) -> None:
        self._seen = (Observation(), Observation())

    def facts(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._seen[0], *fact_figures())

    def mart(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._seen[1], *mart_figures())

    @property
    def figures(self) -> dict[str, int]:
        return {k: v for seen in self._seen for k, v in seen.get.items()}


def unmatched(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Q6: codes of ``df`` without a lookup row (anti join), with their row counts. Rows are
    counted per code before the join."""
    counts = df.groupBy(left_key).agg(F.count(F.lit(1)).alias("aantal"))
    return counts.join(lookup.select(F.col(right_key).alias(left_key)), left_key, "left_anti")
