"""Properties over the smallest given data set, and the skewed-join path."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from staffmart.operators import mart as M
from staffmart.operators import staging as S
from staffmart.plans import registry as RG
from staffmart.plans import reports as R

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ctx(spark):
    return RG.context(spark, SF)


def test_pivot_then_unpivot_is_identity(ctx):
    """Unpivoting the month pivot (R4) gives back the monthly figures (R3), rounded to cells."""
    monthly = R.absence_monthly(ctx.mart(), ctx.tables.dwh_budgetplaatsen).filter(
        F.col("jaar").cast("int").isin(list(ctx.years.both))
    )
    pivot = R.absence_pivot(ctx.mart(), ctx.tables.dwh_budgetplaatsen, ctx.years)
    months = {c: i + 1 for i, c in enumerate(R.ABSENCE_COLUMNS)}
    back = pivot.unpivot(["zorgbedrijf", "jaar", "bron"], list(R.ABSENCE_COLUMNS), "kolom", "waarde").filter(
        F.col("waarde").isNotNull()
    )
    got = {(r.zorgbedrijf, r.jaar, r.bron, months[r.kolom]): float(r.waarde) for r in back.collect()}
    want = {}
    for r in monthly.collect():
        for bron in ("zv", "zvc"):
            if r[bron] is not None:
                want[r.divisie, r.jaar, bron, int(r.maand)] = r[bron]
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 0.005 + 1e-9 for k in got)


def test_december_ytd_is_the_year_total(ctx):
    m = ctx.mart()
    keys = ["medewerker_id", "kostenplaats_code", "functie_code", "jaar"]
    year = m.groupBy(*keys).agg(F.sum("dienstverband_dagen").alias("y"), F.sum("dagen_ziek_ex_zwanger").alias("z"))
    dec = m.filter(F.col("maand") == "12").select(*keys, "dienstverband_dagen_ytd", "dagen_ziek_ex_zwanger_ytd")
    rows = dec.join(year, keys).collect()
    assert rows
    assert all(r.dienstverband_dagen_ytd == r.y and r.dagen_ziek_ex_zwanger_ytd == r.z for r in rows)


def test_hot_key_through_sort_merge_skew_join(spark, ctx):
    """One function holds a third of the actual rows; with broadcasts off and a tiny skew
    threshold the joins run as sort-merge joins that AQE splits, and the result is unchanged."""
    t = ctx.period
    hot = t.fact_fte_realisatie.withColumn(
        "medewerker_functie_id",
        F.when(F.col("dienstverband_dagen") < 17, F.lit(1)).otherwise(F.col("medewerker_functie_id")),
    )
    skewed = t.replace(fact_fte_realisatie=hot)
    expected = sorted(map(tuple, S.actual_fte_by_function(skewed, ctx.years, ctx.options).collect()), key=repr)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        # keep the tiny test partitions apart so the hot one stands out
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = S.actual_fte_by_function(skewed, ctx.years, ctx.options)
        got = sorted(map(tuple, df.collect()), key=repr)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        final_plan = buf.getvalue()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected
    assert "isFinalPlan=true" in final_plan and "SortMergeJoin(skew=true)" in final_plan
