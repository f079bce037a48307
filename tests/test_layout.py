"""Stored layouts: no fact-sized exchange, months pruned at run time, counts from the catalogue; and
tables of two databases in one plan (S3)."""

from __future__ import annotations

import contextlib
import io

import pytest

from staffmart.operators import layout
from staffmart.operators import staging as S
from staffmart.plans import reports as R
from staffmart.plans.registry import OPTIONS, context
from staffmart.sources.loaders import Location, SourceMap, inventory, stored_inventory, stored_rows

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def c(spark):
    return context(spark, SF)


@pytest.fixture()
def small_dimensions_only(spark):
    """Contracts too large to broadcast, the other dimensions not."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "12000")
    yield
    spark.conf.set(key, old)


def test_bucketed_facts_meet_contracts_without_an_exchange(spark, tmp_path, small_dimensions_only):
    c = context(spark, "/root/testdata/sf0.01")
    t = layout.store_bucketed(c.period, str(tmp_path), "tb1_", buckets=4)
    # the other dimensions from storage too, so that their true sizes are known
    for name in ("dim_organisatie_eenheid", "ref_datum", "dim_medewerker_functies", "dim_medewerkers"):
        getattr(t, name).coalesce(1).sortWithinPartitions(*getattr(t, name).columns[:1]).write.option("compression", "gzip").parquet(str(tmp_path / name))
    small = {n: spark.read.parquet(str(tmp_path / n)) for n in ("dim_organisatie_eenheid", "ref_datum", "dim_medewerker_functies", "dim_medewerkers")}
    t = layout.with_stored(t, small)
    for job in (S.actual_fte, S.sick_days):
        df = job(t, c.years, OPTIONS)
        p = plan(df, "simple")
        join = next(ln for ln in p.splitlines() if "SortMergeJoin [dienstverband_id" in ln)
        below = p.splitlines()[p.splitlines().index(join) + 1:]
        assert not any("Exchange hashpartitioning(dienstverband_id" in ln for ln in below), p
        assert p.count("Bucketed: true") + plan(df).count("SelectedBucketsCount") >= 2
        assert rows(df) == rows(job(c.period, c.years, OPTIONS))


def test_months_are_pruned_by_the_calendar_at_run_time(spark, c, tmp_path):
    t = layout.store_by_month(c.tables, str(tmp_path), "tm1_", ["fact_fte_realisatie"])
    df = R.seasonal_days(t, OPTIONS, (1, 2))
    assert "dynamicpruning" in plan(df)
    assert rows(df) == rows(R.seasonal_days(c.tables, OPTIONS, (1, 2)))
    scan = df._jdf.queryExecution().executedPlan()
    df.collect()
    months = t.fact_fte_realisatie.select("maand_id").distinct().count()
    read = t.fact_fte_realisatie.where("maand_id % 100 <= 2").select("maand_id").distinct().count()
    text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert scan is not None and read < months and "dynamicpruning" in text


def test_inventory_from_stored_counts(spark, c, tmp_path):
    names = layout.store_analyzed(c.tables, str(tmp_path), "ti1_")
    df = stored_inventory(spark, names)
    assert "FileScan" not in plan(df, "simple")
    assert rows(df) == rows(inventory(c.tables.views()))
    spark.sql(f"CREATE TABLE ti1_none (a int) USING parquet LOCATION '{tmp_path}/none'")
    assert stored_rows(spark, "ti1_none") is None
    assert [tuple(r) for r in stored_inventory(spark, {"none": "ti1_none"}).collect()] == [("none", "a", "int", 4, None)]


def test_tables_of_two_databases_in_one_plan(spark, fx, tmp_path):
    from staffmart.config import MartOptions
    from staffmart.plans.registry import context_for

    for db in ("ezis_feiten", "ezis_stam"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path}/{db}'")
    places = {}
    for name, df in fx.views().items():
        db = "ezis_feiten" if name.startswith("fact") else "ezis_stam"
        df.write.option("path", f"{tmp_path}/{db}/{name}").saveAsTable(f"spark_catalog.{db}.{name}")
        places[name] = Location("table", f"spark_catalog.{db}.{name}")
    two = context_for(SourceMap(places).tables(spark), MartOptions())
    one = context_for(fx, MartOptions())
    assert two.years == one.years
    assert rows(two.mart()) == rows(one.mart())
    files = two.mart().inputFiles()
    assert any("/ezis_feiten/" in f for f in files) and any("/ezis_stam/" in f for f in files)
    assert rows(R.absence_pivot(two.mart(), two.tables.dwh_budgetplaatsen, two.years)) == rows(R.absence_pivot(one.mart(), one.tables.dwh_budgetplaatsen, one.years))
