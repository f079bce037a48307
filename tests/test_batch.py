from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from staffmart.config import LOAD_OK, LOAD_PROBLEM
from staffmart.plans.batch import run

SF = "/root/testdata/sf0.001"


def test_reports_from_published_mart_equal_direct_queries(spark, tmp_path):
    names = ["absence_pivot", "fte_pivot_with_total", "control_total", "quarterly_series"]
    out = run(spark, SF, str(tmp_path), names)
    qs = queries()
    for name in names:
        a = sorted((tuple(r) for r in spark.read.parquet(out[name]).collect()), key=repr)
        b = sorted((tuple(r) for r in qs[name](spark, SF).collect()), key=repr)
        assert a == b, name
    audit = spark.read.parquet(str(tmp_path / "load_audit")).collect()
    assert [r.status for r in audit] == [LOAD_OK]


def status(spark, base):
    return [r.status for r in spark.read.parquet(f"{base}/load_audit").orderBy("ts").collect()]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_current_year_refresh_keeps_previous_year(spark, tmp_path):
    base = str(tmp_path / "wh")
    names = ["fte_mart_ytd", "absence_pivot"]
    first = run(spark, SF, base, names)
    full = rows(spark.table("mart_exact"))
    old_files = {f for f in spark.table("mart_exact").inputFiles() if "jaar=2000" in f}
    pivot = rows(spark.read.parquet(first["absence_pivot"]))
    run(spark, SF, base, names, current_year_only=True)
    assert rows(spark.table("mart_exact")) == full
    assert old_files and {f for f in spark.table("mart_exact").inputFiles() if "jaar=2000" in f} == old_files
    # reports still span both report years
    assert rows(spark.read.parquet(first["absence_pivot"])) == pivot
    assert status(spark, base) == [LOAD_OK, LOAD_OK]


def years_of(spark, table):
    return {r.jaar for r in spark.table(table).select("jaar").distinct().collect()}


def test_full_refresh_drops_years_that_left_the_period(spark, tmp_path):
    from staffmart.operators.publish import publish_table

    base = str(tmp_path / "wh")
    out = run(spark, SF, base, ["control_total"])
    want = rows(spark.read.parquet(out["control_total"]))
    assert want == rows(queries()["control_total"](spark, SF))
    for name in ("mart_exact", "dwh_personeel_fte"):
        old = spark.table(name).limit(3).withColumn("jaar", F.lit("1995"))
        publish_table(old, base, name, only_its_partitions=True)
        assert "1995" in years_of(spark, name)
    # a refresh of the current year leaves the old partition, and reports do not show it
    out = run(spark, SF, base, ["control_total"], current_year_only=True)
    assert "1995" in years_of(spark, "mart_exact")
    assert rows(spark.read.parquet(out["control_total"])) == want
    out = run(spark, SF, base, ["control_total"])
    assert rows(spark.read.parquet(out["control_total"])) == want
    for name in ("mart_exact", "dwh_personeel_fte"):
        assert "1995" not in years_of(spark, name)
    assert status(spark, base) == [LOAD_OK] * 3


def test_audit_tells_a_mart_that_does_not_add_up(spark, tmp_path, monkeypatch):
    from staffmart.plans import batch

    publish = batch.publish_table
    monkeypatch.setattr(batch, "publish_table", lambda mart, *a, **kw: publish(mart.where("maand <> '03'"), *a, **kw))
    run(spark, SF, str(tmp_path), ["control_total"])
    assert status(spark, str(tmp_path)) == [LOAD_PROBLEM]


def test_a_failed_run_leaves_the_old_mart_readable(spark, tmp_path, monkeypatch):
    from staffmart.operators import mart as M

    base = str(tmp_path / "wh")
    run(spark, SF, base, ["control_total"])
    mart, public = rows(spark.table("mart_exact")), rows(spark.table("dwh_personeel_fte"))
    files = set(spark.table("mart_exact").inputFiles())
    broken = M.fte_mart
    monkeypatch.setattr(M, "fte_mart", lambda *a, **kw: broken(*a, **kw).withColumn("maand", F.when(F.col("maand") > "06", F.raise_error("stopped")).otherwise(F.col("maand"))))
    with pytest.raises(Exception, match="stopped"):
        run(spark, SF, base, ["control_total"])
    assert rows(spark.table("mart_exact")) == mart and set(spark.table("mart_exact").inputFiles()) == files
    assert rows(spark.table("dwh_personeel_fte")) == public
    assert status(spark, base) == [LOAD_OK, LOAD_PROBLEM]


def test_checks_are_observed_in_the_load_and_one_budget_mart_serves_all(spark, tmp_path, monkeypatch):
    from staffmart.operators import mart as M

    built = []
    real = M.fte_mart
    monkeypatch.setattr(M, "fte_mart", lambda t, y, o=None, *a: built.append(o.include_budget) or real(t, y, o, *a))
    names = ["control_total", "budget_vs_actual", "budget_vs_actual_by_year", "zero_denominators"]
    out = run(spark, SF, str(tmp_path), names)
    assert sorted(built) == [False, True]
    for name in names:
        assert rows(spark.read.parquet(out[name])) == rows(queries()[name](spark, SF)), name
    seen = spark.read.parquet(str(tmp_path / "load_audit")).first()
    checks = {r.controle: r.aantal for r in queries()["zero_denominators"](spark, SF).collect()}
    assert seen.rijen == seen.controles["mart_rijen"] == checks["mart_rijen"]
    assert seen.controles["mart_rijen_zonder_dagen"] == checks["mart_rijen_zonder_dagen"]
    rate = queries()["unknown_member_rate"](spark, SF).first()
    assert seen.controles["feit_rijen"] == rate.rijen
    assert seen.controles["medewerker_id_onbekend"] == round(rate.medewerker_id_onbekend * rate.rijen)


def test_batch_over_tables_from_storage(spark, fx, tmp_path):
    """The warehouse's own codes and a SourceMap instead of the synthetic binding."""
    from staffmart.config import MartOptions
    from staffmart.plans.registry import context_for
    from staffmart.sources.loaders import Location, SourceMap

    locations = {}
    for name, df in fx.views().items():
        df.write.parquet(str(tmp_path / "src" / name))
        locations[name] = Location("parquet", str(tmp_path / "src" / name))
    tables = SourceMap(locations).tables(spark)
    out = run(spark, base=str(tmp_path / "wh"), ctx=context_for(tables, MartOptions()))
    assert "daily_bars" not in out and "absence_pivot" in out
    pivot = spark.read.parquet(out["absence_pivot"]).filter("zorgbedrijf = 'DIV A' AND bron = 'zv' AND jaar = '2016'")
    assert str(pivot.collect()[0].verzuim_januari) == "7.69"
    audit = spark.read.parquet(str(tmp_path / "wh" / "load_audit")).collect()
    assert [r.status for r in audit] == [LOAD_OK]


def test_sql_views(spark):
    from staffmart.plans.registry import context
    from staffmart.plans.views import register_views

    names = register_views(context(spark, SF), prefix="sm_")
    assert "sm_dwh_personeel_fte" in names and "sm_absence_pivot" in names
    n = spark.sql("SELECT count(*) FROM sm_absence_pivot WHERE bron = 'zvc'").collect()[0][0]
    assert n == queries()["absence_pivot"](spark, SF).filter("bron = 'zvc'").count() > 0
