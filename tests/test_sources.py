"""The same jobs over tables read back from storage through a SourceMap."""

from __future__ import annotations

from staffmart.operators import mart as M
from staffmart.sources.loaders import Location, SourceMap
from staffmart.sources.params import report_period


def test_source_map_round_trip(spark, fx, tmp_path):
    locations = {}
    for name, df in fx.views().items():
        path = str(tmp_path / name)
        df.write.parquet(path)
        locations[name] = Location("parquet", path)
    # one table through the catalogue instead of a path (multi-source map)
    fx.dim_medewerkers.createOrReplaceTempView("staffmart_test_medewerkers")
    locations["dim_medewerkers"] = Location("table", "staffmart_test_medewerkers")
    tables = SourceMap(locations).tables(spark)
    assert tables.fact_fte_realisatie.schema == fx.fact_fte_realisatie.schema
    years = report_period(tables.dwh_rap_periode)[1]
    a = sorted(map(tuple, M.display(M.fte_mart(tables, years)).collect()), key=repr)
    b = sorted(map(tuple, M.display(M.fte_mart(fx, years)).collect()), key=repr)
    assert a == b
    assert tables.ref_datum.count() == 36


def test_report_years_prune_partitioned_facts(spark, fx, tmp_path):
    import contextlib
    import io

    from staffmart.operators import staging as S

    path = str(tmp_path / "fact_fte_realisatie")
    fx.fact_fte_realisatie.write.partitionBy("maand_id").parquet(path)
    tables = fx.replace(fact_fte_realisatie=SourceMap({"f": Location("parquet", path)}).read(spark, "f"))
    years = report_period(tables.dwh_rap_periode)[1]
    df = S.actual_fte(tables.for_periods(years.first_month, years.last_month), years)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    scan = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PartitionFilters")]
    assert any("maand_id" in ln and "201501" in ln and "201612" in ln for ln in scan), scan
    assert df.count() == S.actual_fte(fx, years).count()
