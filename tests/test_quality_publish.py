from __future__ import annotations

import datetime as dt

from staffmart.config import MartOptions
from staffmart.operators import mart as M
from staffmart.operators import publish as P
from staffmart.operators import quality as Q
from staffmart.operators import staging as S
from staffmart.sources.loaders import inventory
from staffmart.sources.params import report_period


def test_duplicate_load_fires_on_double_load(fx):
    once = Q.duplicate_load(fx.dim_dienstverbanden, "dim").collect()[0]
    assert (once.rijen, once.unieke_rijen, once.dubbele_rijen) == (7, 7, 0)
    twice = Q.duplicate_load(fx.dim_dienstverbanden.unionByName(fx.dim_dienstverbanden), "dim").collect()[0]
    assert twice.rijen == 2 * twice.unieke_rijen == 14 and twice.dubbele_groepen == 7


def test_key_duplicates(fx):
    assert Q.key_duplicates(fx.dim_medewerkers, "m", "medewerker_id").count() == 0
    dup = Q.key_duplicates(fx.dim_medewerkers.unionByName(fx.dim_medewerkers.limit(1)), "m", "medewerker_id")
    assert [(r.sleutel, r.aantal) for r in dup.collect()] == [("1", 2)]


def test_reconciliation_and_rates(fx):
    years = report_period(fx.dwh_rap_periode)[1]
    mart = M.fte_mart(fx, years)
    rec = Q.reconciliation(fx, years, MartOptions(), mart).collect()
    assert rec and all(r.sluit for r in rec) and any(r.uit_dagen > 0 for r in rec) and any(r.uit_ziek > 0 for r in rec)
    # a dimension key that occurs twice multiplies facts in the mart: the raw facts tell
    twice = fx.replace(dim_medewerker_functies=fx.dim_medewerker_functies.unionByName(fx.dim_medewerker_functies))
    assert not all(r.sluit for r in Q.reconciliation(twice, years, MartOptions(), M.fte_mart(twice, years)).collect())
    rate = Q.unknown_member_rate(S.actual_rows(fx, years), ["medewerker_id", "kostenplaats_code"]).collect()[0]
    assert rate.rijen == 10 and rate.medewerker_id_onbekend == 0.1


def test_zero_denominators(spark, fx):
    years = report_period(fx.dwh_rap_periode)[1]
    bad_cal = fx.ref_datum.unionByName(spark.createDataFrame([(201713, 2017, 13, 0), (201714, 2017, 14, 27)],
                                                             fx.ref_datum.schema))
    out = {r.controle: r.aantal for r in Q.zero_denominators(bad_cal, M.fte_mart(fx, years)).collect()}
    assert out["maanden_zonder_dagen"] == 1 and out["maanden_afwijkende_lengte"] == 1
    assert out["mart_rijen_zonder_dagen"] >= 1


def test_unmatched(fx):
    rows = {r.dienstbetrekking: r.aantal for r in
            Q.unmatched(fx.afas_mdw_formatie, fx.afas_dienstbetrekking, "dienstbetrekking", "tabelwaarde_code").collect()}
    assert rows == {"07": 1, None: 1}


def test_publish_append_truncate_update(spark, fx, tmp_path):
    years = report_period(fx.dwh_rap_periode)[1]
    mart = M.display(M.fte_mart(fx, years), with_load_time=True)
    path = str(tmp_path / "mart")
    P.publish_mart(mart, path)
    back = spark.read.parquet(path)
    assert back.count() == mart.count() and {r.jaar for r in back.select("jaar").distinct().collect()} == {2015, 2016}
    # republishing one year replaces only that partition
    P.publish_mart(mart.filter("jaar = '2016'").limit(1), path, only_its_years=True)
    assert spark.read.parquet(path).filter("jaar = 2015").count() == mart.filter("jaar = '2015'").count()
    assert spark.read.parquet(path).filter("jaar = 2016").count() == 1

    t = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    P.append(df, t)
    P.append(df, t)
    assert spark.read.parquet(t).count() == 4
    P.truncate(spark, t, df.schema)
    assert spark.read.parquet(t).count() == 0 and spark.read.parquet(t).schema == df.schema

    upd = P.update_from(df, spark.createDataFrame([(2, None), (3, "z")], "k int, v string"), ["k"], ["v"])
    assert sorted(tuple(r) for r in upd.collect()) == [(1, "a"), (2, None)]


def test_load_audit_feed(spark, tmp_path):
    path = str(tmp_path / "audit")
    for i in range(10):
        P.record_load(spark, path, "mart", 100 + i, ok=i != 9, now=dt.datetime(2016, 3, 1, 8, i))
    feed = P.load_feed(spark, path).collect()
    assert len(feed) == 8 and feed[0].status == "Probleem laden data" and feed[0].rijen == 109
    assert [r.ts.minute for r in feed] == list(range(9, 1, -1))


def test_inventory(fx):
    inv = inventory({"dim_medewerkers": fx.dim_medewerkers, "ref_datum": fx.ref_datum}, "%REF%").collect()
    assert {r.kolomnaam for r in inv} == {"maand_id", "jaar", "maandnummer", "aantal_dagen_maand"}
    assert {r.rijen for r in inv} == {36} and {r.length for r in inv} == {4}
    assert [r.kolomnaam for r in inv] == sorted(r.kolomnaam for r in inv)


def test_materialize_views_and_report_cells(spark, fx, tmp_path):
    from staffmart.functions.formatting import report_decimal

    spark.conf.set("staffmart.warehouse.dir", str(tmp_path / "wh"))
    try:
        back = P.materialize(spark, fx.ref_datum, "ref_datum_copy")
        assert back.count() == 36 and str(tmp_path / "wh") in back.inputFiles()[0]
    finally:
        spark.conf.unset("staffmart.warehouse.dir")
    cell = spark.createDataFrame([(12.345,)], "v double").select(report_decimal("v")).collect()[0][0]
    assert str(cell) == "12.35"
