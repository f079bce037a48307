"""Q1-Q5 by fingerprints, bitmaps and observation; exact percentage texts; report order; G6."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
from decimal import Decimal

import pytest

from staffmart.config import MartOptions
from staffmart.operators import mart as M
from staffmart.operators import quality as Q
from staffmart.plans import charts as G
from staffmart.plans import reports as R
from staffmart.plans.registry import context, queries
from staffmart.sources.params import report_period

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def loads(spark):
    one = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "b", "b"), (3, "b", "b")], "k int, x string, y string")
    return one, one.unionByName(one)


def test_fingerprints_tell_multisets_apart(spark):
    one, two = loads(spark)
    same = spark.createDataFrame([(3, "b", "b"), (2, None, "a"), (3, "b", "b"), (1, "a", None)], one.schema).repartition(3)
    assert Q.repeated_load(same, one)
    others = [
        [(1, "a", None), (2, None, "a"), (3, "b", "b")],                                   # a repeat less
        [(1, None, "a"), (2, None, "a"), (3, "b", "b"), (3, "b", "b")],                    # a value moved by one column
        [(1, "a", None), (2, None, "a"), (3, "b", "b"), (4, "b", "b")],
        [(1, "a", None), (1, "a", None), (2, None, "a"), (3, "b", "b")],                   # other repeats
    ]
    for rows in others:
        assert not Q.repeated_load(spark.createDataFrame(rows, one.schema), one)
    assert not Q.repeated_load(one.where("false"), one.where("false"))
    # two loads' fingerprints add up to that of both
    a, b = Q.load_fingerprint(one).first(), Q.load_fingerprint(two).first()
    assert tuple(b) == tuple(2 * x for x in a)


def test_times_loaded_and_duplicates_group_no_row_columns(spark):
    one, two = loads(spark)
    keer = lambda df: Q.times_loaded(df, one, "t").first()["keer"]
    assert (keer(one), keer(two), keer(two.unionByName(one)), keer(two.limit(5)), keer(one.where("false"))) == (1, 2, 3, 0, 0)
    p = plan(Q.times_loaded(two, one, "t"))
    assert "hashpartitioning" not in p and "CartesianProduct" not in p and "NestedLoop" not in p
    p = plan(Q.duplicate_load(two, "t"))
    keys = [ln.split("hashpartitioning(")[1] for ln in p.splitlines() if "hashpartitioning(" in ln]
    assert keys and all("_h0" in k and "k#" not in k.replace("_h", "") and "x#" not in k and "y#" not in k for k in keys)
    assert tuple(Q.duplicate_load(two, "t").first()) == ("t", 8, 3, 5, 3)
    assert tuple(Q.duplicate_load(one.where("false"), "t").first()) == ("t", 0, 0, 0, 0)


def test_bitmaps_count_distinct_keys_and_merge(spark):
    keys = [1, 1, 2, 32768, 32769, 65536, 10**12, -5, -5, 0, None]
    df = spark.createDataFrame([(k, i % 3) for i, k in enumerate(keys)], "k long, g int")
    want = {g: len({k for i, k in enumerate(keys) if i % 3 == g and k is not None}) for g in range(3)}
    assert {r.g: r.unieke_sleutels for r in Q.count_keys(Q.distinct_keys(df, "k", "g"), "g").collect()} == want
    halves = Q.distinct_keys(df.where("g < 2"), "k").unionByName(Q.distinct_keys(df.where("g > 0"), "k"))
    assert Q.count_keys(Q.merge_keys(halves)).first()["unieke_sleutels"] == len(set(keys) - {None})
    assert tuple(Q.key_counts(df, "t", "k").first()) == ("t", 11, 8, 1, 2)
    assert tuple(Q.key_counts(df.where("false"), "t", "k").first()) == ("t", 0, 0, 0, 0)


def test_contracts_by_relation_from_bitmaps(spark):
    facts = spark.createDataFrame([(201501, 1), (201502, 1), (201501, 2), (201601, 3), (201601, 99), (201601, None)], "maand_id int, dienstverband_id long")
    contracts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, None), (4, "c")], "dienstverband_id long, dienstbetrekking string")
    got = {(r.jaar, r.dienstbetrekking): (r.contracten, r.pct) for r in G.contracts_by_relation(facts, contracts).collect()}
    assert {k: v[0] for k, v in got.items()} == {("2015", "a"): 2, ("2015", "b"): 1, ("2016", None): 1}
    assert abs(got[("2015", "a")][1] - 200 / 3) < 1e-9
    facts_join = [ln for ln in plan(G.contracts_by_relation(facts, contracts)).splitlines() if "Join" in ln]
    assert facts_join and all("emmer" in ln for ln in facts_join)


def test_reconciliation_tells_each_reason(fx):
    years = report_period(fx.dwh_rap_periode)[1]
    rec = {r.jaar: r for r in Q.reconciliation(fx, years, MartOptions(), M.fte_mart(fx, years)).collect()}
    now = rec["2016"]
    assert now.sluit
    assert now.uit_dagen == sum(now[f"uit_dagen_{r}"] for r in Q.REASONS_DAYS) and now.uit_dagen_contract == 594.0
    assert now.uit_ziek == sum(now[f"uit_ziek_{r}"] for r in Q.REASONS_SICK)
    assert (now.uit_ziek_contract, now.uit_ziek_functie, now.uit_ziek_eenheid, now.uit_ziek_medewerker, now.uit_ziek_percentage) == (5.0, 5.0, 5.0, 5.0, 2.0)


@pytest.mark.parametrize("ziek, dagen, text", [("1", "800", "0.13"), ("97", "800", "12.13"), ("10.7", "400", "2.68"), ("-1", "800", "-0.13"), ("0", "5", "0.00"), ("5", "0", None), ("1", "3", "33.33")])
def test_control_percentage_is_rounded_half_up(spark, ziek, dagen, text):
    """A tie goes up, as in the exact cells of the pivot."""
    mart = spark.createDataFrame([("2016", "01", "KP1", Decimal(ziek), Decimal(dagen), Decimal(0))],
                                 "jaar string, maand string, kostenplaats_code string, dagen_ziek_ex_zwanger decimal(28,6), dienstverband_dagen decimal(28,6), fte_realisatie decimal(18,8)")
    assert R.control_total(mart).first().verzuim_ex_zwanger == text
    lookup = spark.createDataFrame([("KP1", "DIV A")], "kostenplaats_code string, zorgbedrijf string")
    from staffmart.config import ReportYears

    assert R.control_division(mart, lookup, ReportYears(2016, 2015), "DIV A").first().verzuim_ex_zwanger == text


ORDERS = {
    "control_total": lambda r: (r.jaar, r.divisie),
    "control_division": lambda r: (r.jaar, r.maand),
    "absence_pivot": lambda r: (r.zorgbedrijf is not None, r.zorgbedrijf or "", r.jaar, r.bron),
    "fte_pivot": lambda r: r.zorgbedrijf,
    "fte_pivot_with_total": lambda r: r.zorgbedrijf,
    "absence_rowpct_pivot": lambda r: r.zorgbedrijf,
    "kpi_lookup": lambda r: r.rap_item,
    "kpi_since": lambda r: r.rap_item,
    "relation_counts_formatie": lambda r: r.dienstbetrekking,
    "relation_counts_contracts": lambda r: r.dienstbetrekking,
    "catalogue_inventory": lambda r: (r.tabel, r.kolomnaam),
    "latest_rows": lambda r: -r.id,
    "load_feed": lambda r: [-x for x in dt.datetime.strptime(r.tijd, "%d-%m-%Y %H:%M").timetuple()[:5]],
    "two_series": lambda r: r.x,
    "seasonal_days": lambda r: r.jaar,
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_reports_come_in_their_order(spark, name):
    """O1, O2: also from several partitions."""
    rows = queries()[name](spark, SF).collect()
    assert rows and rows == sorted(rows, key=ORDERS[name])


def test_total_comes_first_where_its_label_begins_with_a_blank(spark):
    assert [r.zorgbedrijf for r in queries()["fte_pivot_with_total"](spark, SF).collect()][0] == " Mch Totaal"


def test_two_series_on_exact_moments(spark):
    t = [dt.datetime(2020, 1, 1, 15, 0, 0, 1), dt.datetime(2020, 1, 1, 15, 0, 0, 2), None]
    events = spark.createDataFrame([(1, t[0], 1, "purchase", 1.1, ""), (2, t[0], 2, "purchase", 2.2, ""), (3, t[0], 1, "view", 5.0, ""), (4, t[1], 1, "view", None, ""), (5, t[2], 1, "view", 1.0, ""),
                                    (6, t[1], 1, "error", 9.0, "")], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    rows = G.two_series(events).collect()
    assert [(r.x - 1577890800000000, r.tijd, r.a, r.b, r.a_label) for r in rows] == [(1, "2020-01-01 03:00", 3.3, 5.0, "3.30€"), (2, "2020-01-01 03:00", None, None, None)]
    assert G.two_series(events.where("false")).collect() == []


def test_queries_open_only_what_they_read(spark, tmp_path):
    """A query over events needs no other table, and no report period."""
    import shutil

    shutil.copy(f"{SF}/events.parquet", tmp_path / "events.parquet")
    assert queries()["rolling_buffer"](spark, str(tmp_path)).count() > 0
    c = context(spark, str(tmp_path))
    assert c._report == [] and c.tables.has("dim_dienstverbanden")


def test_platform_settings_stay(spark):
    from staffmart.session import session

    old = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.skewJoin.enabled")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Amsterdam")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        s = session()
        assert s.conf.get("spark.sql.session.timeZone") == "Europe/Amsterdam" and s.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
        assert s.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_results_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    rows = lambda n: sorted(map(repr, queries()[n](spark, SF).collect()))
    names = ("two_series", "daily_two_series", "service_years", "absence_pivot")
    try:
        utc = [rows(n) for n in names]
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [rows(n) for n in names] == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_watch_sees_the_load_without_a_second_scan(spark, fx):
    years = report_period(fx.dwh_rap_periode)[1]
    watch = Q.Watch()
    mart = watch.mart(M.fte_mart(fx, years, MartOptions(), watch.facts))
    rows = mart.collect()
    assert watch.figures["mart_rijen"] == len(rows) and watch.figures["feit_rijen"] == 10 and watch.figures["medewerker_id_onbekend"] == 1
    assert watch.figures["mart_rijen_zonder_dagen"] == sum((r.dienstverband_dagen or 0) <= 0 for r in rows)
    assert plan(M.fte_mart(fx, years)).count("CollectMetrics") == 0 and plan(mart).split("Initial Plan")[0].count("CollectMetrics") == 2
