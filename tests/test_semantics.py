"""Each warehouse rule on hand-written fixtures (tests/fixtures.py)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from staffmart.config import FTE_TOTAL_LABEL, TOTAL_LABEL, UNKNOWN, MartOptions
from staffmart.operators import mart as M
from staffmart.operators import staging as S
from staffmart.plans import reports as R
from staffmart.sources.params import report_period


@pytest.fixture(scope="module")
def years(fx):
    return report_period(fx.dwh_rap_periode)[1]


@pytest.fixture(scope="module")
def mart(fx, years):
    return M.fte_mart(fx, years)


@pytest.fixture(scope="module")
def display(mart):
    return {
        (r.jaar, r.maand, r.medewerker_id, r.kostenplaats_code, r.functie_code): r
        for r in M.as_doubles(M.display(mart)).collect()
    }


def test_report_years_on_leap_day(fx, years):
    assert (years.current, years.previous) == (2016, 2015)
    end, ys = report_period(fx.dwh_rap_periode)
    assert end == dt.date(2016, 2, 29) and ys == years


def test_report_period_needs_exactly_one_row(fx):
    with pytest.raises(ValueError):
        report_period(fx.dwh_rap_periode.unionByName(fx.dwh_rap_periode))


def test_actuals_unknown_members_and_exclusions(fx, years):
    rows = S.actual_fte(fx, years).collect()
    keys = {(r.medewerker_id, r.dienstverband_id, r.kostenplaats_code, r.functiecode, r.periode) for r in rows}
    # excluded function and cluster are kept under the unknown member (LEFT JOIN with ON filter)
    assert ("1", "100", "KP1", UNKNOWN, 201601) in keys
    assert ("1", "100", UNKNOWN, "F1", 201601) in keys
    assert (UNKNOWN, "100", "KP1", "F1", 201601) in keys
    # NULL worker type kept; excluded/NULL employer, relation, trainee and NULL contract dropped
    assert ("2", "105", "KP1", "F1", 201602) in keys
    assert not any(r.dienstverband_id in ("101", "102", "103", "104", "106", UNKNOWN) for r in rows)
    # other group and months two years back are filtered
    assert not any(r.periode == 201401 for r in rows)
    assert sum(r.dienstverband_dagen for r in rows) == 31 + 10 + 31 + 5 + 7 + 3 + 29 + 31 + 31 + 30
    jan = [r for r in rows if r.periode == 201601 and r.kostenplaats_code == "KP1" and r.functiecode == "F1"
           and r.medewerker_id == "1"]
    assert len(jan) == 1 and jan[0].realisatie == pytest.approx(1.0)
    assert jan[0].jaar == "2016" and jan[0].maandnummer == "1"


def test_sick_days_drop_on_inner_joins(fx, years):
    rows = {(r.periode, r.kostenplaats_code, r.functiecode, r.medewerker_id): r.dagen_ziek_ex_zwanger
            for r in S.sick_days(fx, years).collect()}
    assert rows == {
        ("201601", "KP1", "F1", "1"): 3.0,   # 2 + 1 (NULL worker type kept)
        ("201602", "KP1", "F1", "1"): 4.0,
        ("201601", None, "F1", "1"): 3.0,
        ("201603", None, "F1", "1"): 1.0,
    }


def test_budget_drops_excluded(fx, years):
    rows = S.budget_fte(fx, years).collect()
    assert len(rows) == 1
    assert rows[0].formatie == pytest.approx(2.0) and rows[0].periode == 201601


def test_mart_ytd_sparse_months(display):
    k = lambda m: ("2016", m, "1", "KP1", "F1")
    jan, feb, mar, dec = display[k("01")], display[k("02")], display[k("03")], display[k("12")]
    # February has only absence: a stacked row with zero employment days
    assert feb.dienstverband_dagen == 0 and feb.dagen_ziek_ex_zwanger == 4 and feb.fte_realisatie == 0
    # year-to-date monthly average: running sum / month number (missing months count 0)
    assert jan.fte_realisatie_cum == pytest.approx(1.0)
    assert feb.fte_realisatie_cum == pytest.approx(0.5)
    assert mar.fte_realisatie_cum == pytest.approx((1 + 10 / 31) / 3)
    assert dec.fte_realisatie_cum == pytest.approx((1 + 10 / 31 + 1) / 12)
    assert jan.dagen_ziek_ex_zwanger_cum == pytest.approx(3.0)
    assert feb.dagen_ziek_ex_zwanger_cum == pytest.approx(7 / 2)
    assert dec.dagen_ziek_ex_zwanger_cum == pytest.approx(7 / 12)
    assert dec.dienstverband_dagen_cum == pytest.approx(72 / 12)


def test_null_cost_centre_keeps_initial_values(display):
    jan = display[("2016", "01", "1", None, "F1")]
    mar = display[("2016", "03", "1", None, "F1")]
    assert jan.dagen_ziek_ex_zwanger == 3 and mar.dagen_ziek_ex_zwanger == 1
    # no running sum for a key with NULL: sick/days cum stay 0, FTE cum is own FTE / month
    assert mar.dagen_ziek_ex_zwanger_cum == 0 and mar.dienstverband_dagen_cum == 0
    assert mar.fte_realisatie_cum == 0


def test_window_equals_triangular_self_join(fx, years):
    totals = M.mart_totals(fx, years)
    a = {tuple(r) for r in M.display(M.with_ytd(totals)).collect()}
    b = {tuple(r) for r in M.display(M.ytd_by_self_join(totals)).collect()}
    assert a == b


def test_stacked_total_equals_sum_of_facts(fx, years, mart):
    tot = mart.agg({"dienstverband_dagen": "sum", "dagen_ziek_ex_zwanger": "sum"}).collect()[0]
    assert tot["sum(dienstverband_dagen)"] == Decimal(31 + 10 + 31 + 5 + 7 + 3 + 29 + 31 + 31 + 30)
    assert tot["sum(dagen_ziek_ex_zwanger)"] == Decimal(3 + 4 + 3 + 1)


def test_budget_into_mart_lands_on_unknown_employee(fx, years):
    m = M.as_doubles(M.display(M.fte_mart(fx, years, MartOptions(include_budget=True))))
    rows = m.filter("fte_begroot > 0").collect()
    assert [(r.medewerker_id, r.kostenplaats_code, r.functie_code, r.maand) for r in rows] == [
        (UNKNOWN, "KP1", "F1", "01")
    ]
    assert rows[0].fte_begroot == pytest.approx(2.0)


def test_absence_monthly_populations(fx, mart):
    rows = {(r.divisie, r.jaar, r.maand): r for r in R.absence_monthly(mart, fx.dwh_budgetplaatsen).collect()}
    # total covers every row, including cost centres without a division and the NULL cost centre
    tot = rows[(TOTAL_LABEL, "2016", "01")]
    days_jan = 31 + 5 + 7 + 3 + 31 + 31  # KP1 F1, KP1 Onbekend fn, Onbekend kp, Onbekend emp, KP3, KP4
    assert tot.zv == pytest.approx((2 + 1 + 3) / days_jan * 100)
    # division A: KP1 only
    a = rows[("DIV A", "2016", "01")]
    assert a.zv == pytest.approx(3 / (31 + 5 + 3) * 100)
    # KP4 maps to a NULL division: kept as its own group; KP3 (no lookup row) only in the total
    assert (None, "2016", "01") in rows
    assert not any(k[0] == "KP3" for k in rows)
    # February: employee 1 has only absence, employee 2 the employment days
    assert rows[("DIV A", "2016", "02")].zv == pytest.approx(4 / 29 * 100)


def test_zero_denominator_is_null_not_error(spark):
    from staffmart.functions.columns import ratio_pct

    df = spark.createDataFrame([(Decimal("4"), Decimal("0")), (Decimal("1"), None)], "a decimal(18,6), b decimal(18,6)")
    assert [r[0] for r in df.select(ratio_pct("a", "b")).collect()] == [None, None]


def test_absence_pivot_layout(fx, mart, years):
    p = R.absence_pivot(mart, fx.dwh_budgetplaatsen, years)
    assert p.columns[:3] == ["zorgbedrijf", "jaar", "bron"] and len(p.columns) == 15
    rows = p.collect()
    assert {r.bron for r in rows} == {"zv", "zvc"}
    a = [r for r in rows if r.zorgbedrijf == "DIV A" and r.bron == "zv" and r.jaar == "2016"][0]
    assert a.verzuim_april is None and a.verzuim_januari == Decimal("7.69")


def test_fte_pivot_total_and_filters(fx, mart):
    rows = {r.zorgbedrijf: r for r in R.fte_pivot_with_total(mart, fx.dwh_budgetplaatsen, 2016).collect()}
    assert set(rows) == {"DIV A", FTE_TOTAL_LABEL}   # NULL division filtered, KP3 has none
    assert rows["DIV A"].jan == Decimal("1.26")     # 39 / 31
    assert rows["DIV A"].apr == 0
    assert rows[FTE_TOTAL_LABEL].jan == rows["DIV A"].jan


def test_row_percentages_round_half_up(spark):
    from staffmart.operators.pivots import pct_cents_half_up

    df = spark.createDataFrame(
        [(Decimal("1"), Decimal("8")), (Decimal("0.17"), Decimal("8")), (Decimal("2"), Decimal("0")),
         (Decimal("1"), Decimal("3"))],
        "a decimal(18,6), b decimal(18,6)",
    )
    got = [r[0] for r in df.select(pct_cents_half_up("a", "b")).collect()]
    assert got == [1250, 213, None, 3333]   # 12.50, 2.125 -> 2.13, 0 days -> NULL, 33.33


def test_rowpct_reports(fx, mart):
    r8 = R.absence_rowpct_total(mart, 2016).collect()
    # January rows with days > 0: KP1/F1 3/31, and zero-sick rows
    assert r8[0].jan == Decimal("9.68")
    r7 = {r.zorgbedrijf: r for r in R.absence_rowpct_pivot(mart, fx.dwh_budgetplaatsen, 2016).collect()}
    assert r7["DIV A"].feb == 0 and r7["DIV A"].jan == Decimal("9.68")


def test_relation_counts_and_enrich(fx):
    counts = {(r.dienstbetrekking, r.omschrijving): r.aantal
              for r in R.relation_counts(fx.afas_mdw_formatie, fx.afas_dienstbetrekking).collect()}
    assert counts == {("01", "Vast"): 2, ("07", None): 1, (None, None): 1}
    enriched = {r.dienstverband_id: r.dienstbetrekking_oms
                for r in R.relation_enrich(fx.dim_dienstverbanden, fx.afas_dienstbetrekking).collect()}
    assert enriched[100] == "Vast" and enriched[103] is None and enriched[104] is None


def test_fte_divides_exact_days_by_any_month_length(spark, fx, years):
    """A month of 22 days: full days are one FTE, and a month is divided once."""
    cal = fx.ref_datum.withColumn("aantal_dagen_maand", F.when(F.col("maand_id") == 201601, 22).otherwise(F.col("aantal_dagen_maand")))
    t = fx.replace(ref_datum=cal)
    rows = [r for r in S.actual_fte(t, years).collect() if r.periode == 201601]
    assert rows and all(r.realisatie == float((Decimal(str(r.dienstverband_dagen)) / 22).quantize(Decimal("0.00000001"))) for r in rows)
    full = t.replace(fact_fte_realisatie=t.fact_fte_realisatie.withColumn("dienstverband_dagen", F.lit(22).cast("decimal(18,6)")))
    assert {r.realisatie % 1 for r in S.actual_fte(full, years).collect() if r.periode == 201601} == {0.0}


def test_published_columns_and_cells_are_decimals(fx, years, mart):
    kinds = dict(M.display(mart).dtypes)
    assert kinds["fte_realisatie"] == kinds["fte_realisatie_cum"] == kinds["dagen_ziek_ex_zwanger_cum"] == "decimal(18,8)"
    assert kinds["dienstverband_dagen"] == kinds["dagen_ziek_ex_zwanger"] == "decimal(18,6)"
    lookup, year = fx.dwh_budgetplaatsen, years.current
    for df in (R.absence_pivot(mart, lookup, years), R.fte_pivot(mart, lookup, year), R.fte_pivot_with_total(mart, lookup, year),
               R.absence_rowpct_pivot(mart, lookup, year), R.absence_total_pivot(mart, year)):
        assert {t for c, t in df.dtypes if c not in ("zorgbedrijf", "divisie", "jaar", "bron")} == {"decimal(18,2)"}


def test_update_never_adds_rows(fx):
    lookup = fx.afas_dienstbetrekking
    double = lookup.unionByName(lookup.withColumn("omschrijving", F.lit(None).cast("string"))).unionByName(lookup.withColumn("omschrijving", F.lit("zzz")))
    rows = lambda lk: sorted(map(tuple, R.relation_enrich(fx.dim_dienstverbanden, lk).collect()), key=repr)
    assert rows(double) == rows(lookup) and len(rows(lookup)) == fx.dim_dienstverbanden.count()
