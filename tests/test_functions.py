from __future__ import annotations

from pyspark.sql import functions as F

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from staffmart.functions import columns as C
from staffmart.functions import formatting as FM
from staffmart.operators.pivots import pct_cents_half_up
from staffmart.plans.charts import function_grid


def test_fte_exact(spark):
    df = spark.createDataFrame([(Decimal("10"), 31), (Decimal("29"), 29), (Decimal("1"), 0), (Decimal("22"), 22), (Decimal("0.000001"), 28), (None, 30)],
                               "d decimal(18,6), n int")
    out = [r[0] for r in df.select(C.fte("d", "n")).collect()]
    assert out[:5] == [Decimal("0.32258065"), Decimal("1.00000000"), None, Decimal("1.00000000"), Decimal("0.00000004")] and out[5] is None


def test_monthly_average(spark):
    df = spark.createDataFrame([(Decimal("1.5"), "03"), (Decimal("1"), "07"), (Decimal("1"), "00")], "d decimal(18,8), m string")
    assert [r[0] for r in df.select(C.monthly_average("d", "m")).collect()] == [Decimal("0.50000000"), Decimal("0.14285714"), None]


def test_unknown_member_and_not_in(spark):
    df = spark.createDataFrame([(None,), ("a",), ("x",)], "c string")
    assert [r[0] for r in df.select(C.unknown_member("c")).collect()] == ["Onbekend", "a", "x"]
    # NOT IN with NULL is unknown: the filter drops it
    assert [r[0] for r in df.filter(C.not_in("c", ["x"])).collect()] == ["a"]
    assert [r[0] for r in df.filter(C.not_in_or_null("c", ["x"])).collect()] == [None, "a"]


def test_period_key_and_years(spark):
    df = spark.createDataFrame([(2016, 3, 201603), (2016, 12, 201512)], "j int, m int, id int")
    rows = df.select(C.period_key("j", "m"), C.in_years("id", [2016])).collect()
    assert [tuple(r) for r in rows] == [("201603", True), ("201612", False)]


def test_formatting(spark):
    df = spark.createDataFrame([(Decimal("1234567.5"), 12.345, dt.datetime(2016, 3, 4, 15, 32))],
                               "n decimal(18,2), p double, t timestamp")
    r = df.select(FM.thousands("n"), FM.percent_2(F.lit(1235)), FM.date_label("t"), FM.datetime_label_12h("t"),
                  FM.with_unit("p", 4, "€"), FM.day_label("t")).collect()[0]
    assert tuple(r) == ("1,234,568", "12.35", "2016-03-04", "2016-03-04 03:32", "12.3450€", "03/04")
    neg = spark.createDataFrame([(Decimal("-0.5"),), (Decimal("0.5"),)], "n decimal(18,2)")
    assert [x[0] for x in neg.select(FM.thousands("n")).collect()] == ["-1", "1"]


def test_clamp_and_epoch(spark):
    df = spark.createDataFrame([(-3.0,), (50.0,), (130.0,), (None,)], "v double")
    assert [r[0] for r in df.select(FM.clamp("v")).collect()] == [0.0, 50.0, 100.0, None]
    e = spark.createDataFrame([(1354521600000,)], "ms long").select(FM.day_label(FM.epoch_ms_to_ts("ms")))
    assert e.collect()[0][0] == "12/03"


def test_function_grid(spark):
    rows = function_grid(spark).collect()
    assert len(rows) == 60 and rows[-1].x == 59 * 0.2
    assert abs(rows[5].sin - __import__("math").sin(1.0)) < 1e-12


@settings(max_examples=60, deadline=None)
@given(st.integers(min_value=-10**9, max_value=10**9), st.integers(min_value=1, max_value=10**9))
def test_pct_cents_half_up_matches_decimal(spark_session_for_hypothesis, a, b):
    num, den = Decimal(a) / 1000, Decimal(b) / 1000
    expected = (num / den * 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) * 100
    got = (
        spark_session_for_hypothesis.createDataFrame([(num, den)], "a decimal(18,6), b decimal(18,6)")
        .select(pct_cents_half_up("a", "b"))
        .collect()[0][0]
    )
    assert got == int(expected)


def test_pct_cents_brute_force_table(spark):
    rows = [(Decimal(a) / 4, Decimal(b) / 4) for a in range(0, 40) for b in range(1, 40)]
    df = spark.createDataFrame(rows, "a decimal(18,6), b decimal(18,6)")
    got = [r[0] for r in df.select(pct_cents_half_up("a", "b")).collect()]
    want = [int((a / b * 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) * 100) for a, b in rows]
    assert got == want


def test_report_month_helpers():
    from staffmart.plans.registry import _months_before, report_month

    assert report_month(dt.date(2001, 8, 1)) == dt.date(2001, 7, 31)
    assert report_month(dt.date(2016, 8, 31)).strftime("%Y%m") == "201608"
    assert _months_before(dt.date(2016, 8, 31), 3) == 201605
    assert _months_before(dt.date(2016, 2, 29), 3) == 201511
    assert _months_before(dt.date(2016, 1, 15), 12) == 201501
