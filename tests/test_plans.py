"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import contextlib
import io

import pytest

from staffmart.plans.registry import WRITERS, queries

SF = "/root/testdata/sf0.01"


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def qs():
    return queries()


def test_mart_pushes_filters_and_prunes_columns(spark, qs):
    p = plan(qs["fte_mart_ytd"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p
    assert "EqualTo(l_returnflag,R)" in p
    lineitem_schemas = [ln for ln in p.splitlines() if ln.startswith("ReadSchema: struct<l_")]
    assert lineitem_schemas and all("l_extendedprice" not in ln for ln in lineitem_schemas)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_mart_has_one_window_and_two_mart_exchanges(spark, qs):
    p = plan(qs["fte_mart_ytd"](spark, SF), "simple")
    assert p.count("Window [") == 1
    # one exchange for the mart aggregation, one for the window partitioning
    keys = [ln for ln in p.splitlines() if "Exchange hashpartitioning(" in ln and "functie_code#" in ln.split("hashpartitioning(")[1]]
    assert len(keys) == 2


def above_mart(p: str) -> list[str]:
    """Plan lines above the mart's own aggregation (the one by function)."""
    lines = p.splitlines()
    return lines[:next(i for i, ln in enumerate(lines) if "HashAggregate(" in ln and "functie_code#" in ln)]


@pytest.mark.parametrize("name", ["absence_pivot", "absence_monthly", "control_division", "fte_pivot", "fte_pivot_with_total", "absence_rowpct_pivot", "unmatched_cost_centres"])
def test_reports_aggregate_the_mart_before_lookups_and_labels(spark, qs, name):
    p = plan(qs[name](spark, SF), "simple")
    assert p.count("Union") == 1             # the mart is read once
    top = above_mart(p)
    first = max(i for i, ln in enumerate(top) if "HashAggregate(" in ln)
    assert not any("Join" in ln or "Generate" in ln for ln in top[first + 1:])


def test_counts_come_before_relation_joins(spark, qs):
    for name in ("relation_counts_formatie", "relation_counts_contracts", "unmatched_relations"):
        lines = plan(qs[name](spark, SF), "simple").splitlines()
        scan = next(i for i, ln in enumerate(lines) if "FileScan" in ln and "o_orderstatus" in ln)
        join = next(i for i, ln in enumerate(lines) if "Join" in ln)
        assert any("HashAggregate(" in ln for ln in lines[join:scan])


def test_events_are_scanned_once(spark, qs):
    assert plan(qs["daily_two_series"](spark, SF), "simple").count("FileScan") == 1


def test_no_cross_products_anywhere(spark, qs):
    for name, q in qs.items():
        if name in WRITERS:
            continue
        p = plan(q(spark, SF), "simple")
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_top_n_per_key_is_limited_before_the_shuffle(spark, qs):
    p = plan(qs["rolling_buffer"](spark, SF), "simple")
    assert "WindowGroupLimit" in p


def test_latest_rows_is_take_ordered(spark, qs):
    assert "TakeOrderedAndProject" in plan(qs["latest_rows"](spark, SF), "simple")
