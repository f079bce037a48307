"""Every registered query against its DuckDB SQL on the smallest data set."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from staffmart.oracle import oracle_sql
from staffmart.plans.registry import queries
from tests.oracle_check import compare, duckdb_conn

SF = "/root/testdata/sf0.001"
NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF, oracle_sql().get(name), queries()[name])
    assert res["status"] in ("MATCH", "rows-only"), res


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[:3] == ["zorgbedrijf", "jaar", "bron"]
    assert df.count() > 0
