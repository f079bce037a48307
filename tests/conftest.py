from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from staffmart.session import local_session

    s = local_session("*", shuffle_partitions=8, app="staffmart-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    from tests.fixtures import fixture_tables

    return fixture_tables(spark)


@pytest.fixture(scope="session")
def spark_session_for_hypothesis(spark):
    """Same session; a distinct name so hypothesis does not warn about function-scoped fixtures."""
    return spark
