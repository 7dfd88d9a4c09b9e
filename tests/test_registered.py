"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from lakeloom.workload.registry import PLANS
from tests.conftest import SF
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", list(PLANS))
def test_same_rows(spark, connection, name):
    outcome, _ = compare(spark, connection, name, SF)
    assert outcome == "ok"


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert "city_sk" in df.columns and df.count() > 0


def test_all_have_sql():
    assert PLANS.keys() <= entry_points.oracle_sql().keys() <= entry_points.queries().keys()
