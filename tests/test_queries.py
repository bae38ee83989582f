"""Every registered query against its DuckDB oracle (the driver's check, on sf0.001)."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = os.environ.get("SLUICE_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), SF, con)
    assert r["ok"] is not False, r
    assert r["rows"] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["value"]
    assert df.count() > 0
