"""Every registered query against its DuckDB oracle (the driver's correctness gate), on sf0.001."""

import pytest

import __spark_entry__ as E
from checks.compare import compare_one, duck

from conftest import SF_SMALL

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare_one(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert r.get("oracle", 1) is None or (r["cols"] and r["exact"] and r["spark_rows"] == r["duck_rows"]), r


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["pickup_borough", "payment_method", "trips", "avg_tip_pct", "avg_fare"]
    assert df.count() >= 0
