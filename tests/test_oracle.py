"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

from __spark_entry__ import entry
from loadcast.plans.queries import ORACLE, QUERIES
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert {"house_id", "predicted_value", "median_load", "window_minutes"} <= set(df.columns)
