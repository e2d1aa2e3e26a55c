"""Every registered query runs; where SQL is given, DuckDB returns the same rows, names and types."""

import os

import pytest

from oracle_check import compare, duck
from tallyspark.plans import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, message, _ = compare(spark, con, name, SF_DIR, QUERIES, ORACLES)
    assert ok, message


def test_names():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry_points

    df = entry_points.entry(spark)
    assert df.count() > 0 and {"prob_alive", "expected_spend", "clv"} <= set(df.columns)
