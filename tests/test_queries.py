"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_queries import compare, connect  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    assert compare(contract.queries()[name](spark, SF), duck, contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "WorstDelinquency12M" in df.columns
