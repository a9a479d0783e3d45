"""Every registered query against its SQL on the smallest scale."""

import os

import pytest
from check import compare, duck

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, name):
    got, want, differing, examples = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert (got, differing) == (want, 0), examples


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
