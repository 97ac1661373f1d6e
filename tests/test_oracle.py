"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from aerolake.plans.registry import QUERIES
from compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return duck(SF)


# The queries of the llm subpackage have tests of their own.
OWN = sorted(QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    rows, problem = compare(spark, con, name, SF)
    assert not problem, problem
    assert rows > 0


def test_every_query_but_the_serial_one_has_a_twin():
    assert set(OWN) - set(entry.oracle_sql()) == {"apply_changes"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
