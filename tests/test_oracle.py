"""Every registered query against its SQL twin on the smallest tables."""
import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connection

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


def test_names_match():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    problems, rows, _, types = compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR)
    assert not problems, problems
    assert not types, types


def test_entry(spark):
    assert entry.entry(spark).columns
