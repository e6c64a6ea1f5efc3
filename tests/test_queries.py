"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as contract
from check import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, name):
    assert compare(spark, SF_DIR, name) == ""


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 10
    assert [r["n"] for r in rows] == sorted((r["n"] for r in rows), reverse=True)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
