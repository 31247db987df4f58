"""Every query against its checking SQL on whole tables."""

import os

import parity
import pytest

import __spark_entry__ as entry_points
from loadlens.plans.oracle import ORACLE
from loadlens.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return parity.connect(SF_DIR)


def test_every_query_is_checked():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    names, rows = parity.spark_rows(QUERIES[name](spark, SF_DIR))
    expected_names, expected = parity.duck_rows(duck, ORACLE[name])
    assert names == expected_names
    assert rows, "no rows"
    assert parity.difference(rows, expected) == ([], [])


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 41
    assert df.count() == 1500
