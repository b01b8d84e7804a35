"""Every registered query against its DuckDB statement, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as spark_entry
from check_queries import compare, duck_connection

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_DIR)


def test_every_query_has_a_check():
    assert set(spark_entry.QUERIES) == set(spark_entry.ORACLES)


@pytest.mark.parametrize("name", sorted(spark_entry.QUERIES))
def test_query(spark, duck, name):
    same, text = compare(spark, duck, SF_DIR, name)
    assert same, text


def test_entry(spark):
    if SF_DIR.endswith("sf0.001"):
        assert spark_entry.entry(spark).count() > 0
