"""Every registered query against DuckDB on the driver's smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import comparison
from oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def oracle():
    return comparison.connect(FOLDER)


def test_every_own_query_has_an_oracle():
    assert set(entry.own_queries()) == set(ORACLES)


@pytest.mark.parametrize("name", entry.own_queries())
def test_query(spark, oracle, name):
    result = entry.queries()[name](spark, FOLDER).toArrow()
    expected = oracle.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert comparison.differences(result, expected) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 3
