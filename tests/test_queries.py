"""Every registered query against its SQL on the smallest tables."""
import pytest

import check
from __spark_entry__ import entry
from oracles.statements import STATEMENTS
from stintflow.workload import QUERIES


@pytest.fixture(scope="module")
def tables(small):
    return check.tables(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_sql(spark, small, tables, key):
    assert check.compare(spark, tables, small, key).startswith("ok")


def test_entry(spark):
    assert entry(spark).count() > 0
