"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, duck_rows, spark_rows
from tidegate.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_job_query_has_sql():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    names, rows = spark_rows(queries()[name](spark, SF))
    want_names, want = duck_rows(duck, oracle_sql()[name])
    assert names == want_names
    assert len(rows) == len(want) > 0
    assert rows == want


def test_entry(spark):
    assert entry(spark).count() > 0
