"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from meterflow.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) & set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message, _ = compare(queries()[name](spark, SF_DIR), con, oracle_sql()[name])
    assert not message
