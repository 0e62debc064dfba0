"""Registered queries that have SQL, against it."""

import pytest
from compare import compare, duck

from meterflow.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    message, rows = compare(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLE[name])
    assert not message and rows
