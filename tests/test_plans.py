"""The plans we want: filters in the scan, one row per key before a shuffle, no Python, no cross join."""

import re

import pytest

from __spark_entry__ import queries
from meterflow.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# queries that write tables first: their last plan is a scan
STORED = {n for n in QUERIES if "stream" in n or "chain" in n} | {"csv_roundtrip"}
PYTHON = r"Python|Pandas|Arrow|FlatMap|CoGroup|CartesianProduct|BroadcastNestedLoop"


def plan_of(spark, name):
    return queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    assert not re.search(PYTHON, plan)


def test_ranges_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "usage_increment")
    assert "GreaterThanOrEqual(ts,2024-01-16T00:00)" in plan and "LessThan(ts,2024-01-16T00:00)" in plan
    assert "props" not in plan
    assert "GreaterThan(o_orderdate,1997-01-01T00:00)" in plan_of(spark, "log_delta_extract")
    # where there are more rows than are asked for, the hour in which these end is a bound of the scan
    topk = queries()["pending_usage_topk"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: [^\n]*LessThan\(ts,2024", topk) and "GreaterThanOrEqual(ts,2023-12-31T00:00)" in topk


@pytest.mark.parametrize("name, column, days", [("snapshot_interval_read", "etl_day", 1), ("state_retention_by_day", None, None)])
def test_tables_laid_out_by_day(spark, name, column, days):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    if column:
        assert re.search(rf"PartitionFilters: \[[^\n]*{column}#", plan)
    assert not re.search(PYTHON, plan)


@pytest.mark.parametrize("name", ["latest_state", "usage_increment", "state_upsert", "session_track"])
def test_one_row_per_key_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", plan_of(spark, name))


def test_increments_shuffle_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, "usage_increment")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
