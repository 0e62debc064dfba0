"""Repairing late readings gives the log that a replay gives, and looks at the days around them only."""

import datetime as dt
import random
import re

import pytest

from meterflow.plans import repair, usage
from meterflow.schemas import COUNTER_STATE, METER_LOG
from meterflow.sources.versions import VersionedTables

SINCE = dt.date(2024, 1, 5)
AS_OF = dt.datetime(2024, 1, 6)


def reading(i, at, who, counter, status="normal"):
    at = dt.datetime(2024, 1, 5) + dt.timedelta(days=at) if at is not None else None
    clock = int(at.replace(tzinfo=dt.timezone.utc).timestamp()) if at else 5
    return (i, who, at, clock, status, counter, counter, 10_000 - counter if counter is not None else None, None, None, None, 1, None, None)


def log_of(spark, rows):
    return spark.createDataFrame(rows, METER_LOG)


def repaired(spark, path, rows, late, state):
    """The log without the late ones replayed, then these added and repaired; and the repair."""
    done, _ = usage.reset_and_replay(log_of(spark, [r for r in rows if r[0] not in late]), state, SINCE)
    pending = log_of(spark, [(*r[:11], 0, *r[12:]) for r in rows if r[0] in late])
    store = VersionedTables(spark, str(path))
    store.publish(0, append={"log": usage.with_day(done.unionByName(pending)).repartition(usage.DAY)}, by={"log": usage.DAY})
    found = repair.repair_late(store.read("log", usage.LOG_BY_DAY), state, repair.days_of(store, "log"), SINCE, AS_OF)
    repair.apply_repair(store, "log", found, usage.LOG_BY_DAY)
    return store, found


COLUMNS = ["id", "end_date", "usage_anytime", "usage_offpeak", "usage_available_tokens", "summary_flag"]


def compare(spark, path, rows, late, state):
    store, found = repaired(spark, path, rows, late, state)
    whole, _ = usage.reset_and_replay(log_of(spark, rows), state, SINCE)
    got = store.read("log", METER_LOG)
    assert sorted(map(str, got.select(*COLUMNS).collect())) == sorted(map(str, whole.select(*COLUMNS).collect()))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_as_a_replay(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(260):
        at = rng.choice([rng.uniform(-2, 24), rng.randint(0, 24), 3.5])
        who = rng.choice(["a", "a", "a", "b", "c", "rare1", "rare2", "rare3", None])
        counter = rng.choice([None, rng.randint(0, 30), int(at * 100) + 100])
        rows.append(reading(i, at, who, counter, rng.choice(["normal", "minor", "normal", "critical"])))
    late = {r[0] for r in rows if r[4] != "critical" and r[2] >= dt.datetime(2024, 1, 5) and rng.random() < 0.12}
    state = spark.createDataFrame([(1000, "a", dt.datetime(2024, 1, 4), 1704326400, 7, 7, 9000, AS_OF), (1001, "rare1", dt.datetime(2024, 1, 3), 5, None, 2, 3, AS_OF)], COUNTER_STATE)
    compare(spark, tmp_path, rows, late, state)


def test_only_days_around_are_read(spark, tmp_path):
    rows = [reading(24 * d + h, d + h / 24, "a", 10 * (24 * d + h)) for d in range(20) for h in range(24)]
    rows += [reading(9000 + d, d + 0.3, "b", 100 * d) for d in range(0, 20, 4)]
    state = spark.createDataFrame([], COUNTER_STATE)
    found = compare(spark, tmp_path / "same_day", rows, {24 * 7 + 5, 24 * 7 + 6}, state)
    assert found.read == found.days == [dt.date(2024, 1, 12)]
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*end_day#\d+ (IN|=)", plan)
    # the neighbours of b lie four days off; a's late one in another stretch of days is no neighbour of these
    found = compare(spark, tmp_path / "apart", rows, {9008, 24 * 15 + 3}, state)
    assert found.days == [dt.date(2024, 1, 13), dt.date(2024, 1, 17), dt.date(2024, 1, 20)]
    assert dt.date(2024, 1, 5) not in found.read and dt.date(2024, 1, 24) not in found.read


def test_a_neighbour_beyond_a_gap_is_none(spark, tmp_path):
    """b's late reading lies days behind its neighbour; a's late reading has the first day read, in which b has an older one."""
    rows = [reading(d, d + 0.2, "b", 100 * d) for d in (0, 5, 9, 19)] + [reading(100 + d, d + 0.5, "a", 7 * d) for d in range(20)]
    found = compare(spark, tmp_path, rows, {9, 100}, spark.createDataFrame([], COUNTER_STATE))
    assert found.days == [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 14), dt.date(2024, 1, 24)]


def test_nothing_late(spark, tmp_path):
    found = compare(spark, tmp_path, [reading(1, 1, "a", 5), reading(2, 2, None, 5)], set(), spark.createDataFrame([], COUNTER_STATE))
    assert found.days == [] and found.read == []
    only = compare(spark, tmp_path / "only", [reading(1, 1, "a", 5)], {1}, spark.createDataFrame([], COUNTER_STATE))
    assert only.days == [dt.date(2024, 1, 6)]
