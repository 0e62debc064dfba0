"""The usage stream with a state store: increments, late readings, and state that goes."""

import datetime as dt
import time

from pyspark.sql import Row

from meterflow.plans import usage
from meterflow.schemas import COUNTER_STATE, USAGE_RESULT
from meterflow.sources.tables import write_parquet
from meterflow.sources.versions import VersionedTables
from meterflow.streaming import readings

LOG = ("id bigint, clock bigint, subscriber_number string, overall_usage_anytime bigint, overall_usage_offpeak bigint,"
       " overall_available_tokens bigint, end_date timestamp_ntz, terminal_status string")  # fmt: skip
START = dt.datetime(2024, 1, 1)


def poll(i, day, counter, who="s", offpeak=0, tokens=1000):
    at = START + dt.timedelta(days=day)
    return (i, int(at.replace(tzinfo=dt.timezone.utc).timestamp()), who, counter, offpeak, tokens, at, "normal")


def run(spark, folder, batches, **options):
    schema = spark.createDataFrame([], LOG).schema
    for rows in batches:
        write_parquet(spark.createDataFrame(rows, schema).coalesce(1), f"{folder}/in")
        query = readings.usage_by_state(spark, f"{folder}/in", schema, f"{folder}/t", f"{folder}/c", **options)
        query.awaitTermination()
    store = VersionedTables(spark, f"{folder}/t")
    increments = {r.id: (r.v_usage_anytime, r.v_usage_offpeak, r.v_usage_available_tokens) for r in store.read("increments", USAGE_RESULT).collect()}
    return increments, sorted(r.id for r in store.read("late", readings.LATE).collect())


def held(spark, folder):
    rows = spark.read.format("statestore").option("stateVarName", "last").load(f"{folder}/c").selectExpr("key.subscriber_number AS who", "value.id AS id")
    return sorted((r.who, r.id) for r in rows.collect())


def test_state_goes_and_late_rows_are_kept(spark, tmp_path):
    batches = [
        [poll(1, 0, 100), poll(2, 1, 150), poll(3, 0, 7, "quiet")],
        [poll(4, 41.5, 400)],
        [poll(5, 41.6, 450), poll(6, 5, 200), poll(7, 41.7, 9, "quiet"), poll(8, 20, 999, "quiet")],
        [poll(9, 42, 500)],
    ]
    increments, late = run(spark, tmp_path, batches)
    # 6 is more than 31 days older than 4 and the quiet one's first reading was forgotten by the time of 7
    assert late == [6] and set(increments) == {1, 2, 3, 4, 5, 7, 8, 9}
    assert increments[2][0] == 50 and increments[4][0] == 250 and increments[5][0] == 50 and increments[9][0] == 50
    assert increments[8][0] == 999 and increments[7][0] == 0
    assert held(spark, tmp_path) == [("quiet", 7), ("s", 9)]
    run(spark, tmp_path, [[poll(10, 90, 501, "s")], [poll(11, 90.1, 502, "s")]])
    assert held(spark, tmp_path) == [("s", 11)]


def test_as_the_batch_operator_with_odd_rows(spark, tmp_path):
    first = [poll(1, 1, 10), poll(2, 2, None), poll(3, 1, 5, None), poll(4, 3, 1 << 60, "big"), (5, None, "n", 1, 2, 3, None, "normal")]
    second = [poll(6, 4, 40), poll(7, 4, 40), poll(8, 5, (1 << 60) + 3, "big"), poll(9, 2.5, 30), poll(10, 6, 8, None), (11, 5, "n", 4, 4, 1, None, "minor")]
    got, late = run(spark, tmp_path, [first, second])
    frames = [spark.createDataFrame(rows, LOG) for rows in (first, second)]
    state = usage.next_state(spark.createDataFrame([], COUNTER_STATE), frames[0].where("end_date IS NOT NULL"), START)
    want = usage.usage_increments(frames[0], spark.createDataFrame([], COUNTER_STATE)).unionByName(usage.usage_increments(frames[1], state))
    assert not late and got == {r.id: (r.v_usage_anytime, r.v_usage_offpeak, r.v_usage_available_tokens) for r in want.collect()}


def test_a_hot_subscriber(spark, tmp_path):
    """A third of 300,000 readings under one number: one task, in seconds."""
    made = spark.range(300_000).selectExpr(
        "id", "1704067200 + id AS clock", "if(id % 3 = 0, 'hot', cast(id % 5000 AS string)) AS subscriber_number", "id AS overall_usage_anytime",
        "id AS overall_usage_offpeak", "1000000 - id AS overall_available_tokens",
        "timestampadd(SECOND, cast(id AS int), timestamp_ntz'2024-01-01') AS end_date", "'normal' AS terminal_status")
    made.write.parquet(f"{tmp_path}/in")
    began = time.time()
    readings.usage_by_state(spark, f"{tmp_path}/in", made.schema, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    took = time.time() - began
    got = VersionedTables(spark, f"{tmp_path}/t").read("increments", USAGE_RESULT)
    want = usage.usage_increments(made, spark.createDataFrame([], COUNTER_STATE))
    assert got.count() == 300_000 and got.exceptAll(want).isEmpty() and took < 90


class Calls:
    """A state store that notes what is asked of it."""

    def __init__(self):
        self.made, self.value, self.timers = [], None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.made.append("get")
        return self.value

    def update(self, value):
        self.made.append("update")
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.made.append("timer")
        self.timers.append(at)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_a_subscriber_costs_two_calls_a_batch():
    """Also the timer is set once, and again only when it fires too early."""
    store, last = Calls(), readings.LastReading(31, 40)
    last.init(store)
    names = ("subscriber_number", "id", "end_us", "terminal_status", *readings.NUMBERS)
    day_us = readings.DAY_MS * 1000
    start = 20_000 * day_us

    def row(i, day):
        return Row(*names)("s", i, start + day * day_us, "normal", i, 10 * i, 10 * i, readings.NONE)

    first = list(last.handleInputRows(("s",), iter([row(2, 2), row(1, 1)]), At(0)))
    assert [(r.id, r.prev_clock) for r in first] == [(1, readings.NONE), (2, 1)] and store.made == ["get", "update", "timer"]
    store.made.clear()
    second = list(last.handleInputRows(("s",), iter([row(3, 30)]), At(0)))
    assert [(r.id, r.prev_clock, r.late) for r in second] == [(3, 2, False)] and store.made == ["get", "update"]
    fires = store.timers[0]
    list(last.handleExpiredTimer(("s",), At(fires), None))
    assert store.value[1] == 3 and len(store.timers) == 2 and store.timers[1] == fires + 28 * readings.DAY_MS
    list(last.handleExpiredTimer(("s",), At(store.timers[1]), None))
    assert store.value is None and len(store.timers) == 2
