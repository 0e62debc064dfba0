import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow.operators.skew import lag_by_key, plan_chunks
from meterflow.plans import usage
from meterflow.schemas import COUNTER_STATE, METER_LOG
from meterflow.session import small_table

T0 = dt.datetime(2024, 1, 10)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def poll(i, sub, minute, anytime, offpeak, tokens, status="normal", **more):
    row = dict(id=i, subscriber_number=sub, end_date=at(minute), clock=minute * 60, terminal_status=status,
               overall_usage_anytime=anytime, overall_usage_offpeak=offpeak, overall_available_tokens=tokens,
               summary_flag=0)
    return row | more


def log_of(spark, rows):
    empty = dict.fromkeys(METER_LOG.names)
    return small_table(spark, [empty | r for r in rows], METER_LOG)


def state_of(spark, rows):
    keep = [{k: v for k, v in r.items() if k in COUNTER_STATE.names} | {"load_time": T0} for r in rows]
    return small_table(spark, keep, COUNTER_STATE)


def results(df):
    return {
        r.id: (r.v_usage_anytime, r.v_usage_offpeak, r.v_usage_available_tokens, r.summary_flag)
        for r in df.collect()
    }


CASES = {
    # no past at all: the counters count in full, tokens do not
    "fresh": ([], [poll(1, "a", 0, 500, 70, 900)], (500, 70, 0, 1)),
    # the past comes from the state
    "state": ([poll(9, "a", 0, 500, 70, 900)], [poll(1, "a", 1, 560, 90, 880)], (60, 20, 20, 1)),
    # exactly the allowed 100 per minute, and one more
    "at limit": ([poll(9, "a", 0, 500, 70, 900)], [poll(1, "a", 1, 600, 171, 800)], (100, 0, 100, 1)),
    "over limit": ([poll(9, "a", 0, 500, 70, 900)], [poll(1, "a", 1, 601, 70, 799)], (0, 0, 0, 1)),
    "fall": ([poll(9, "a", 0, 500, 70, 900)], [poll(1, "a", 1, 499, 71, 900)], (0, 1, 0, 1)),
    "negative past": ([poll(9, "a", 0, -5, 70, 900)], [poll(1, "a", 1, 5, 70, 900)], (0, 0, 0, 1)),
    "all fell": ([poll(9, "a", 0, 500, 70, 900)], [poll(1, "a", 1, 10, 7, 850)], (0, 0, 0, 1)),
    "tokens gone": ([poll(9, "a", 0, 500, 70, 90)], [poll(1, "a", 1, 500, 70, 0)], (0, 0, 0, 1)),
    "same clock": ([poll(9, "a", 1, 500, 70, 900)], [poll(1, "a", 1, 500, 71, 900)], (0, 0, 0, 1)),
    "older than state": ([poll(9, "a", 5, 500, 70, 900)], [poll(1, "a", 1, 400, 60, 950)], (0, 0, 0, 1)),
    "no subscriber": ([], [poll(1, None, 0, 500, 70, 900)], (None, None, None, -1)),
    "no counters": ([], [poll(1, "a", 0, None, None, None)], (None, None, None, -1)),
    "one counter missing": ([], [poll(1, "a", 0, None, 70, 900)], (None, 70, 0, 1)),
    "missing with a past": ([poll(9, "a", 0, 1, 1, 9)], [poll(1, "a", 1, None, 1, 9)], (0, 0, 0, 1)),
}


@pytest.mark.parametrize("name", CASES)
def test_increment_branches(spark, name):
    state, batch, want = CASES[name]
    got = results(usage.usage_increments(log_of(spark, batch), state_of(spark, state)))
    assert got == {1: want}


def test_lag_goes_before_state_and_falls_back_per_counter(spark):
    state = [poll(9, "a", 0, 100, 100, 900)]
    batch = [poll(1, "a", 1, 150, None, 880), poll(2, "a", 2, 170, 180, 870), poll(3, "a", 3, 1, 1, 1, "critical")]
    got = results(usage.increments_with_rejects(log_of(spark, batch), state_of(spark, state)))
    # poll 2: anytime against poll 1; off-peak against the state, within one minute's rate
    assert got == {1: (50, 0, 20, 1), 2: (20, 80, 10, 1), 3: (None, None, None, -1)}


def test_equal_times_are_ordered_by_id(spark):
    batch = [poll(2, "a", 1, 120, 0, 9), poll(1, "a", 1, 100, 0, 9)]
    assert results(usage.usage_increments(log_of(spark, batch), state_of(spark, [])))[2][0] == 0


def ramp(spark, subs, polls, start=0):
    rows = [
        poll(s * 10_000 + p, f"s{s}", p, (p * (17 + s)) % 700, p * 3, 5000 - p * 2 - s)
        for s in range(subs) for p in range(start, start + polls)
    ]
    return log_of(spark, rows)


def test_heavy_subscriber_is_cut_without_changing_results(spark):
    rows = [poll(i, "hot", i // 3, i * 5 % 400, i, 900_000 - i) for i in range(3000)]
    rows += [poll(10_000 + i, f"s{i % 50}", i, i, i, 9000 - i) for i in range(500)]
    rows += [poll(20_000 + i, None, 7, i, i, i) for i in range(1500)]
    batch = log_of(spark, rows)
    state = state_of(spark, [poll(99_999, "hot", -1, 1, 1, 950_000), poll(99_998, "s3", -1, 1, 1, 9500)])
    plain = usage.usage_increments(batch, state)
    plan = plan_chunks(batch, ["subscriber_number"], ["end_date", "id"], heavy_rows=300, max_keys=100)
    cuts = {r.subscriber_number: len(r._cuts) for r in plan.cuts.collect()}
    assert set(cuts) == {"hot", None} and cuts["hot"] >= 5
    cut = usage.usage_increments(batch, state, plan=plan)
    assert results(cut) == results(plain)
    sizes = [r["count"] for r in plan.assign(batch).groupBy("subscriber_number", "_chunk").count().collect()]
    assert max(sizes) < 1500


def test_many_cuts_are_searched_in_blocks(spark):
    df = spark.range(5000).selectExpr("id", "'hot' AS k", "id % 1000 AS t")
    plan = plan_chunks(df, ["k"], ["t", "id"], heavy_rows=20, max_keys=1000)
    assert len(plan.cuts.first()._cuts) > 150
    got = [r.prev for r in lag_by_key(df, plan, {"prev": "id"}).orderBy("t", "id").collect()]
    ordered = [r.id for r in df.orderBy("t", "id").collect()]
    assert got == [None, *ordered[:-1]]
    assert plan.assign(df).groupBy("_chunk").count().agg(F.max("count")).first()[0] < 200


def test_keys_of_ordinary_size_stay_whole(spark):
    df = spark.range(4000).selectExpr("id", "id % 4 AS k")
    assert plan_chunks(df, ["k"], ["id"], heavy_rows=100, max_keys=4).cuts is None


def test_heavy_key_with_one_time_and_missing_times(spark):
    rows = [poll(i, "hot", 5, i, i, i) | ({"end_date": None} if i % 3 == 0 else {}) for i in range(2000)]
    df = log_of(spark, rows).select("id", "subscriber_number", "end_date", "clock")
    plan = plan_chunks(df, ["subscriber_number"], ["end_date", "id"], heavy_rows=200, max_keys=20)
    assert plan.cuts is not None
    whole = plan_chunks(df, ["subscriber_number"], ["end_date", "id"])
    assert whole.cuts is None
    cut = lag_by_key(df, plan, {"prev": "id"}).select("id", "prev")
    plain = lag_by_key(df, whole, {"prev": "id"}).select("id", "prev")
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert plan.assign(df).groupBy("_chunk").count().agg(F.max("count")).first()[0] < 1000


def run(log, state, **options):
    return usage.summarise_batch(log, state, T0 + dt.timedelta(days=2), **options)


def log_rows(df):
    return sorted(map(str, df.select(*METER_LOG.names).collect()))


def test_batches_cut_by_time_equal_one_batch(spark):
    log, none = ramp(spark, 5, 40), state_of(spark, [])
    at_once, state_once = run(log, none)
    first, state = run(log, none, cap=77)
    assert first.where("summary_flag = 0").count() == 200 - 77
    second, state = run(first, state)
    assert log_rows(second) == log_rows(at_once)
    assert sorted(map(str, state.collect())) == sorted(map(str, state_once.collect()))


def test_replay_twice_equals_once(spark):
    done, state = run(ramp(spark, 4, 30), state_of(spark, []))
    once = usage.reset_and_replay(done, state, T0.date())
    twice = usage.reset_and_replay(*once, T0.date())
    assert log_rows(once[0]) == log_rows(twice[0])
    assert sorted(map(str, once[1].collect())) == sorted(map(str, twice[1].collect()))


def test_late_row_counts_after_replay(spark):
    none = state_of(spark, [])
    early = [poll(1, "a", 0, 100, 0, 900), poll(3, "a", 20, 300, 0, 900)]
    log, state = run(log_of(spark, early), none)
    log = log.unionByName(log_of(spark, [poll(2, "a", 10, 200, 0, 900)]))
    log, state = run(log, state)
    assert {r.id: r.usage_anytime for r in log.collect()} == {1: 100, 2: 0, 3: 200}
    log, _ = usage.reset_and_replay(log, state, T0.date())
    assert {r.id: r.usage_anytime for r in log.collect()} == {1: 100, 2: 100, 3: 100}


def test_usage_stays_within_the_rate(spark):
    batch = ramp(spark, 6, 50)
    rows = usage.with_previous(batch, state_of(spark, [])).join(
        usage.usage_increments(batch, state_of(spark, [])), "id"
    )
    over = rows.where("prev_clock IS NOT NULL AND v_usage_anytime > 100 * (clock - prev_clock) / 60")
    assert over.count() == 0


def test_only_recent_pending_rows_are_read(spark):
    rows = [poll(1, "a", 0, 1, 1, 1), poll(2, "a", 1, 1, 1, 1, summary_flag=1), poll(3, "a", 2, 1, 1, 1, "critical"),
            poll(4, "a", -60 * 24 * 40, 1, 1, 1), poll(5, "a", 3, 1, 1, 1)]
    log = log_of(spark, rows)
    as_of = T0 + dt.timedelta(days=1)
    assert [r.id for r in usage.read_unsummarised(log, as_of).collect()] == [1, 5]
    assert [r.id for r in usage.read_unsummarised(log, as_of, cap=1).collect()] == [1]
    assert usage.read_unsummarised(log, as_of, cap=None).count() == 2
