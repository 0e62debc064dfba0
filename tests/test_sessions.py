import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow.operators.skew import plan_chunks
from meterflow.plans import sessions
from meterflow.schemas import SESSION_HISTORY, SESSION_STAGE
from meterflow.session import small_table

T0 = dt.datetime(2024, 5, 1)
HOUR = dt.timedelta(hours=1)


def row(uid, user="u", start=T0, stop=None, length=60, octets=(100, 50), extract=0, **more):
    base = dict.fromkeys(SESSION_STAGE.names) | dict(
        acctsessionid=f"s{uid}", acctuniqueid=uid, username=user, acctstarttime=start, acctstoptime=stop,
        acctsessiontime=length, acctinputoctets=octets[0], acctoutputoctets=octets[1],
        extract_date=T0 + extract * HOUR, etl_date=T0 + extract * HOUR,
    )
    return base | more


def stage_of(spark, rows):
    return sessions.session_stage(small_table(spark, rows, SESSION_STAGE))


def empty_history(spark):
    return small_table(spark, [], SESSION_HISTORY)


def history_of(spark, *snapshots):
    history = empty_history(spark)
    for rows in snapshots:
        delta = sessions.changes_delta(stage_of(spark, rows), history)
        history = small_table(
            spark, [r.asDict() for r in sessions.append_history(history, delta).collect()], SESSION_HISTORY
        )
    return history


def changes(spark, rows, history, **options):
    new, changed = sessions.session_changes(stage_of(spark, rows), history, **options)
    return (
        {r.acctuniqueid: r for r in new.collect()},
        {r.acctuniqueid: r for r in changed.collect()},
    )


@pytest.mark.parametrize(("stop", "length", "adj_stop", "stop_flag", "adj_length", "length_flag"), [
    (None, 60, None, 0, 60.0, 0),
    (T0 + HOUR, 60, T0 + HOUR, 0, 60.0, 0),
    (T0 - HOUR, 60, T0 + dt.timedelta(seconds=60), 1, 60.0, 0),
    (T0 - HOUR, 0, T0 - HOUR, 0, 3600.0, 1),
    (T0, 0, T0, 0, 0.0, 1),
    (T0, None, T0, 0, None, 0),
])
def test_stage_repairs_times(spark, stop, length, adj_stop, stop_flag, adj_length, length_flag):
    r = stage_of(spark, [row("a", stop=stop, length=length)]).first()
    assert (r.adj_acctstoptime, r.is_time_adjusted, r.adj_acctsessiontime, r.is_sessiontime_adjusted) == (
        adj_stop, stop_flag, adj_length, length_flag
    )
    assert r.adj_acctuniqueid == "a;u;2024-05-01 00:00:00"


def test_missing_parts_do_not_empty_id_and_hash(spark):
    r = stage_of(spark, [row("a", user=None, start=None, length=None, octets=(None, None))]).first()
    assert r.adj_acctuniqueid == "a;;" and len(r.stg_hashdiff) == 32


def test_unchanged_grown_reset_and_new(spark):
    history = history_of(spark, [row("same"), row("up"), row("down"), row("gone")])
    later = [row("same", extract=1), row("up", octets=(150, 60), extract=1), row("down", octets=(30, 60), extract=1),
             row("fresh", octets=(7, 8), start=T0 + HOUR, extract=1)]
    new, changed = changes(spark, later, history)
    assert set(new) == {"fresh"} and set(changed) == {"up", "down"}
    up, down = changed["up"], changed["down"]
    assert (up.prev_acctinputoctets, up.diff_acctinputoctets, up.diff_acctoutputoctets) == (100, 50, 10)
    assert (down.prev_acctinputoctets, down.diff_acctinputoctets, down.diff_acctoutputoctets) == (100, 30, 10)
    assert (new["fresh"].prev_acctinputoctets, new["fresh"].diff_acctinputoctets) == (None, 7)


def test_an_older_version_counts_as_unchanged_unless_latest_only(spark):
    history = history_of(spark, [row("a")], [row("a", octets=(200, 100), extract=1)])
    back = [row("a", extract=2)]
    assert changes(spark, back, history) == ({}, {})
    _, changed = changes(spark, back, history, latest_only=True)
    assert changed["a"].prev_acctinputoctets == 200 and changed["a"].diff_acctinputoctets == 100


def test_one_unchanged_row_clears_its_id(spark):
    history = history_of(spark, [row("a")])
    twice = [row("a", extract=1), row("a", user="other", octets=(1, 1), extract=1)]
    assert changes(spark, twice, history) == ({}, {})


def test_missing_hash_in_history_drops_the_row(spark):
    history = history_of(spark, [row("a")]).withColumn("hashdiff", F.lit(None).cast("string"))
    assert changes(spark, [row("a", octets=(5, 5), extract=1)], history) == ({}, {})


def test_missing_user_is_new_every_time(spark):
    history = history_of(spark, [row("a", user=None)])
    new, _ = changes(spark, [row("a", user=None, extract=1)], history)
    assert set(new) == {"a"}


def test_new_sessions_look_back_per_user(spark):
    rows = [row("b", start=T0 + HOUR, stop=T0 + 2 * HOUR), row("a", stop=T0 + HOUR), row("c", user="v"),
            row("d", start=None)]
    new, _ = changes(spark, rows, empty_history(spark))
    assert (new["b"].prev_acctstarttime, new["b"].prev_adj_acctstoptime) == (T0, T0 + HOUR)
    assert new["a"].prev_acctstarttime is None and new["c"].prev_acctstarttime is None
    assert new["d"].prev_acctstarttime == T0 + HOUR  # no start sorts last


def test_same_snapshot_again_yields_nothing(spark):
    rows = [row(f"{i}", user=f"u{i % 3}", octets=(i, i), extract=1) for i in range(20)]
    assert changes(spark, rows, history_of(spark, rows)) == ({}, {})


def test_heavy_user_is_cut_without_changing_results(spark):
    rows = [row(f"{i}", user="hot" if i % 3 else f"u{i % 7}", start=T0 + (i // 50) * HOUR, octets=(i, i))
            for i in range(1500)]
    stage = stage_of(spark, rows)
    history = history_of(spark, rows[:200]).withColumns({
        "acctinputoctets": F.lit(-1).cast("bigint"), "hashdiff": F.lit("another")
    })
    plan = plan_chunks(stage, ["username"], ["acctstarttime", "extract_date", "acctuniqueid"], heavy_rows=100, max_keys=20)
    assert plan.cuts is not None
    cut = sessions.changes_delta(stage, history, plan=plan)
    plain = sessions.changes_delta(stage, history)
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))
    assert plain.where("new_ind = 0").count() == 200


def test_series_delta(spark):
    stage = stage_of(spark, [row("a", octets=(o, o), extract=i) for i, o in enumerate([10, 25, 5])])
    got = sessions.snapshot_series_delta(stage, ["username", "acctuniqueid"], ["extract_date"], ["acctinputoctets"])
    assert [r.diff_acctinputoctets for r in got.orderBy("extract_date").collect()] == [10, 15, 5]
