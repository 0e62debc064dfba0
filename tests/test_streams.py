"""Stream jobs keep every row, however runs, batches and clocks fall."""

import datetime as dt

import pytest

from meterflow.plans import usage
from meterflow.schemas import COUNTER_STATE, SESSION_HISTORY, SESSION_STAGE, USAGE_RESULT
from meterflow.sources.tables import write_parquet
from meterflow.sources.versions import VersionedTables
from meterflow.streaming import jobs

AS_OF = dt.datetime(2024, 1, 31)
LOG = ("id bigint, clock bigint, subscriber_number string, overall_usage_anytime bigint, overall_usage_offpeak bigint,"
       " overall_available_tokens bigint, end_date timestamp_ntz, terminal_status string")  # fmt: skip


def poll(i, day, counter):
    time = dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
    return (i, int(time.replace(tzinfo=dt.timezone.utc).timestamp()), "s", counter, counter, 1000, time, "normal")


def usage_of(spark, tmp_path, name, batches, compact_every):
    folder = tmp_path / name
    for rows in batches:
        write_parquet(spark.createDataFrame(rows, LOG), f"{folder}/in")
        jobs.usage_from_log(spark, f"{folder}/in", spark.createDataFrame([], LOG).schema, f"{folder}/t", f"{folder}/c", AS_OF,
                            compact_every=compact_every).awaitTermination()
    found = VersionedTables(spark, f"{folder}/t").read("increments", USAGE_RESULT)
    return sorted((r.id, r.v_usage_anytime) for r in found.collect())


def test_compaction_changes_no_result(spark, tmp_path):
    # the first poll is older than the retention time before the run
    batches = [[poll(1, -20, 500)], [poll(2, 1, 600)], [poll(3, 2, 700)]]
    got = [usage_of(spark, tmp_path, f"every{n}", batches, n) for n in (1, 2, 24)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 3


def test_a_poll_from_the_future_leaves_the_state(spark, tmp_path):
    batches = [[poll(1, 1, 500)], [poll(2, 400, 900)], [poll(3, 2, 600)]]
    got = [usage_of(spark, tmp_path, f"future{n}", batches, n) for n in (1, 24)]
    assert got[0] == got[1] and len(got[0]) == 3


@pytest.mark.parametrize("together", [False, True])
def test_backlog_of_snapshots(spark, tmp_path, together):
    def snapshot(hour, octets):
        values = dict.fromkeys(SESSION_STAGE.names)
        values |= {"acctsessionid": "a", "acctuniqueid": "a", "username": "u", "acctstarttime": dt.datetime(2024, 1, 1), "acctsessiontime": hour,
                   "acctinputoctets": octets, "acctoutputoctets": octets, "extract_date": dt.datetime(2024, 1, 1, hour)}
        return spark.createDataFrame([tuple(values[n] for n in SESSION_STAGE.names)], SESSION_STAGE)

    def run():
        jobs.sessions_from_snapshots(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()

    for hour, octets in ((1, 100), (2, 200), (3, 220)):
        write_parquet(snapshot(hour, octets), f"{tmp_path}/in")
        if not together:
            run()
    run()
    found = VersionedTables(spark, f"{tmp_path}/t").read("history", SESSION_HISTORY).orderBy("extract_date").collect()
    assert [r.diff_acctinputoctets for r in found] == [100, 100, 20]


def test_cap_loses_no_tie(spark):
    rows = [(*poll(7, 1, 100), 0), (*poll(7, 1, 100), 0), (*poll(7, 1, 100), 0), (*poll(9, 2, 200), 0)]
    log = spark.createDataFrame(rows, LOG + ", summary_flag int").selectExpr(
        "*", "cast(NULL AS bigint) AS usage_anytime", "cast(NULL AS bigint) AS usage_offpeak", "cast(NULL AS bigint) AS usage_available_tokens",
        "cast(NULL AS timestamp_ntz) AS date_modified", "cast(NULL AS string) AS modified_by",
    )
    state = spark.createDataFrame([], COUNTER_STATE)
    done, _ = usage.summarise_batch(log, state, AS_OF, cap=1)
    assert done.count() == 4
    assert usage.oldest(log, 10).count() == 4


def test_oldest_keeps_rows_without_time(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(9999, 12, 31, 5)), (3, dt.datetime(2024, 1, 1))], "id bigint, end_date timestamp_ntz")
    assert sorted(r.id for r in usage.oldest(df, 5).collect()) == [1, 2, 3]
    assert [r.id for r in usage.oldest(df, 1).collect()] == [3]
