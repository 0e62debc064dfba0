import datetime as dt
import json
import os

import pytest

from meterflow.schemas import FILE_STATUS, METER_RECORD, QUARANTINE
from meterflow.sources import meter_files
from meterflow.sources.tables import read_csv, write_csv
from meterflow.sources.versions import VersionedTables
from meterflow.streaming import jobs

GOOD = {
    "DeviceID": "Dev1", "LastPolledTime": 1706000000123, "OverallCapacity": 2, "OverallUsage": 2,
    "OffpeakOverallCapacity": 0, "OffpeakOverallUsage": 0, "AvailTokens": 5, "FapStatus": "Ok",
    "TerminalStatus": "NORMAL", "InPeakPeriod": "True", "ESN": "E9",
}


def line(drop=(), **changes):
    return json.dumps({k: v for k, v in (GOOD | changes).items() if k not in drop})


def outcome(spark, text):
    df = spark.createDataFrame([(text, "f_202401010000.udr")], "value string, udr_file_name string")
    return meter_files.classify_lines(df, "Asia/Jakarta", "me").first()


OUTCOMES = [
    (line(), "record"),
    (line(TerminalStatus="Minor"), "record"),
    (line(OverallCapacity=1), "rejected"),
    (line(OverallUsage=1), "rejected"),
    (line(OverallUsage=1.5), "record"),
    (line(OverallCapacity=1, OffpeakOverallCapacity=2, OffpeakOverallUsage=2), "record"),
    (line(TerminalStatus="offline"), "dropped"),
    (line(drop=["TerminalStatus"]), "dropped"),
    (line(drop=["AvailTokens"]), "bad_field"),
    (line(drop=["AvailTokens"], OverallUsage=1), "rejected"),
    (line(drop=["DeviceID"], OverallUsage=1), "bad_field"),
    (line(drop=["OverallUsage"]), "bad_field"),
    (line(drop=["OverallUsage"], OverallCapacity=1), "rejected"),
    (line(OverallUsage="9"), "bad_field"),
    (line(OverallUsage=None), "bad_field"),
    (line(OffpeakOverallUsage="9"), "record"),
    (line(AvailTokens=None), "record"),
    (line(AvailTokens="many"), "bad_field"),
    (line(LastPolledTime="soon"), "bad_field"),
    (line(drop=["ESN"]), "record"),
    (line(TerminalStatus="Suspended", OverallCapacity=0, OverallUsage=None), "record"),
    (line(TerminalStatus="Critical", OverallUsage="12"), "record"),
    (line(drop=["FapStatus"], TerminalStatus="Critical"), "bad_field"),
    (line()[:30], "bad_json"),
    (line() + " x", "bad_json"),
    (line() + "," + line(), "bad_json"),
    ("", "bad_json"),
    ("  ", "bad_json"),
    (line().replace('"', "'"), "bad_json"),
    ("[1]", "bad_field"),
    ("5", "bad_field"),
    ("null", "bad_field"),
]


def test_outcomes(spark):
    schema = "value string, udr_file_name string"
    df = spark.createDataFrame([(text, str(i)) for i, (text, _) in enumerate(OUTCOMES)], schema)
    got = {int(r.udr_file_name): r.outcome for r in meter_files.classify_lines(df, "UTC", "me").collect()}
    wrong = {OUTCOMES[i]: o for i, o in got.items() if o != OUTCOMES[i][1]}
    assert len(got) == len(OUTCOMES) and not wrong


def test_record_columns(spark):
    r = outcome(spark, line())
    assert (r.subscriber_number, r.clock, r.ns, r.fap_status, r.esn) == ("dev1", "1706000000", "123", "ok", "e9")
    assert r.end_date == dt.datetime(2024, 1, 23, 15, 53, 20) and r.service_plan is None
    assert r.created_by == "me" and r.overall_usage_anytime == 2
    assert outcome(spark, line(LastPolledTime=1706000000)).ns == ""
    assert outcome(spark, line(LastPolledTime=1706000000, TerminalStatus="critical")).ns == "0"
    repeated = line()[:-1] + ', "ESN": "F1"}'
    assert outcome(spark, repeated).esn == "f1"


def test_file_status(spark):
    rows = [(line(), "a"), (line()[:9], "a"), (line(), "b"), (line(drop=["FapStatus"]), "b"), (line(OverallUsage=0), "c")]
    df = spark.createDataFrame(rows, "value string, udr_file_name string")
    classified = meter_files.classify_lines(df, "UTC", "me")
    status = meter_files.file_status(classified)
    assert {r.udr_file_name: r.file_ok for r in status.collect()} == {"a": True, "b": False, "c": True}
    done = meter_files.finished_only(meter_files.accepted(classified), status)
    assert [r.udr_file_name for r in done.collect()] == ["a"]
    assert meter_files.pending_files(status).first().pending_files == 1
    assert meter_files.pending_files(status.where("file_ok")).count() == 0


@pytest.fixture
def inbox(tmp_path):
    """Three meter files in order, one of another kind, one without a time."""
    folder = tmp_path / "in"
    folder.mkdir()
    names = ["n_202401010200.udr", "n_202401010100.udr", "n_202401010300.udr", "n_202401010000.tmp", "n.udr"]
    for i, name in enumerate(names):
        texts = [line(LastPolledTime=1706000000000 + 1000 * (i + k)) for k in range(3)] + ["{broken"]
        (folder / name).write_text("\n".join(texts) + "\n")
        os.utime(folder / name, (1_700_000_000 + i, 1_700_000_000 + i))
    return folder


def test_file_selection(spark, inbox):
    listing = meter_files.list_files(spark, str(inbox))
    names = [r.file_name for r in meter_files.select_files(listing).collect()]
    assert names == ["n_202401010100.udr", "n_202401010200.udr", "n_202401010300.udr", "n.udr"]
    assert len(meter_files.select_files(listing, cap=2).collect()) == 2


def test_stream_equals_batch_and_repeats_do_nothing(spark, inbox, tmp_path):
    def run(checkpoint, max_files):
        jobs.ingest_files(spark, str(inbox), str(tmp_path / f"t{max_files}"), str(tmp_path / checkpoint), "UTC", "me",
                          max_files=max_files).awaitTermination()
        return VersionedTables(spark, str(tmp_path / f"t{max_files}"))

    def keys(df):
        return sorted((r.subscriber_number, r.clock, r.ns) for r in df.collect())

    store = run("c1", 1)
    assert len(store.batches()) == 4
    records, _ = meter_files.parse_udr(meter_files.scan_lines(spark, str(inbox)), "UTC", "me")
    want = sorted(set(keys(records)))
    assert keys(store.read("records", METER_RECORD)) == want and len(want) == 7
    assert store.read("quarantine", QUARANTINE).count() == 4
    run("c1", 1)  # nothing new
    run("c2", 1)  # a lost checkpoint replays batch numbers that are there already
    assert keys(store.read("records", METER_RECORD)) == want
    assert keys(run("c3", 100).read("records", METER_RECORD)) == want


def test_streaming_dedupe(spark, inbox, tmp_path):
    lines = meter_files.stream_lines(spark, str(inbox))
    stream = jobs.unique_records(meter_files.accepted(meter_files.classify_lines(lines, "UTC", "me")))
    query = (stream.writeStream.format("memory").queryName("unique_records").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "c")).start())
    query.awaitTermination()
    assert spark.table("unique_records").count() == 7


def test_new_checkpoint_with_new_lines(spark, tmp_path):
    """A stream that starts anew counts its batches from 0 again; its new lines are stored all the same."""
    folder = tmp_path / "in"
    folder.mkdir()

    def run(checkpoint):
        jobs.ingest_files(spark, str(folder), str(tmp_path / "t"), str(tmp_path / checkpoint), "UTC", "me").awaitTermination()
        return VersionedTables(spark, str(tmp_path / "t")).read("records", METER_RECORD).count()

    (folder / "n_202401010100.udr").write_text(line() + "\n")
    assert run("c1") == 1
    (folder / "n_202401010200.udr").write_text("\n".join(line(LastPolledTime=1706000000000 + 1000 * k) for k in range(1, 5)) + "\n")
    assert run("c2") == 5


def test_a_file_with_a_bad_field_waits_whole(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "n_202401010100.udr").write_text(line() + "\n" + line(drop=["FapStatus"]) + "\n")
    jobs.ingest_files(spark, str(folder), str(tmp_path / "t"), str(tmp_path / "c"), "UTC", "me").awaitTermination()
    store = VersionedTables(spark, str(tmp_path / "t"))
    assert store.read("records", METER_RECORD).count() == 0
    assert [(r.n_lines, r.file_ok) for r in store.read("files", FILE_STATUS).collect()] == [(2, False)]


def test_versioned_tables(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path / "v"))
    one = spark.range(3)
    assert store.read("t", one.schema).count() == 0
    assert store.publish(0, append={"t": one, "u": one})
    assert not store.publish(0, append={"t": one})
    store.publish(1, append={"t": one})
    assert store.read("t", one.schema).count() == 6
    store.publish(2, replace={"t": store.read("t", one.schema).limit(1)})
    store.publish(3, append={"t": one})
    assert store.read("t", one.schema).count() == 4 and store.read("u", one.schema).count() == 3
    # another stream's batch 0 follows
    assert store.publish(0, append={"t": one}, stream="other") and not store.publish(0, append={"t": one}, stream="other")
    assert store.read("t", one.schema).count() == 7 and store.batches() == [0, 1, 2, 3, 4]
    # rows of a batch that was never committed stay unseen, and the batch can be repeated
    one.write.parquet(str(tmp_path / "v/t/commit=batch-4-lost"))
    assert store.read("t", one.schema).count() == 7
    assert store.publish(4, append={"t": one}) and store.read("t", one.schema).count() == 10


@pytest.mark.parametrize("sep", ["^", ";"])
def test_csv_keeps_nulls_and_separators(spark, tmp_path, sep):
    df = spark.createDataFrame([(1, "a^b;c"), (2, None), (3, "-"), (4, 'q"x')], "id int, s string")
    write_csv(df, str(tmp_path / "c"), sep)
    back = read_csv(spark, str(tmp_path / "c"), df.schema, sep)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
