"""The registered queries: every operator over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.catalog import bindings as b
from meterflow.functions.expr import ntz
from meterflow.operators import changes, rollup, summaries
from meterflow.plans import repair, sessions, sql_text, telemetry, usage
from meterflow.schemas import (
    COUNTER_STATE,
    ETL_DAY,
    FILE_STATUS,
    METER_LOG,
    METER_RECORD,
    PROCESS_SNAPSHOT,
    RUN_COUNTS,
    SESSION_ANALYSIS_COLUMNS,
    SESSION_HISTORY,
    SESSION_STAGE,
    SNAPSHOT,
    USAGE_RESULT,
)
from meterflow.session import scratch_dir
from meterflow.sources import meter_files, snapshots, tables
from meterflow.sources.versions import VersionedTables
from meterflow.streaming import jobs, readings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
REPLAY_FROM = dt.date(2024, 1, 25)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- meter usage -------------------------------------------------------------------------


@query
def usage_increment(spark, d):
    return usage.usage_increments(b.usage_batch(spark, d), b.usage_state(spark, d))


@query
def usage_lag(spark, d):
    rows = b.usage_log(spark, d).where(F.col("terminal_status").isin("normal", "minor"))
    return usage.with_lags(rows).select("id", "subscriber_number", *usage.LAGS)


@query
def latest_state(spark, d):
    return usage.latest_state(b.usage_state(spark, d, until=None))


@query
def anomaly_flag(spark, d):
    rows = usage.with_previous(b.usage_batch(spark, d), b.usage_state(spark, d))
    flags = usage.anomaly_flags()
    return rows.withColumns(flags).select("id", "prev_clock", "prev_usage", "prev_offpeak", "prev_tokens", *flags)


@query
def anomaly_flag_sql(spark, d):
    """The same flags by the function that SQL users call."""
    sql_text.register_functions(spark)
    rows = usage.with_previous(b.usage_batch(spark, d), b.usage_state(spark, d))
    return spark.sql("""
        SELECT id, prev_clock, prev_usage, prev_offpeak, prev_tokens,
          is_not_anomaly(clock, overall_usage_anytime, prev_clock, prev_usage) AS is_not_anomaly_usage,
          is_not_anomaly(clock, overall_usage_offpeak, prev_clock, prev_offpeak, :rate) AS is_not_anomaly_offpeak,
          is_not_anomaly(clock, prev_tokens, prev_clock, overall_available_tokens) AS is_not_anomaly_token
        FROM {rows}""", args={"rate": usage.ALLOWED_RATE}, rows=rows)


@query
def usage_with_rejects(spark, d):
    return usage.increments_with_rejects(b.usage_batch(spark, d), b.usage_state(spark, d))


@query
def pending_usage_topk(spark, d):
    return usage.read_unsummarised(b.full_log(spark, d), b.AS_OF, cap=1000)


@query
def usage_period(spark, d):
    return usage.period(b.usage_batch(spark, d), b.usage_state(spark, d))


@query
def usage_pipeline(spark, d):
    log, _ = usage.summarise_batch(b.full_log(spark, d), b.usage_state(spark, d), b.AS_OF)
    return log


@query
def usage_pipeline_capped(spark, d):
    log, _ = usage.summarise_batch(b.full_log(spark, d), b.usage_state(spark, d), b.AS_OF, cap=1000)
    return log


@query
def usage_pipeline_state(spark, d):
    _, state = usage.summarise_batch(b.full_log(spark, d), b.usage_state(spark, d), b.AS_OF)
    return state


def _replayed(spark, d):
    log = b.full_log(spark, d).withColumn("summary_flag", F.when(
        F.col("terminal_status").isin("normal", "minor"), 1).otherwise(-1))
    state = b.usage_state(spark, d, until=None)
    return log, *usage.reset_and_replay(log, state, REPLAY_FROM, retain_days=20)


@query
def usage_replay(spark, d):
    return _replayed(spark, d)[1]


@query
def usage_replay_state(spark, d):
    return _replayed(spark, d)[2]


def _late(spark, d) -> tuple[VersionedTables, repair.Repair]:
    """A log that was replayed without every eleventh reading of the last days; these come late."""
    store = VersionedTables(spark, scratch_dir(spark, "log"))
    is_late = F.col("id") % 11 == 0
    usable, again = F.col("terminal_status").isin("normal", "minor"), F.col("end_date") >= ntz(f"{REPLAY_FROM} 00:00:00")
    log = b.full_log(spark, d).withColumn("summary_flag", F.when(usable, 1).otherwise(-1))
    state = b.usage_state(spark, d, until=None)
    done, _ = usage.reset_and_replay(log.where(~(is_late & usable & again)), state, REPLAY_FROM, retain_days=20)
    late = log.where(is_late & usable & again).withColumn("summary_flag", F.lit(0))
    rows = usage.with_day(done.unionByName(late))
    store.publish(0, append={"log": rows.repartition(usage.DAY)}, by={"log": usage.DAY})
    kept = changes.retain(state, ntz(f"{REPLAY_FROM} 00:00:00"), 20)
    as_of = dt.datetime.combine(REPLAY_FROM, dt.time()) + dt.timedelta(days=1)
    return store, repair.repair_late(store.read("log", usage.LOG_BY_DAY), kept, repair.days_of(store, "log"), REPLAY_FROM, as_of)


@query
def usage_late_repair(spark, d):
    """The log after its late readings were repaired: as if all had been replayed."""
    store, found = _late(spark, d)
    repair.apply_repair(store, "log", found, usage.LOG_BY_DAY)
    return store.read("log", METER_LOG)


@query
def keyed_update(spark, d):
    """Corrections for every third row, each twice, some with empty values."""
    log = b.full_log(spark, d)
    third = log.where(F.col("id") % 3 == 0)
    fixes = third.select("id", "end_date", F.when(F.col("id") % 2 == 0, F.col("id") * 2).alias("usage_anytime"),
                         F.lit(7).alias("summary_flag"))
    lower = fixes.withColumn("summary_flag", F.lit(6))
    return changes.keyed_update(
        log, fixes.unionByName(lower), ["id", "end_date"], ["usage_anytime", "summary_flag"],
        tie_break=["summary_flag"],
    )


@query
def state_upsert(spark, d):
    """State with a batch that repeats a fifth of its keys under higher ids."""
    state = b.usage_state(spark, d)
    again = state.where(F.col("id") % 5 == 0).withColumn("id", F.col("id") + 1000000)
    fresh = b.usage_batch(spark, d).select(*[c for c in COUNTER_STATE.names if c != "load_time"])
    rows = fresh.unionByName(again.drop("load_time")).unionByName(
        again.drop("load_time").withColumn("id", F.col("id") + 1)
    )
    return usage.upsert(state, rows, usage.STATE_KEYS, "2024-01-31 00:00:00", tie_break=["id"])


@query
def state_retention(spark, d):
    return changes.retain(b.usage_state(spark, d, until=None), ntz("2024-02-14 00:00:00"), days=40)


@query
def state_rewind(spark, d):
    return changes.rewind(b.usage_state(spark, d, until=None), ntz("2024-01-10 00:00:00"))


def _state_by_day(spark, d) -> VersionedTables:
    store = VersionedTables(spark, scratch_dir(spark, "state"))
    state = usage.with_day(b.usage_state(spark, d, until=None))
    store.publish(0, append={"state": state.repartition(usage.DAY)}, by={"state": usage.DAY})
    return store


@query
def state_retention_by_day(spark, d):
    """Days before the boundary go as a whole; only the day of the boundary is written anew."""
    store = _state_by_day(spark, d)
    store.trim("state", usage.STATE_BY_DAY, usage.DAY, "end_date", above=dt.datetime(2024, 2, 14, 12) - dt.timedelta(days=usage.RETAIN_DAYS))
    return store.read("state", COUNTER_STATE)


@query
def state_rewind_by_day(spark, d):
    store = _state_by_day(spark, d)
    store.trim("state", usage.STATE_BY_DAY, usage.DAY, "end_date", below=dt.datetime(2024, 1, 10))
    return store.read("state", COUNTER_STATE)


@query
def keyed_update_by_file(spark, d):
    """The corrections of ``keyed_update`` for one number in a table of several files: only files with such readings are rewritten."""
    store = VersionedTables(spark, scratch_dir(spark, "files"))
    log = b.full_log(spark, d)
    schema = log.schema
    store.publish(0, append={"log": log.repartitionByRange(8, "id")})
    fixes = log.where(F.col("subscriber_number") == "7").select("id", "end_date", F.lit(None).cast("bigint").alias("usage_anytime"), F.lit(7).alias("summary_flag"))
    keys, columns = ["id", "end_date"], ["usage_anytime", "summary_flag"]
    store.update("log", schema, fixes, keys, lambda target, rows: changes.keyed_update(target, rows, keys, columns))
    return store.read("log", schema)


@query
def flag_reset(spark, d):
    return changes.flag_reset(b.full_log(spark, d), ntz("2024-01-10 00:00:00"), ("normal", "minor"))


@query
def daily_usage(spark, d):
    log, _ = usage.summarise_batch(b.full_log(spark, d), b.usage_state(spark, d), b.AS_OF)
    return rollup.daily_usage(log).withColumn("day", F.col("day").cast("string"))


@query
def daily_usage_maintained(spark, d):
    """A first run adds its rows; a replay subtracts what the replayed days had and adds what they have now."""
    before, after, _ = _replayed(spark, d)
    since = ntz(f"{REPLAY_FROM} 00:00:00")
    store = VersionedTables(spark, scratch_dir(spark, "daily"))
    store.publish(0, append={"daily": summaries.change(summaries.DAILY, before)})
    touched = [rows.where(F.col("end_date") >= since) for rows in (after, before)]
    store.publish(1, append={"daily": summaries.change(summaries.DAILY, *touched)})
    daily = summaries.current(summaries.DAILY, store.read("daily", summaries.DAILY.schema(METER_LOG)))
    return daily.withColumn("day", F.col("day").cast("string"))


def _flagged(spark, d):
    log = b.usage_log(spark, d)
    records = log.withColumn("state", F.when(F.col("id") % 7 != 0, F.col("id") % 3))
    logged = records.where(F.col("id") % 2 == 0).withColumn("id", -F.col("id"))
    return changes.move_flagged(records, logged)


@query
def move_flagged(spark, d):
    remaining, log = _flagged(spark, d)
    return remaining.withColumn("part", F.lit("remaining")).unionByName(
        log.withColumn("part", F.lit("log"))
    )


@query
def insert_ignore(spark, d):
    """Every second reading is known; the incoming rows hold everything, some twice."""
    cols = ["id", "subscriber_number", "clock", "overall_usage_anytime"]
    log = b.usage_log(spark, d).select(*cols)
    target = log.where(F.col("id") % 2 == 0)
    twice = log.where(F.col("id") % 3 == 0).withColumn("id", F.col("id") + 1000000)
    return changes.insert_ignore(target, log.unionByName(twice), ["subscriber_number", "clock"], ["id"])


# --- meter files -------------------------------------------------------------------------


def _classified(spark, d):
    return meter_files.classify_lines(b.meter_lines(spark, d), b.TZ, "meter")


@query
def udr_parse(spark, d):
    records, _ = meter_files.parse_udr(b.meter_lines(spark, d), b.TZ, "meter")
    return records


@query
def udr_quarantine(spark, d):
    _, bad = meter_files.parse_udr(b.meter_lines(spark, d), b.TZ, "meter")
    return bad


@query
def udr_route(spark, d):
    return _classified(spark, d).groupBy("udr_file_name", "route").agg(F.count(F.lit(1)).alias("n"))


@query
def udr_accept(spark, d):
    return _classified(spark, d).groupBy("udr_file_name", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def udr_file_select(spark, d):
    return meter_files.select_files(b.file_listing(spark, d), cap=35)


@query
def udr_file_status(spark, d):
    return meter_files.file_status(_classified(spark, d))


@query
def udr_finished_records(spark, d):
    rows = _classified(spark, d)
    return meter_files.finished_only(meter_files.accepted(rows), meter_files.file_status(rows))


@query
def udr_pending_alert(spark, d):
    return meter_files.pending_files(meter_files.file_status(_classified(spark, d)))


# --- sessions ----------------------------------------------------------------------------


@query
def snapshot_stamp(spark, d):
    return snapshots.stamp_snapshot(
        b.table(spark, d, "orders"), "2024-01-01 02:00:05", "2024-01-01 02:00:00"
    )


@query
def log_delta_extract(spark, d):
    return snapshots.log_delta(b.session_log(spark, d), "1997-01-01 00:00:00", "1999-01-01 00:00:00")


@query
def snapshot_window_read(spark, d):
    orders = b.table(spark, d, "orders").withColumn("etl_date", F.col("o_orderdate"))
    return snapshots.snapshot_window(orders, "1997-01-01 00:00:00", "1999-01-01 00:00:00")


@query
def snapshot_interval_read(spark, d):
    """Three captured snapshots, laid out by day; the interval is one of them."""
    store = VersionedTables(spark, scratch_dir(spark, "captured"))
    second = b.session_snapshot(spark, d)
    third = snapshots.stamp_snapshot(second, "2024-01-02 02:00:00", "2024-01-02 02:00:00")
    for n, snapshot in enumerate((b.first_snapshot(spark, d), second, third)):
        rows = snapshots.with_etl_day(snapshot.select(*SESSION_STAGE.names))
        store.publish(n, append={"snapshots": rows}, by={"snapshots": ETL_DAY})
    found = snapshots.snapshot_window(store.read("snapshots", SNAPSHOT), "2024-01-01 00:00:00", "2024-01-01 02:00:00")
    return found.select("acctuniqueid", "username", "acctstarttime", "acctinputoctets", "acctoutputoctets", "etl_date")


def _stage(spark, d):
    return sessions.session_stage(b.session_snapshot(spark, d))


@query
def session_stage(spark, d):
    return _stage(spark, d)


@query
def session_stage_sql(spark, d):
    """The stage of one of two captured intervals, from the job's SQL text."""
    columns = SESSION_STAGE.names
    snapshots_ = b.first_snapshot(spark, d).select(*columns).unionByName(b.session_snapshot(spark, d).select(*columns))
    return sql_text.session_stage_text(snapshots_, "2024-01-01 00:00:00", dt.datetime(2024, 1, 1, 2))


@query
def session_unchanged(spark, d):
    return sessions.session_unchanged(_stage(spark, d), b.session_history(spark, d))


@query
def session_unchanged_latest(spark, d):
    return sessions.session_unchanged(_stage(spark, d), b.session_history(spark, d), latest_only=True)


@query
def session_cleaned(spark, d):
    return sessions.session_cleaned(_stage(spark, d), b.session_history(spark, d))


@query
def session_track(spark, d):
    track = sessions.session_track(_stage(spark, d), b.session_history(spark, d))
    return track.select(*sessions.STAGE_COLUMNS, "new_ind", "track_ind")


@query
def session_new(spark, d):
    return sessions.session_changes(_stage(spark, d), b.session_history(spark, d))[0]


@query
def session_changed(spark, d):
    return sessions.session_changes(_stage(spark, d), b.session_history(spark, d))[1]


@query
def session_history_append(spark, d):
    history = b.session_history(spark, d)
    return sessions.append_history(history, sessions.changes_delta(_stage(spark, d), history))


@query
def session_analysis(spark, d):
    return sessions.analysis_view(sessions.changes_delta(_stage(spark, d), b.session_history(spark, d)))


@query
def session_usage(spark, d):
    start, end = ntz("2024-01-01 00:00:00"), ntz("2024-01-01 02:00:00")
    history = b.session_history(spark, d)
    delta = sessions.changes_delta(_stage(spark, d), history)
    return rollup.session_usage(sessions.append_history(history, delta), start, end)


@query
def snapshot_series_delta(spark, d):
    cols = ["username", "acctstarttime", "acctuniqueid", "acctinputoctets", "acctoutputoctets"]
    return sessions.snapshot_series_delta(
        b.session_snapshot(spark, d).select(*cols), ["username"], ["acctstarttime", "acctuniqueid"],
        ["acctinputoctets", "acctoutputoctets"],
    )


# --- telemetry ---------------------------------------------------------------------------


@query
def proc_active(spark, d):
    return telemetry.proc_active(b.process_snapshots(spark, d))


@query
def proc_user_count(spark, d):
    return telemetry.user_counts(telemetry.proc_active(b.process_snapshots(spark, d)), ["server"])


def _long(spark, d):
    active = telemetry.proc_active(b.process_snapshots(spark, d))
    return telemetry.long_running(active, telemetry.REPORT)


@query
def proc_long_running(spark, d):
    return _long(spark, d)


@query
def proc_captions(spark, d):
    return telemetry.caption_texts(_long(spark, d), telemetry.REPORT)


@query
def disk_parse(spark, d):
    return telemetry.disk_parse(b.disk_lines(spark, d))


@query
def disk_alert(spark, d):
    return telemetry.disk_report(b.disk_lines(spark, d), b.disk_rules(spark))[0]


@query
def disk_alert_text(spark, d):
    return telemetry.disk_report(b.disk_lines(spark, d), b.disk_rules(spark))[1]


@query
def csv_roundtrip(spark, d):
    """Active processes through a caret-separated file, their long runners through a semicolon one."""
    active = telemetry.proc_active(b.process_snapshots(spark, d))
    folder = scratch_dir(spark, "csv")
    tables.write_csv(active, f"{folder}/processes", "^")
    back = tables.read_csv(spark, f"{folder}/processes", PROCESS_SNAPSHOT, "^")
    long = telemetry.long_running(back, telemetry.REPORT)
    tables.write_csv(long, f"{folder}/long", ";")
    return tables.read_csv(spark, f"{folder}/long", long.schema, ";")


# --- streams -----------------------------------------------------------------------------


def _meter_folder(lines, folder: str) -> None:
    """The lines as one meter file per name."""
    lines.repartition("udr_file_name").write.partitionBy("udr_file_name").text(f"{folder}/parts")
    path = lines.sparkSession._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(lines.sparkSession._jsc.hadoopConfiguration())
    fs.mkdirs(path(f"{folder}/in"))
    for found in fs.globStatus(path(f"{folder}/parts/udr_file_name=*/part-*")):
        name = found.getPath().getParent().getName().partition("=")[2]
        fs.rename(found.getPath(), path(f"{folder}/in/{name}"))


def _ingested(spark, d) -> VersionedTables:
    """The meter lines, written out as one file per hour, through the ingest stream."""
    folder = scratch_dir(spark, "ingest")
    _meter_folder(b.meter_lines(spark, d).where(F.col("value").isNotNull()), folder)
    run = jobs.ingest_files(spark, f"{folder}/in", f"{folder}/tables", f"{folder}/checkpoint", b.TZ, "meter")
    run.awaitTermination()
    return VersionedTables(spark, f"{folder}/tables")


@query
def udr_stream_ingest(spark, d):
    return _ingested(spark, d).read("records", METER_RECORD)


@query
def udr_stream_status(spark, d):
    return _ingested(spark, d).read("files", FILE_STATUS)


@query
def udr_stream_unique(spark, d):
    """Keys of all accepted records, which come twice, through the watermark form of insert-ignore."""
    folder = scratch_dir(spark, "unique")
    records, _ = meter_files.parse_udr(b.meter_lines(spark, d), b.TZ, "meter")
    tables.write_parquet(records, f"{folder}/in")
    tables.write_parquet(records, f"{folder}/in")
    stream = jobs.unique_records(spark.readStream.schema(METER_RECORD).parquet(f"{folder}/in"))

    def work(rows, batch, name):
        VersionedTables(rows.sparkSession, f"{folder}/tables").publish(batch, append={"records": rows.select(*METER_RECORD.names)}, stream=name)

    jobs.run_stream(stream, f"{folder}/checkpoint", work).awaitTermination()
    return VersionedTables(spark, f"{folder}/tables").read("records", METER_RECORD).select(*jobs.RECORD_KEYS)


@query
def udr_stream_counts(spark, d):
    """What the ingest stream counted while it wrote its tables."""
    return _ingested(spark, d).read("run_counts", RUN_COUNTS).select("batch", "n_lines", "n_records", "n_bad_json", "n_bad_field", "n_new")


@query
def usage_stream(spark, d):
    """The batch in four runs of the usage stream, each starting from the state of the one before."""
    folder = scratch_dir(spark, "usage")
    store = VersionedTables(spark, f"{folder}/tables")
    batch = b.usage_batch(spark, d).select(*usage.READ_COLUMNS)
    cuts = [None, ntz("2024-01-20 00:00:00"), ntz("2024-01-24 00:00:00"), ntz("2024-01-28 00:00:00"), None]
    for start, end in zip(cuts, cuts[1:]):
        part = batch if start is None else batch.where(F.col("end_date") >= start)
        part = part if end is None else part.where(F.col("end_date") < end)
        tables.write_parquet(part, f"{folder}/in")
        jobs.usage_from_log(
            spark, f"{folder}/in", batch.schema, f"{folder}/tables", f"{folder}/checkpoint", b.AS_OF, compact_every=2
        ).awaitTermination()
    return store.read("increments", USAGE_RESULT)


@query
def usage_state_stream(spark, d):
    """The same four runs, with the readings before them in the stream's state store."""
    folder = scratch_dir(spark, "readings")
    batch = b.usage_batch(spark, d).select(*usage.READ_COLUMNS)
    cuts = [None, ntz("2024-01-20 00:00:00"), ntz("2024-01-24 00:00:00"), ntz("2024-01-28 00:00:00"), None]
    for start, end in zip(cuts, cuts[1:]):
        part = batch if start is None else batch.where(F.col("end_date") >= start)
        part = part if end is None else part.where(F.col("end_date") < end)
        tables.write_parquet(part, f"{folder}/in")
        readings.usage_by_state(spark, f"{folder}/in", batch.schema, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    return VersionedTables(spark, f"{folder}/tables").read("increments", USAGE_RESULT)


@query
def usage_state_late(spark, d):
    """The newer half of the log comes first; of the older half all that is beyond the horizon is set aside."""
    folder = scratch_dir(spark, "late")
    log = b.usage_log(spark, d).select(*usage.READ_COLUMNS)
    for part in (f"end_date >= timestamp_ntz'{b.CUT}'", f"end_date < timestamp_ntz'{b.CUT}'"):
        tables.write_parquet(log.where(part), f"{folder}/in")
        readings.usage_by_state(spark, f"{folder}/in", log.schema, f"{folder}/tables", f"{folder}/checkpoint", horizon_days=20).awaitTermination()
    return VersionedTables(spark, f"{folder}/tables").read("late", readings.LATE)


def _session_stream(spark, d, together: bool):
    folder = scratch_dir(spark, "sessions")
    store = VersionedTables(spark, f"{folder}/tables")
    for snapshot in (b.first_snapshot(spark, d), b.session_snapshot(spark, d)):
        tables.write_parquet(snapshot.select(*SESSION_STAGE.names), f"{folder}/in")
        if not together:
            jobs.sessions_from_snapshots(spark, f"{folder}/in", f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    if together:
        jobs.sessions_from_snapshots(spark, f"{folder}/in", f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    return store.read("history", SESSION_HISTORY).select(*SESSION_ANALYSIS_COLUMNS)


@query
def session_stream(spark, d):
    """Two snapshots through the session stream; the second one comes against the first's history."""
    return _session_stream(spark, d, together=False)


@query
def session_stream_backlog(spark, d):
    """The same snapshots found by one run: each is an interval of its own all the same."""
    return _session_stream(spark, d, together=True)


def _chain(spark, d) -> dict[str, VersionedTables]:
    """Two snapshots, captured one after the other; each time the jobs behind follow what was committed."""
    folder = scratch_dir(spark, "chain")
    captured, changed, summed = (f"{folder}/{job}" for job in ("captured", "changed", "summed"))
    for snapshot in (b.first_snapshot(spark, d), b.session_snapshot(spark, d)):
        tables.write_parquet(snapshot.select(*SESSION_STAGE.names), f"{folder}/in")
        jobs.capture_snapshots(spark, f"{folder}/in", captured, f"{folder}/checkpoint").awaitTermination()
        jobs.changes_from_capture(spark, captured, changed)
        jobs.usage_from_changes(spark, changed, summed, compact_every=2)
    return {job: VersionedTables(spark, f"{folder}/{job}") for job in ("captured", "changed", "summed")}


@query
def session_chain(spark, d):
    """Octets per user at the end of the chain: capture, changes, sums."""
    schema = summaries.SESSIONS.schema(SESSION_HISTORY)
    return summaries.current(summaries.SESSIONS, _chain(spark, d)["summed"].read("user_sums", schema))


@query
def session_chain_changes(spark, d):
    """The changes in the middle of the chain."""
    return _chain(spark, d)["changed"].read("analysis", SESSION_HISTORY).select(*SESSION_ANALYSIS_COLUMNS)
