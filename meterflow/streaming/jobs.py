"""The jobs as incremental runs: file streams into versioned tables.

Each job is a batch operator inside ``foreachBatch``. The stream's checkpoint makes sure that
a file is read once; the stream's id and batch number in the table's commit make a repeated batch harmless.
A stream that starts anew has another id: its batches follow the ones that are there.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from meterflow.functions.expr import ntz
from meterflow.operators import summaries
from meterflow.operators.changes import insertable, retain
from meterflow.plans.history import known_of, next_live, sketch
from meterflow.plans.sessions import analysis_view, changes_delta, session_stage
from meterflow.plans.usage import RETAIN_DAYS, next_state, usage_increments
from meterflow.schemas import COUNTER_STATE, ETL_DAY, METER_RECORD, RUN_COUNTS, SESSION_HISTORY, SESSION_STAGE, SNAPSHOT
from meterflow.session import small_table
from meterflow.sources.meter_files import (
    USABLE,
    accepted,
    classify_lines,
    file_status,
    finished_only,
    quarantined,
    stream_lines,
)
from meterflow.sources.snapshots import with_etl_day
from meterflow.sources.versions import Conflict, VersionedTables

MOST_TRIES = 10
RECORD_KEYS = ["subscriber_number", "clock", "ns"]


def run_stream(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int, str], None], mode: str = "append") -> StreamingQuery:
    """Process what is there now, in batches, then stop; run again on the next schedule."""

    def batch(rows: DataFrame, number: int) -> None:
        _repeated(lambda: work(rows, number, _stream_id(rows.sparkSession, checkpoint)))

    writer = stream.writeStream.foreachBatch(batch).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _repeated(work: Callable[[], None]) -> None:
    """Calculate again as long as other writers change the tables meanwhile."""
    for _ in range(MOST_TRIES - 1):
        try:
            return work()
        except Conflict:
            pass
    return work()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream has written into its checkpoint before its first batch."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def _same_time(target: DataFrame, rows: DataFrame, col: str) -> DataFrame:
    """The part of a table in the time range of a batch; the range reaches the scan."""
    low = rows.agg(F.coalesce(F.min(col), ntz("9999-12-31 00:00:00"))).scalar()
    high = rows.agg(F.coalesce(F.max(col), ntz("0001-01-01 00:00:00"))).scalar()
    return target.where((F.col(col) >= low) & (F.col(col) <= high))


def ingest_files(
    spark: SparkSession,
    folder: str,
    tables: str,
    checkpoint: str,
    tz: str,
    created_by: str,
    glob: str = "*.udr",
    max_files: int | None = None,
) -> StreamingQuery:
    """New meter files into ``records`` (known keys ignored), ``quarantine``, ``files`` (a status row per file) and ``run_counts``.

    ``run_counts`` has a row for each batch: lines read, records, bad lines and records that were new, taken in passing while the other tables are
    written, and committed with them.

    A file is stored as a whole or not at all: one with a wrong field leaves no record and waits in ``files`` as
    not done, until it is sent again under another name. A batch holds whole files.
    """

    def work(lines: DataFrame, batch: int, stream: str) -> None:
        session = lines.sparkSession
        store = VersionedTables(session, tables)
        classified = classify_lines(lines, tz, created_by).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            status = file_status(classified)
            rows = finished_only(accepted(classified), status)
            # equal keys have equal clocks, so older and newer records cannot conflict
            before = store.state()
            near = _same_time(store.read("records", METER_RECORD, before), rows, "end_date")
            new = insertable(near, rows, RECORD_KEYS, tie_break=["udr_file_name", "end_date"])
            read, added = Observation(), Observation()
            changes = {
                "records": new.observe(added, F.count(F.lit(1)).alias("n_new")),
                "quarantine": quarantined(classified),
                "files": status.observe(read, *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_lines", "n_records", "n_bad_json", "n_bad_field")]),
                "run_counts": lambda: small_table(session, [{"stream": stream, "batch": batch} | read.get | added.get], RUN_COUNTS),
            }
            store.publish(batch, append=changes, stream=stream, reads=("records",), since=before)
        finally:
            classified.unpersist()

    return run_stream(stream_lines(spark, folder, glob, max_files), checkpoint, work)


def unique_records(records: DataFrame, delay: str = "31 days") -> DataFrame:
    """Streaming form of insert-ignore: a key is passed once within the delay."""
    # watermarks need a timestamp with a zone
    timed = records.withColumn("_event_time", F.col("end_date").cast("timestamp"))
    unique = timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(RECORD_KEYS)
    return unique.drop("_event_time")


def usage_from_log(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    tables: str,
    checkpoint: str,
    as_of: dt.datetime,
    max_files: int | None = None,
    compact_every: int = 24,
    retain_days: int = RETAIN_DAYS,
) -> StreamingQuery:
    """New log files into the tables ``increments`` and ``state``, committed together.

    A batch appends its readings to the state; the newest reading per subscriber is looked
    up when it is needed. ``as_of`` is the time of the run: state older than ``retain_days`` before it plays no part in
    any batch, whether or not it has been removed. After ``compact_every`` batches the state is rewritten without
    replaced and expired rows, which changes no result.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def work(rows: DataFrame, batch: int, stream: str) -> None:
        session = rows.sparkSession
        store = VersionedTables(session, tables)
        usable = rows.where(F.col("terminal_status").isin(*USABLE)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = store.state()
            state = retain(store.read("state", COUNTER_STATE, before), ntz(str(as_of)), retain_days)
            increments = usage_increments(usable, state)
            commit = {"stream": stream, "reads": ("state",), "since": before}
            if len(store.folders("state", before)) < compact_every:
                readings = usable.withColumn("load_time", ntz(str(as_of))).select(*COUNTER_STATE.names)
                store.publish(batch, append={"increments": increments, "state": readings}, **commit)
            else:
                full = next_state(state, usable, as_of)
                store.publish(batch, append={"increments": increments}, replace={"state": full}, **commit)
        finally:
            usable.unpersist()

    return run_stream(reader.parquet(folder), checkpoint, work)


def sessions_from_snapshots(
    spark: SparkSession,
    folder: str,
    tables: str,
    checkpoint: str,
    max_files: int | None = None,
    latest_only: bool = False,
) -> StreamingQuery:
    """New snapshot files into the tables ``history`` and ``analysis``, one commit for each snapshot (``extract_date``, one time for all its rows).

    A backlog holds several snapshots; each is compared with the history that the ones before it leave, in the order of
    time. The history grows by the changes only; it is never rewritten. Where a limit of files cuts a snapshot, its
    rest is a snapshot of the next batch.
    """
    reader = spark.readStream.schema(SESSION_STAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def work(rows: DataFrame, batch: int, stream: str) -> None:
        store = VersionedTables(rows.sparkSession, tables)
        for place, part in enumerate(_snapshots(rows)):
            _add_changes(store, part, batch, f"{stream}-{place}", latest_only)

    return run_stream(reader.parquet(folder), checkpoint, work)


def _snapshots(rows: DataFrame) -> Iterator[DataFrame]:
    """Each snapshot among the rows, oldest first, one without a time at the end. The driver gets a time for each snapshot, not for each row."""
    times = [r["extract_date"] for r in rows.select("extract_date").distinct().collect()]
    for time in sorted(times, key=lambda t: (t is None, t or dt.datetime.min)):
        yield rows.where(F.col("extract_date").eqNullSafe(F.lit(None) if time is None else ntz(str(time))))


def _add_changes(
    store: VersionedTables, snapshot: DataFrame, batch: int, stream: str, latest_only: bool, offsets: dict[str, int] | None = None
) -> None:
    """A snapshot's changes into ``history`` and ``analysis``, with the tables that spare the next snapshot the history (``live``, ``sketches``).

    The changes are calculated once, as they are written to ``history``; the other tables are made from the columns they need of these files.
    """
    before = store.state()
    if before.streams.get(stream, -1) >= batch:
        return
    stage = session_stage(snapshot).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = known_of(store, stage, before)[0]
        name = store.part_name(stream, batch)
        written = lambda: store.read_parts("history", SESSION_HISTORY, [name])
        changes = {
            "history": changes_delta(stage, known, latest_only).drop("new_ind"),
            "analysis": lambda: analysis_view(written()),
            "sketches": lambda: sketch(written()),
        }
        live = {"live": lambda: next_live(known, written(), stage)}
        store.publish(batch, append=changes, replace=live, stream=stream, offsets=offsets, reads=("history", "live"), since=before, name=name)
    finally:
        stage.unpersist()


# --- jobs that follow other jobs -----------------------------------------------------------


def follow(upstream: VersionedTables, downstream: VersionedTables, name: str, work: Callable[[int, dict[str, int]], None]) -> int:
    """Call ``work`` for each commit of ``upstream`` that ``downstream`` does not know yet, oldest first; returns how many there were.

    ``work(n, offsets)`` calculates from what commit ``n`` has added and publishes it downstream as batch ``n`` of the stream ``name``, with the offsets. So the downstream commit itself says how far the
    job has come: one that was killed before its commit is repeated, one that was killed after it is not, and a row that was committed upstream
    counts downstream exactly once. Commits that only rewrite files are passed over.
    """
    done = downstream.state().offsets.get(name, -1)
    seen = 0
    for n in range(done + 1, upstream.last() + 1):
        if not upstream.commit(n).rewrites:
            _repeated(lambda n=n: work(n, {name: n}))
            seen += 1
    return seen


def capture_snapshots(spark: SparkSession, folder: str, tables: str, checkpoint: str, max_files: int | None = None) -> StreamingQuery:
    """New snapshot files into the table ``snapshots``, laid out by the day of their interval, one commit for each snapshot."""
    reader = spark.readStream.schema(SESSION_STAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def work(rows: DataFrame, batch: int, stream: str) -> None:
        store = VersionedTables(rows.sparkSession, tables)
        for place, part in enumerate(_snapshots(rows)):
            store.publish(batch, append={"snapshots": with_etl_day(part)}, stream=f"{stream}-{place}", by={"snapshots": ETL_DAY})

    return run_stream(reader.parquet(folder), checkpoint, work)


def changes_from_capture(spark: SparkSession, captured: str, tables: str, latest_only: bool = False, name: str = "changes") -> int:
    """Snapshots as they are committed into ``history`` and ``analysis``, a commit for a commit."""
    source, store = VersionedTables(spark, captured), VersionedTables(spark, tables)

    def work(n: int, offsets: dict[str, int]) -> None:
        snapshot = source.added(n, "snapshots", SNAPSHOT).drop(ETL_DAY)
        _add_changes(store, snapshot, n, name, latest_only, offsets)

    return follow(source, store, name, work)


def usage_from_changes(spark: SparkSession, changed: str, tables: str, compact_every: int = 24, name: str = "usage") -> int:
    """Changes as they are committed into ``user_sums``: what each commit adds to each user. ``summaries.current`` gives the totals."""
    source, store = VersionedTables(spark, changed), VersionedTables(spark, tables)
    schema = summaries.SESSIONS.schema(SESSION_HISTORY)

    def work(n: int, offsets: dict[str, int]) -> None:
        sums = summaries.change(summaries.SESSIONS, after=source.added(n, "history", SESSION_HISTORY))
        store.publish(n, append={"user_sums": sums}, stream=name, offsets=offsets)

    seen = follow(source, store, name, work)
    if seen and len(store.folders("user_sums")) >= compact_every:
        merged = summaries.merged(summaries.SESSIONS, store.read("user_sums", schema))
        store.rewrite("user_sums", store.state().parts["user_sums"], merged)
    return seen
