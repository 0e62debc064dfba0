"""Usage with the last reading of every subscriber in the stream's own state store.

The store holds one reading for each subscriber. Event-time timers remove it when it is older than the retention time, so the state is as large as the number of
subscribers that are still heard of. Readings beyond the horizon are not dropped but flagged, and go to a table of their own.

Spark drops what is behind the watermark before a processor sees it. So the watermark is held back by ``DELAY_DAYS``, longer than any log lasts (it cannot go below 1970, so up to 1990 nothing is late or forgotten), and the processor adds this to it again: what it then has is
the newest time of all batches before, to which horizon and retention are measured.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from meterflow.plans.usage import COUNTERS, HORIZON_DAYS, READ_COLUMNS, RETAIN_DAYS, usage_from_previous
from meterflow.schemas import USAGE_RESULT
from meterflow.sources.meter_files import USABLE
from meterflow.sources.versions import VersionedTables
from meterflow.streaming.jobs import run_stream

DELAY_DAYS = 7300
DAY_MS = 86_400_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# stands for a missing number, also in the state; it is smaller than all others
NONE = -(1 << 63)
NUMBERS = ("clock", *COUNTERS)
LATE = T.StructType([T.StructField("id", T.LongType()), T.StructField("subscriber_number", T.StringType()), T.StructField("end_date", T.TimestampNTZType())])

_ROW = "subscriber_number string, id bigint, end_us bigint, terminal_status string, " + ", ".join(f"{c} bigint" for c in NUMBERS)
_OUT = f"{_ROW}, {', '.join(f'prev_{c} bigint' for c in NUMBERS)}, late boolean"
_STATE = "end_us bigint, id bigint, " + ", ".join(f"{c} bigint" for c in NUMBERS)
_IN = ("subscriber_number", "id", "end_us", "terminal_status", *NUMBERS)
_Out = Row(*_IN, *[f"prev_{c}" for c in NUMBERS], "late")


def _of_numbers(row: Row) -> tuple:
    return tuple(row[c] for c in NUMBERS)


class LastReading(StatefulProcessor):
    """Gives each reading of a subscriber the one before it: in its batch, or else the last one of earlier batches.

    Most subscribers have a few readings in a batch, so what counts is the cost of a subscriber: plain rows instead of pandas tables, and
    two calls to the state store. A timer is set once; when it fires and there is a newer reading, it is set again for that one.
    """

    def __init__(self, horizon_days: int, retain_days: int) -> None:
        self.horizon = horizon_days * DAY_MS * 1000
        self.retain = retain_days * DAY_MS * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _STATE)

    def _timer(self, end_us: int) -> int:
        """When, by the watermark that is held back, a reading is older than the retention time."""
        return (end_us + self.retain) // 1000 - DELAY_DAYS * DAY_MS

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = timerValues.getCurrentWatermarkInMs()
        newest = (held + DELAY_DAYS * DAY_MS) * 1000 if held > 0 else None
        timed, untimed, late = [], [], []
        for row in sorted(rows, key=itemgetter("end_us", "id")):
            if row["end_us"] == NONE:
                untimed.append(row)
            elif newest is not None and row["end_us"] < newest - self.horizon:
                late.append(row)
            else:
                timed.append(row)
        kept = self.last.get()
        self._remember(kept, timed)
        nothing = (NONE,) * len(NUMBERS)
        known = nothing if kept is None or (newest is not None and newest - kept[0] >= self.retain) else tuple(kept[2:])
        before = nothing
        # rows without a time come last, as in the batch
        for row in chain(timed, untimed):
            # where the reading before lacks a number, that of the state counts
            yield _Out(*[row[c] for c in _IN], *[k if b == NONE else b for b, k in zip(before, known)], False)
            before = _of_numbers(row)
        for row in late:
            yield _Out(*[row[c] for c in _IN], *known, True)

    def _remember(self, kept: tuple | None, timed: list[Row]) -> None:
        if not timed:
            return
        row = timed[-1]
        # of equal times the newer batch counts
        if kept is not None and kept[0] > row["end_us"]:
            return
        self.last.update((row["end_us"], row["id"], *_of_numbers(row)))
        if kept is None:
            self.handle.registerTimer(self._timer(row["end_us"]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = self.last.get()
        if kept is not None:
            due = self._timer(kept[0])
            if due > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(due)
            else:
                self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def _number(name: str) -> Column:
    return F.when(F.col(name) != NONE, F.col(name))


def with_last_reading(log: DataFrame, horizon_days: int = HORIZON_DAYS, retain_days: int = RETAIN_DAYS) -> DataFrame:
    """A stream of usable readings with the numbers of the readings before them (prev_*) and ``late``, as whole numbers with ``NONE`` for missing ones."""
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', end_date)")
    numbers = [F.coalesce(F.col(c), F.lit(NONE)).alias(c) for c in NUMBERS]
    rows = log.select(
        "subscriber_number", F.coalesce("id", F.lit(NONE)).alias("id"), F.coalesce(micros, F.lit(NONE)).alias("end_us"), "terminal_status", *numbers,
        F.timestamp_micros(micros).alias("event_time"),
    ).withWatermark("event_time", f"{DELAY_DAYS} days")
    grouped = rows.select("subscriber_number", "id", "end_us", "terminal_status", *NUMBERS, "event_time").groupBy("subscriber_number")
    return grouped.transformWithState(LastReading(horizon_days, retain_days), _OUT, "Update", "EventTime")


def _read_back(rows: DataFrame) -> DataFrame:
    """Readings with missing numbers and the columns that usage is calculated from."""
    end = F.expr("timestampadd(MICROSECOND, end_us, timestamp_ntz'1970-01-01 00:00:00')")
    plain = rows.select("subscriber_number", _number("id").alias("id"), F.when(F.col("end_us") != NONE, end).alias("end_date"), "terminal_status", "late",
                        *[_number(c).alias(c) for c in (*NUMBERS, *[f"prev_{c}" for c in NUMBERS])])
    zero = F.lit(0).cast("bigint")
    anytime, offpeak, tokens = COUNTERS
    return plain.withColumns({
        "prev_usage": F.coalesce(f"prev_{anytime}", zero),
        "prev_offpeak": F.coalesce(f"prev_{offpeak}", zero),
        "prev_tokens": F.coalesce(f"prev_{tokens}", zero),
    })


def usage_by_state(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    tables: str,
    checkpoint: str,
    max_files: int | None = None,
    horizon_days: int = HORIZON_DAYS,
    retain_days: int = RETAIN_DAYS,
) -> StreamingQuery:
    """New log files into the tables ``increments`` and ``late``.

    As ``usage_from_log``, but what was read before is in the state store of the stream and not in a table. Readings that are more than ``horizon_days`` older than the newest of the batches
    before go to ``late``, for a repair; a subscriber's reading is forgotten ``retain_days`` after it. All of a subscriber's readings of a batch
    come to one task as rows, so ``max_files`` bounds a task.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    log = reader.parquet(folder).where(F.col("terminal_status").isin(*USABLE)).select(*READ_COLUMNS)

    def work(rows: DataFrame, batch: int, stream: str) -> None:
        stored = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if stored.isEmpty():
                return
            read = _read_back(stored)
            increments = usage_from_previous(read.where("NOT late")).select(*USAGE_RESULT.names)
            late = read.where("late").select(*LATE.names)
            VersionedTables(rows.sparkSession, tables).publish(batch, append={"increments": increments, "late": late}, stream=stream)
        finally:
            stored.unpersist()

    provider = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return run_stream(with_last_reading(log, horizon_days, retain_days), checkpoint, work, mode="update")
    finally:
        spark.conf.unset(PROVIDER) if provider is None else spark.conf.set(PROVIDER, provider)
