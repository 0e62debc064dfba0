"""Late readings: recalculate those that a late one touches, instead of replaying all days.

A late reading changes two results: its own, against the reading before it, and that of the reading behind it, whose predecessor it now is. Both neighbours are looked up in
the days around it, in the log laid out by day: first the late reading's own day, then twice as far to both sides, until each has found both neighbours or the
log ends. The driver sees days only, never readings.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.expr import ntz
from meterflow.operators.changes import keyed_update
from meterflow.plans.usage import DAY, READ_COLUMNS, usage_from_previous, with_previous
from meterflow.sources.meter_files import USABLE
from meterflow.sources.versions import VersionedTables

USAGE_COLUMNS = {"usage_anytime": "v_usage_anytime", "usage_offpeak": "v_usage_offpeak", "usage_available_tokens": "v_usage_available_tokens", "summary_flag": "summary_flag"}


@dataclass
class Repair:
    """``rows``: touched readings with their usage as in the log; ``days``: the days they lie in; ``read``: all days that were looked at."""

    rows: DataFrame
    days: list[dt.date]
    read: list[dt.date]


def _in_days(log: DataFrame, days: set[dt.date]) -> DataFrame:
    """The rows of some days: a list of constants, so that other days are not read."""
    return log.where(F.col(DAY).isin(sorted(days)))


def _days_around(days: set[dt.date], radius: int, known: list[dt.date]) -> set[dt.date]:
    """The days, and of those that the log has so many to both sides of each."""
    places = {known.index(d) + k for d in days for k in range(-radius, radius + 1)}
    return {known[k] for k in places if 0 <= k < len(known)}


def _stretch(read: set[dt.date], known: list[dt.date]) -> Column:
    """A number for each day: the same for days between which no day of the log is left out."""
    numbers, n = [], 0
    for day in known:
        n += day not in read
        numbers += [F.lit(day), F.lit(n)]
    return F.element_at(F.create_map(*numbers), F.col(DAY))


def find_touched(log: DataFrame, days: list[dt.date], since: dt.date, statuses: tuple[str, ...] = USABLE) -> tuple[DataFrame, set[dt.date]]:
    """Usable readings around the late ones (those still to be calculated), each with ``touched``, and the days that were read.

    ``days`` are those that the log has. Late readings without a number or time touch no other reading.
    """
    known = sorted({d for d in days if d >= since})
    usable = log.where(F.col("terminal_status").isin(*statuses))
    late_days = {r[0] for r in _in_days(usable, set(known)).where("summary_flag = 0").select(DAY).distinct().collect()}
    by = Window.partitionBy("subscriber_number").orderBy(F.asc_nulls_last("end_date"), F.asc_nulls_last("id"))
    read, radius = late_days, 0
    while True:
        near = _in_days(usable, read)
        late = near.where("summary_flag = 0")
        # one row for each subscriber with late readings
        who = late.where("subscriber_number IS NOT NULL").select("subscriber_number").distinct()
        around = near.join(who, "subscriber_number", "left_semi").select(*READ_COLUMNS, "summary_flag", DAY)
        if len(read) in (0, len(known)):
            break
        # a neighbour counts where all days up to it were read; none is needed beyond the ends of the log
        placed = around.withColumn("stretch", _stretch(read, known))
        other = F.when(F.col("summary_flag") != 0, F.col("stretch"))
        before = F.coalesce(F.max(other).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        behind = F.coalesce(F.min(other).over(by.rowsBetween(1, Window.unboundedFollowing)), F.lit(len(known) - len(read)))
        lacking = placed.select(DAY, "summary_flag", "stretch", before.alias("before"), behind.alias("behind"))
        lacking = lacking.where("summary_flag = 0 AND (before < stretch OR behind > stretch)")
        open_ = {r[0] for r in lacking.select(DAY).distinct().collect()}
        if not open_:
            break
        radius = max(1, 2 * radius)
        read = read | _days_around(open_, radius, known)
    touched = (F.col("summary_flag") == 0) | F.coalesce(F.lag("summary_flag").over(by) == 0, F.lit(False))
    nobody = late.where("subscriber_number IS NULL").select(*READ_COLUMNS, "summary_flag", DAY, F.lit(True).alias("touched"))
    return around.withColumn("touched", touched).unionByName(nobody), read


def repair_late(
    log: DataFrame, state: DataFrame, days: list[dt.date], since: dt.date, as_of: dt.datetime, statuses: tuple[str, ...] = USABLE, modified_by: str = "meterflow", **options
) -> Repair:
    """What late readings change in a log that is calculated from ``since`` on (laid out by ``DAY``), against the state before that day.

    The usage columns and flags are those that replaying everything from ``since`` on gives.
    """
    near, read = find_touched(log, days, since, statuses)
    kept = state.where(F.col("end_date") < ntz(f"{since} 00:00:00"))
    marked = with_previous(near, kept, statuses).where("touched")
    done = usage_from_previous(marked, statuses=statuses, **options)
    rows = done.select("id", "end_date", DAY, *[F.col(v).alias(c) for c, v in USAGE_COLUMNS.items()], ntz(str(as_of)).alias("date_modified"), F.lit(modified_by).alias("modified_by"))
    found = sorted(r[0] for r in rows.select(DAY).distinct().collect())
    return Repair(rows, found, sorted(read))


def apply_repair(store: VersionedTables, table: str, repair: Repair, schema) -> int:
    """Write the touched days of a log anew; all other parts of the table stay as they are. Returns how many parts were rewritten."""
    days = {f"{DAY}={d}" for d in repair.days}
    parts = [p for p in store.state().parts.get(table, []) if p.rpartition("/")[2] in days]
    if not parts:
        return 0
    rows = _in_days(store.read(table, schema), set(repair.days))
    new = keyed_update(rows, repair.rows.drop(DAY), ["id", "end_date"], [*USAGE_COLUMNS, "date_modified", "modified_by"])
    store.rewrite(table, parts, new.repartition(DAY), DAY)
    return len(parts)


def days_of(store: VersionedTables, table: str) -> list[dt.date]:
    """The days that a table laid out by ``DAY`` has, from the names of its parts."""
    names = {p.rpartition(f"{DAY}=")[2] for p in store.state().parts.get(table, [])}
    return sorted(dt.date.fromisoformat(n) for n in names if n[:1].isdigit())
