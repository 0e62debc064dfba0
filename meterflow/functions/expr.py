"""Column expressions shared by the jobs. All are plain built-in functions, no UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

FAR_FUTURE = "9999-12-31 23:59:59"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def far_future(col: Column) -> Column:
    """A missing time counts as later than every real one."""
    return F.coalesce(col.cast("timestamp_ntz"), ntz(FAR_FUTURE))


def any_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def is_not_anomaly(
    curr_clock: Column,
    curr_value: Column,
    prev_clock: Column,
    prev_value: Column,
    rate_per_min: int = 100,
) -> Column:
    """True when the counter rose by no more than the allowed rate; unknown counts as false."""
    allowed = F.lit(rate_per_min) * (curr_clock - prev_clock) / F.lit(60)
    within = (curr_value - prev_value) <= allowed
    return F.coalesce(within & (prev_value >= 0) & (curr_value >= 0), F.lit(False))


def counter_delta(current: Column, previous: Column) -> Column:
    """Growth of a counter; a counter that fell, or has no past, counts in full."""
    return F.when(current >= previous, current - previous).otherwise(current)


def concat_skip_null(*parts: Column) -> Column:
    """Text concatenation in which a missing part adds nothing."""
    return F.concat_ws("", *[p.cast("string") for p in parts])


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds from one zone-free time to the other, as double."""
    return (epoch_seconds(later) - epoch_seconds(earlier)).cast("double")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-free timestamp, whatever the session zone is."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def epoch_to_local(seconds: Column, tz: str) -> Column:
    """Wall-clock time in ``tz`` of an epoch second, independent of the session zone."""
    utc = add_seconds(ntz("1970-01-01 00:00:00"), seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def add_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def trunc_seconds(ts: Column, step: int) -> Column:
    """Zone-free time rounded down to a whole step of seconds."""
    seconds = (F.floor(epoch_seconds(ts) / step) * step).cast("bigint")
    return add_seconds(ntz("1970-01-01 00:00:00"), seconds)


def not_in_keep_null(col: Column, values: list[str]) -> Column:
    """``NOT IN`` that keeps rows without a value."""
    return ~F.coalesce(col.isin(*values), F.lit(False))


def in_interval(col: Column, start: Column, end: Column) -> Column:
    """Half-open interval, later bound included."""
    return (col > start) & (col <= end)


def duration_text(seconds: Column) -> Column:
    """``H:MM:SS``, led by ``1 day, `` or ``D days, `` from one day on (or below zero)."""
    days = F.floor(seconds / 86400)
    rest = F.pmod(seconds, F.lit(86400))
    clock = F.format_string(
        "%d:%02d:%02d",
        F.floor(rest / 3600),
        F.floor(F.pmod(rest, F.lit(3600)) / 60),
        F.pmod(rest, F.lit(60)),
    )
    unit = F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, "))
    return F.when(days == 0, clock).otherwise(F.concat(days.cast("string"), unit, clock))
