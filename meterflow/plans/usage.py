"""Usage per poll from cumulative counters, with state carried between batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.functions.expr import is_not_anomaly, ntz, trunc_seconds
from meterflow.operators.changes import flag_reset, retain, rewind, upsert
from meterflow.operators.skew import KeyChunks, lag_by_key, latest_by, plan_chunks
from meterflow.schemas import COUNTER_STATE, METER_LOG, USAGE_RESULT
from meterflow.sources.meter_files import USABLE

ALLOWED_RATE = 100
HORIZON_DAYS = 31
RETAIN_DAYS = 40
STATE_KEYS = ["subscriber_number", "end_date"]
COUNTERS = ("overall_usage_anytime", "overall_usage_offpeak", "overall_available_tokens")
# state and log are laid out by the day of the poll
DAY = "end_day"
STATE_BY_DAY = T.StructType([*COUNTER_STATE.fields, T.StructField(DAY, T.DateType())])
LOG_BY_DAY = T.StructType([*METER_LOG.fields, T.StructField(DAY, T.DateType())])
READ_COLUMNS = ("id", "clock", "subscriber_number", *COUNTERS, "end_date", "terminal_status")
LAGS = {
    "lag_clock": "clock",
    "lag_usage_anytime": "overall_usage_anytime",
    "lag_usage_offpeak": "overall_usage_offpeak",
    "lag_available_tokens": "overall_available_tokens",
}


def with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DAY, F.to_date("end_date"))


# --- reading ---------------------------------------------------------------------------


def _is_pending(as_of: dt.datetime, days: int, statuses: tuple[str, ...]) -> Column:
    since = (as_of - dt.timedelta(days=days)).date()
    return (
        (F.col("end_date") >= ntz(f"{since} 00:00:00"))
        & F.col("terminal_status").isin(*statuses)
        & (F.col("summary_flag") == 0)
    )


def oldest(df: DataFrame, cap: int) -> DataFrame:
    """The ``cap`` oldest rows; rows without ``end_date`` come last.

    An hourly histogram (a few hundred rows for the reading horizon) gives the hour in
    which the cap is reached. The final top-k then sees little more than ``cap`` rows,
    instead of up to ``cap`` rows from every one of thousands of scan tasks.
    """
    hour = trunc_seconds(F.col("end_date"), 3600).alias("hour")
    hours = df.where("end_date IS NOT NULL").groupBy(hour).agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.orderBy("hour"))
    reached = hours.withColumn("so_far", so_far).where(F.col("so_far") >= cap)
    until = reached.agg((F.min("hour") + F.expr("INTERVAL '1' HOUR")).alias("until")).first()["until"]
    near = df if until is None else df.where(F.col("end_date") < ntz(str(until)))
    return near.orderBy(F.asc_nulls_last("end_date"), F.asc_nulls_last("id")).limit(cap)


def read_unsummarised(
    log: DataFrame,
    as_of: dt.datetime,
    days: int = HORIZON_DAYS,
    cap: int | None = None,
    statuses: tuple[str, ...] = USABLE,
) -> DataFrame:
    """Pending usable rows of the last days; with ``cap`` so many of the oldest."""
    rows = log.where(_is_pending(as_of, days, statuses)).select(*READ_COLUMNS)
    return rows if cap is None else oldest(rows, cap)


def period(batch: DataFrame, state: DataFrame) -> DataFrame:
    """First and last poll time of the batch and of the state, as one row."""
    ends = [F.min("end_date").alias("first_end"), F.max("end_date").alias("last_end")]
    both = batch.select("end_date", F.lit("batch").alias("part")).unionByName(
        state.select("end_date", F.lit("state").alias("part"))
    )
    return both.groupBy("part").agg(*ends)


def latest_state(state: DataFrame) -> DataFrame:
    """The newest state row of every subscriber."""
    newest = [F.desc_nulls_last("end_date"), F.desc_nulls_last("load_time"), F.desc_nulls_last("id")]
    return latest_by(state, ["subscriber_number"], *newest)


# --- increments ------------------------------------------------------------------------


def plan_batch(batch: DataFrame, statuses: tuple[str, ...] = USABLE) -> KeyChunks:
    usable = batch.where(F.col("terminal_status").isin(*statuses))
    return plan_chunks(usable, ["subscriber_number"], ["end_date", "id"])


def with_lags(batch: DataFrame, plan: KeyChunks | None = None) -> DataFrame:
    """Each row with the clock and counters of the subscriber's poll before it."""
    return lag_by_key(batch, plan or plan_batch(batch), LAGS)


def with_previous(
    batch: DataFrame,
    state: DataFrame,
    statuses: tuple[str, ...] = USABLE,
    plan: KeyChunks | None = None,
) -> DataFrame:
    """Each usable row with the reading before it: from the batch, else from the state.

    Every counter falls back on its own, so a poll that lacks one counter leaves the
    previous value of that counter to the state. Lag and join share one partitioning.
    """
    usable = batch.where(F.col("terminal_status").isin(*statuses))
    plan = plan or plan_batch(batch, statuses)
    rows = with_lags(usable, plan)
    before = latest_state(state).select(
        "subscriber_number",
        F.col("clock").alias("st_clock"),
        *[F.col(c).alias(f"st_{c}") for c in COUNTERS],
    )
    joined = rows.join(plan.spread(before), list(plan.window_keys), "left")
    zero = F.lit(0).cast("bigint")
    return joined.withColumns({
        "prev_clock": F.coalesce("lag_clock", "st_clock"),
        "prev_usage": F.coalesce("lag_usage_anytime", "st_overall_usage_anytime", zero),
        "prev_offpeak": F.coalesce("lag_usage_offpeak", "st_overall_usage_offpeak", zero),
        "prev_tokens": F.coalesce("lag_available_tokens", "st_overall_available_tokens", zero),
    })


def anomaly_flags(rate_per_min: int = ALLOWED_RATE) -> dict[str, Column]:
    """Whether each counter's step is within the rate. Tokens are used up, so they run backwards."""
    clock, prev = F.col("clock"), F.col("prev_clock")

    def check(now: str, then: str) -> Column:
        return is_not_anomaly(clock, F.col(now), prev, F.col(then), rate_per_min)

    return {
        "is_not_anomaly_usage": check("overall_usage_anytime", "prev_usage"),
        "is_not_anomaly_offpeak": check("overall_usage_offpeak", "prev_offpeak"),
        "is_not_anomaly_token": check("prev_tokens", "overall_available_tokens"),
    }


def _usage_columns(rate_per_min: int, statuses: tuple[str, ...]) -> dict[str, Column]:
    anytime, offpeak, tokens = (F.col(c) for c in COUNTERS)
    ok = anomaly_flags(rate_per_min)
    first = F.col("prev_clock").isNull()
    zero = F.lit(0).cast("bigint")

    def grown(now: Column, then: Column, within: Column) -> Column:
        # a reset and a jump both count as nothing
        return F.when(first, now).when((now >= then) & within, now - then).otherwise(zero)

    prev_tokens = F.col("prev_tokens")
    reset = (anytime < F.col("prev_usage")) & (offpeak < F.col("prev_offpeak")) & (tokens < prev_tokens)
    spent = (tokens < prev_tokens) & (tokens != 0) & ok["is_not_anomaly_token"]
    used_tokens = F.when(first | reset, zero).when(spent, prev_tokens - tokens).otherwise(zero)

    valid = (
        F.col("subscriber_number").isNotNull()
        & F.coalesce(*COUNTERS).isNotNull()
        & F.lower("terminal_status").isin(*statuses)
    )
    return {
        "v_usage_anytime": F.when(
            valid, grown(anytime, F.col("prev_usage"), ok["is_not_anomaly_usage"])
        ),
        "v_usage_offpeak": F.when(
            valid, grown(offpeak, F.col("prev_offpeak"), ok["is_not_anomaly_offpeak"])
        ),
        "v_usage_available_tokens": F.when(valid, used_tokens),
        "summary_flag": F.when(valid, 1).otherwise(-1),
    }


def usage_increments(
    batch: DataFrame,
    state: DataFrame,
    rate_per_min: int = ALLOWED_RATE,
    statuses: tuple[str, ...] = USABLE,
    plan: KeyChunks | None = None,
) -> DataFrame:
    """Usage since the previous poll for every usable row."""
    rows = with_previous(batch.select(*READ_COLUMNS), state, statuses, plan)
    return usage_from_previous(rows, rate_per_min, statuses).select(*USAGE_RESULT.names)


def usage_from_previous(rows: DataFrame, rate_per_min: int = ALLOWED_RATE, statuses: tuple[str, ...] = USABLE) -> DataFrame:
    """Usage of readings that have the reading before them beside them (``prev_*``)."""
    return rows.withColumns(_usage_columns(rate_per_min, statuses))


def rejects(batch: DataFrame, statuses: tuple[str, ...] = USABLE) -> DataFrame:
    """Rows of any other status: no usage, flag -1."""
    none = F.lit(None).cast("bigint")
    return batch.where(~F.col("terminal_status").isin(*statuses)).select(
        "id",
        "end_date",
        none.alias("v_usage_anytime"),
        none.alias("v_usage_offpeak"),
        none.alias("v_usage_available_tokens"),
        F.lit(-1).alias("summary_flag"),
    )


def increments_with_rejects(batch: DataFrame, state: DataFrame, **options) -> DataFrame:
    return usage_increments(batch, state, **options).unionByName(rejects(batch))


# --- one run ---------------------------------------------------------------------------


def calculated_rows(
    batch: DataFrame,
    state: DataFrame,
    as_of: dt.datetime,
    rate_per_min: int = ALLOWED_RATE,
    statuses: tuple[str, ...] = USABLE,
    modified_by: str = "meterflow",
    plan: KeyChunks | None = None,
) -> DataFrame:
    """Pending log rows with their usage filled in.

    The rows travel through the calculation whole, so writing the result back needs no
    join of the updates with the log.
    """
    rows = with_previous(batch, state, statuses, plan)
    rows = usage_from_previous(rows, rate_per_min, statuses)
    filled = {
        "usage_anytime": F.col("v_usage_anytime"),
        "usage_offpeak": F.col("v_usage_offpeak"),
        "usage_available_tokens": F.col("v_usage_available_tokens"),
        "date_modified": ntz(str(as_of)),
        "modified_by": F.lit(modified_by),
    }
    return rows.withColumns(filled).select(*batch.columns)


def next_state(state: DataFrame, batch: DataFrame, as_of: dt.datetime) -> DataFrame:
    """State after a batch; it takes every row of the batch, anomalies too."""
    return upsert(state, batch, STATE_KEYS, as_of, tie_break=["id"])


def summarise_batch(
    log: DataFrame,
    state: DataFrame,
    as_of: dt.datetime,
    days: int = HORIZON_DAYS,
    cap: int | None = None,
    statuses: tuple[str, ...] = USABLE,
    plan: KeyChunks | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Calculate the pending rows of the log. Returns the new log and the new state.

    With ``cap`` the oldest so many pending rows are calculated, and all rows that tie with the last of
    them in time and id; the others wait. No row is in both parts or in none.
    """
    pending = F.coalesce(_is_pending(as_of, days, statuses), F.lit(False))
    batch, kept = log.where(pending), log.where(~pending)
    if cap is not None:
        waiting = batch
        place = F.struct("end_date", "id")
        last = oldest(waiting, cap).agg(F.max(place)).scalar()
        taken = F.coalesce(place <= last, F.lit(False))
        batch = waiting.where(taken)
        kept = kept.unionByName(waiting.where(~taken))
    done = calculated_rows(batch, state, as_of, statuses=statuses, plan=plan, **options)
    return kept.unionByName(done), next_state(state, batch, as_of)


def reset_and_replay(
    log: DataFrame,
    state: DataFrame,
    reset_day: dt.date,
    retain_days: int = RETAIN_DAYS,
    as_of: dt.datetime | None = None,
    statuses: tuple[str, ...] = USABLE,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Calculate everything since ``reset_day`` again, so that late rows find their place."""
    since = ntz(f"{reset_day} 00:00:00")
    as_of = as_of or dt.datetime.combine(reset_day, dt.time()) + dt.timedelta(days=1)
    reset_log = flag_reset(log, since, statuses)
    kept_state = rewind(retain(state, since, retain_days), since)
    return summarise_batch(reset_log, kept_state, as_of, statuses=statuses, **options)
