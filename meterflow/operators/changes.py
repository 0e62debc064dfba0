"""Table changes as pure DataFrame operators: each returns the new table contents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.expr import any_null, ntz
from meterflow.operators.skew import latest_by


def _keyless(keys: list[str]) -> Column:
    """A row with a missing key part conflicts with nothing."""
    return any_null([F.col(k) for k in keys])


def insertable(target: DataFrame, rows: DataFrame, keys: list[str], tie_break: list[str]) -> DataFrame:
    """The rows that an insert ignoring conflicts would add: what an appending sink writes."""
    with_key = rows.where(~_keyless(keys))
    first = latest_by(with_key, keys, *[F.asc_nulls_last(c) for c in tie_break])
    return first.join(target.select(*keys), keys, "left_anti").select(*rows.columns).unionByName(
        rows.where(_keyless(keys))
    )


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str], tie_break: list[str]) -> DataFrame:
    """Insert rows; one whose key is present already, or comes twice, is ignored."""
    return target.unionByName(insertable(target, rows, keys, tie_break))


def keyed_update(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    set_cols: list[str],
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Set columns of the target rows whose key is in ``updates``; a null overwrites."""
    order = [F.desc_nulls_last(c) for c in (tie_break or set_cols)]
    one = latest_by(updates.where(~_keyless(keys)), keys, *order)
    new = one.select(*keys, F.struct(*set_cols).alias("_set"))
    joined = target.join(new, keys, "left")
    out = [
        F.when(F.col("_set").isNotNull(), F.col("_set")[c]).otherwise(F.col(c)).alias(c)
        if c in set_cols
        else F.col(c)
        for c in target.columns
    ]
    return joined.select(*out)


def upsert(
    target: DataFrame,
    rows: DataFrame,
    keys: list[str],
    as_of: dt.datetime | str,
    tie_break: list[str],
    stamp: str = "load_time",
) -> DataFrame:
    """Insert rows or replace those of the same key; of several the highest tie-break wins."""
    incoming = rows.withColumn(stamp, ntz(str(as_of))).select(*target.columns)
    one = latest_by(incoming.where(~_keyless(keys)), keys, *[F.desc_nulls_last(c) for c in tie_break])
    # a missing key part never matches, so such rows of the target stay
    untouched = target.join(one.select(*keys), keys, "left_anti").select(*target.columns)
    return untouched.unionByName(one.select(*target.columns)).unionByName(incoming.where(_keyless(keys)))


def flag_reset(log: DataFrame, since: Column, statuses: tuple[str, ...]) -> DataFrame:
    """Mark usable rows from ``since`` on as pending again."""
    again = (
        (F.col("end_date") >= since)
        & (F.col("summary_flag") != 0)
        & F.col("terminal_status").isin(*statuses)
    )
    flag = F.when(again, F.lit(0)).otherwise(F.col("summary_flag"))
    return log.withColumn("summary_flag", flag.cast("int"))


def retain(state: DataFrame, reset_time: Column, days: int = 40) -> DataFrame:
    """Drop state older than the retention time."""
    keep_from = reset_time - F.make_dt_interval(days=F.lit(days))
    return state.where(F.col("end_date") > keep_from)


def rewind(state: DataFrame, reset_time: Column) -> DataFrame:
    """Forget state from the reset time on."""
    return state.where(F.col("end_date") < reset_time)


def move_flagged(
    records: DataFrame, log: DataFrame, flag: int = 2, state_col: str = "state"
) -> tuple[DataFrame, DataFrame]:
    """Rows in the given state go to the log; every other row, also one without state, stays."""
    moved = F.col(state_col).eqNullSafe(F.lit(flag))
    remaining = records.where(~moved)
    return remaining, log.unionByName(records.where(moved), allowMissingColumns=True)
