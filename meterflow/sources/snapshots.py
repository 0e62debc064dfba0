"""Extracts from session-accounting tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.expr import in_interval, ntz
from meterflow.schemas import ETL_DAY, SESSION_LOG_COLUMNS

Time = dt.datetime | str


def stamp_snapshot(table: DataFrame, extract_date: Time, etl_date: Time) -> DataFrame:
    """A full snapshot, stamped with when it was taken and the end of its interval."""
    return table.withColumns({"extract_date": ntz(str(extract_date)), "etl_date": ntz(str(etl_date))})


def log_delta(log: DataFrame, start: Time, end: Time) -> DataFrame:
    """Closed sessions written in ``(start, end]``; the range reaches the scan."""
    inside = in_interval(F.col("created_date"), ntz(str(start)), ntz(str(end)))
    return log.where(inside).select(*SESSION_LOG_COLUMNS, ntz(str(end)).alias("etl_date"))


def with_etl_day(snapshots: DataFrame) -> DataFrame:
    """Snapshots with the day that they are laid out by."""
    return snapshots.withColumn(ETL_DAY, F.to_date("etl_date"))


def snapshot_window(snapshots: DataFrame, start: Time, end: Time) -> DataFrame:
    """Snapshots of the intervals that ended in ``(start, end]``. Where these are laid out by day, other days are not read."""
    inside = in_interval(F.col("etl_date"), ntz(str(start)), ntz(str(end)))
    if ETL_DAY in snapshots.columns:
        inside = inside & F.col(ETL_DAY).between(F.lit(str(start)[:10]).cast("date"), F.lit(str(end)[:10]).cast("date"))
    return snapshots.where(inside)
