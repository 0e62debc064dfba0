"""The usage rule and the session job for those who work in SQL.

Functions are SQL-language functions of the session: Spark puts their bodies into the plan, so there is no Python in it. Jobs are texts with named parameters; values are bound, never pasted into the text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from meterflow.plans.usage import ALLOWED_RATE

FUNCTIONS = {
    "is_not_anomaly": f"""
        (curr_clock BIGINT, curr_value BIGINT, prev_clock BIGINT, prev_value BIGINT, rate_per_min BIGINT DEFAULT {ALLOWED_RATE}) RETURNS BOOLEAN
        COMMENT 'whether a counter has grown no faster than the rate; false if anything is missing'
        RETURN coalesce(curr_value - prev_value <= rate_per_min * (curr_clock - prev_clock) / 60 AND prev_value >= 0 AND curr_value >= 0, false)""",
    "far_future": """
        (t TIMESTAMP_NTZ) RETURNS TIMESTAMP_NTZ
        COMMENT 'a missing time counts as the end of time'
        RETURN coalesce(t, timestamp_ntz'9999-12-31 00:00:00')""",
    "counter_delta": """
        (curr_value BIGINT, prev_value BIGINT) RETURNS BIGINT
        COMMENT 'growth of a counter; after a reset, or without a value before, the counter itself'
        RETURN if(prev_value <= curr_value, curr_value - prev_value, curr_value)""",
}

# The session job of an interval (:start_time, :end_time].
SESSION_STAGE_TEXT = """
WITH interval_rows AS (
  SELECT *, acctstarttime >= far_future(acctstoptime) AS backwards
  FROM {snapshots} WHERE etl_date > cast(:start_time AS timestamp_ntz) AND etl_date <= cast(:end_time AS timestamp_ntz)
),
repaired AS (
  SELECT *, backwards AND acctsessiontime > 0 AS fix_stop, backwards AND acctsessiontime = 0 AS fix_length FROM interval_rows
)
SELECT
  acctsessionid, acctuniqueid, concat_ws('', acctuniqueid, ';', username, ';', cast(acctstarttime AS string)) AS adj_acctuniqueid,
  username, groupname, realm, acctstarttime, acctupdatetime, acctstoptime,
  CASE WHEN fix_stop THEN timestampadd(SECOND, acctsessiontime, acctstarttime) ELSE acctstoptime END AS adj_acctstoptime,
  CASE WHEN fix_stop THEN 1 ELSE 0 END AS is_time_adjusted,
  acctinterval, acctsessiontime,
  CASE WHEN fix_length THEN cast(abs(timestampdiff(SECOND, acctstoptime, acctstarttime)) AS double) ELSE cast(acctsessiontime AS double) END AS adj_acctsessiontime,
  CASE WHEN fix_length THEN 1 ELSE 0 END AS is_sessiontime_adjusted,
  acctinputoctets, acctoutputoctets, calledstationid, acctstartdelay, acctstopdelay, extract_date,
  md5(concat_ws('', cast(far_future(acctstarttime) AS string), ';', coalesce(acctsessiontime, 0), ';', coalesce(acctinputoctets, 0), ';',
    coalesce(acctoutputoctets, 0), ';', username, ';', acctuniqueid)) AS stg_hashdiff
FROM repaired
"""


def register_functions(spark: SparkSession) -> None:
    """Make the functions known to the session, for ``spark.sql`` and ``expr`` alike."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")


def session_stage_text(snapshots: DataFrame, start_time: dt.datetime | str, end_time: dt.datetime | str) -> DataFrame:
    """The staged sessions of the snapshots of ``(start_time, end_time]``, from the SQL text. Times are bound as zone-free timestamps; anything else is an error."""
    spark = snapshots.sparkSession
    register_functions(spark)
    bounds = {name: dt.datetime.fromisoformat(str(value)) for name, value in (("start_time", start_time), ("end_time", end_time))}
    if any(b.tzinfo for b in bounds.values()):
        raise ValueError("times are zone-free")
    args = {name: value.isoformat(sep=" ") for name, value in bounds.items()}
    return spark.sql(SESSION_STAGE_TEXT, args=args, snapshots=snapshots)
