"""Explicit schemas of every table the jobs read or keep."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, STR, DBL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
TS = T.TimestampNTZType()


def _schema(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec.items()])


# One meter record, as stored after ingest.
METER_RECORD = _schema({
    "subscriber_number": STR,
    "clock": STR,
    "ns": STR,
    "end_date": TS,
    "capacity_anytime": LONG,
    "capacity_offpeak": LONG,
    "overall_usage_anytime": LONG,
    "overall_usage_offpeak": LONG,
    "overall_available_tokens": LONG,
    "fap_status": STR,
    "terminal_status": STR,
    "in_peak_period": STR,
    "esn": STR,
    "service_plan": STR,
    "udr_file_name": STR,
    "created_by": STR,
})

# Lines that could not become records.
QUARANTINE = _schema({"udr_file_name": STR, "reason": STR, "line": STR})

# What became of a meter file.
FILE_STATUS = _schema({
    "udr_file_name": STR,
    "n_lines": LONG,
    "n_records": LONG,
    "n_bad_json": LONG,
    "n_bad_field": LONG,
    "file_ok": T.BooleanType(),
})

# What a batch of meter files came to.
RUN_COUNTS = _schema({"stream": STR, "batch": LONG, "n_lines": LONG, "n_records": LONG, "n_bad_json": LONG, "n_bad_field": LONG, "n_new": LONG})

# The columns of the meter log that usage calculation needs or sets.
METER_LOG = _schema({
    "id": LONG,
    "subscriber_number": STR,
    "end_date": TS,
    "clock": LONG,
    "terminal_status": STR,
    "overall_usage_anytime": LONG,
    "overall_usage_offpeak": LONG,
    "overall_available_tokens": LONG,
    "usage_anytime": LONG,
    "usage_offpeak": LONG,
    "usage_available_tokens": LONG,
    "summary_flag": INT,
    "date_modified": TS,
    "modified_by": STR,
})

# Last counters seen per subscriber and poll time.
COUNTER_STATE = _schema({
    "id": LONG,
    "subscriber_number": STR,
    "end_date": TS,
    "clock": LONG,
    "overall_usage_anytime": LONG,
    "overall_usage_offpeak": LONG,
    "overall_available_tokens": LONG,
    "load_time": TS,
})

# Usage of one poll.
USAGE_RESULT = _schema({
    "id": LONG,
    "end_date": TS,
    "v_usage_anytime": LONG,
    "v_usage_offpeak": LONG,
    "v_usage_available_tokens": LONG,
    "summary_flag": INT,
})

# One open or closed session in an accounting snapshot.
SESSION_STAGE = _schema({
    "acctsessionid": STR,
    "acctuniqueid": STR,
    "username": STR,
    "groupname": STR,
    "realm": STR,
    "acctstarttime": TS,
    "acctupdatetime": TS,
    "acctstoptime": TS,
    "acctinterval": LONG,
    "acctsessiontime": LONG,
    "acctinputoctets": LONG,
    "acctoutputoctets": LONG,
    "calledstationid": STR,
    "acctstartdelay": LONG,
    "acctstopdelay": LONG,
    "extract_date": TS,
    "etl_date": TS,
})

# Snapshots as they are kept: laid out by the day of their interval.
ETL_DAY = "etl_day"
SNAPSHOT = T.StructType([*SESSION_STAGE.fields, T.StructField(ETL_DAY, T.DateType())])

# Every version of every session seen so far.
SESSION_HISTORY = _schema({
    "acctsessionid": STR,
    "acctuniqueid": STR,
    "adj_acctuniqueid": STR,
    "username": STR,
    "groupname": STR,
    "realm": STR,
    "acctstarttime": TS,
    "prev_acctstarttime": TS,
    "acctstoptime": TS,
    "adj_acctstoptime": TS,
    "prev_adj_acctstoptime": TS,
    "is_time_adjusted": INT,
    "acctupdatetime": TS,
    "acctsessiontime": LONG,
    "adj_acctsessiontime": DBL,
    "is_sessiontime_adjusted": INT,
    "acctinputoctets": LONG,
    "acctoutputoctets": LONG,
    "calledstationid": STR,
    "hashdiff": STR,
    "prev_acctinputoctets": LONG,
    "prev_acctoutputoctets": LONG,
    "extract_date": TS,
    "diff_acctinputoctets": LONG,
    "diff_acctoutputoctets": LONG,
})

# The columns handed to the analysis database.
SESSION_ANALYSIS_COLUMNS = (
    "acctsessionid",
    "acctuniqueid",
    "adj_acctuniqueid",
    "username",
    "realm",
    "acctstarttime",
    "acctinputoctets",
    "acctoutputoctets",
    "diff_acctinputoctets",
    "diff_acctoutputoctets",
    "extract_date",
)

# The columns taken from the closed-session log, in table order.
SESSION_LOG_COLUMNS = (
    "radacctid", "acctsessionid", "acctuniqueid", "username", "groupname", "realm",
    "nasipaddress", "nasidentifier", "nasportid", "nasporttype", "acctstarttime",
    "acctupdatetime", "acctstoptime", "acctinterval", "acctsessiontime", "acctauthentic",
    "connectinfo_start", "connectinfo_stop", "acctinputoctets", "acctoutputoctets",
    "calledstationid", "callingstationid", "acctterminatecause", "servicetype",
    "framedprotocol", "framedipaddress", "acctstartdelay", "acctstopdelay",
    "xascendsessionsvrkey", "operator_name", "created_date", "flag",
)

# One row of a database process list.
PROCESS_SNAPSHOT = _schema({
    "server": STR,
    "snapshot_ts": TS,
    "id": LONG,
    "user": STR,
    "host": STR,
    "db": STR,
    "command": STR,
    "time": LONG,
    "state": STR,
    "query_id": LONG,
    "progress": DBL,
})

# Alert rule: on hosts whose label ends in host_suffix, watch mount from min_pct on.
DISK_RULES = _schema({"host_suffix": STR, "mount": STR, "min_pct": INT})
