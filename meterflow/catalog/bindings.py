"""The driver's tables seen as the tables of the jobs.

All of it is row-by-row arithmetic on integers, text and zone-free times: no window and no
shuffle, so a filter on a bound table still reaches the parquet scan, and the same
arithmetic can be written in any SQL dialect (see ``oracle``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from meterflow.plans.sessions import session_stage
from meterflow.schemas import COUNTER_STATE, DISK_RULES, SESSION_HISTORY, SESSION_LOG_COLUMNS
from meterflow.session import small_table

TZ = "Asia/Jakarta"
CUT = "2024-01-16 00:00:00"
AS_OF = dt.datetime(2024, 1, 31)
LOAD_TIME = "2024-01-16 00:00:00"

# host suffix, mount, limit: a rule for every host, a mount of one host, a raised limit
RULES = [("", "/", 80), ("0.3", "/data", 80), ("0.2", "/", 90), ("0.2", "/backup", 90)]

_CLOCK = (
    "datediff(cast(ts AS date), date'1970-01-01') * 86400L"
    " + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
)


def _ntz(text: str) -> str:
    return f"timestamp_ntz'{text}'"


def _steps(seconds: int) -> str:
    """Time rounded down to a whole step."""
    whole = f"(clock div {seconds}) * {seconds}"
    return f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast({whole} AS decimal(18,6)))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- meter log from events ---------------------------------------------------------------


def usage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter log: counters that climb at a rate per user, wrap around, and now and then misbehave."""
    timed = table(spark, sf_dir, "events").selectExpr(
        "*", f"{_CLOCK} AS clock", "cast(floor(value) AS bigint) AS jitter"
    )
    counters = timed.selectExpr(
        "*",
        "((clock - 1704067200) * (user_id % 13 * 12) div 60 + user_id * 977 + jitter) % 400000 AS anytime",
        "((clock - 1704067200) * (user_id % 7 * 10) div 60 + jitter) % 250000 AS offpeak",
        "1000000 - ((clock - 1704067200) * (user_id % 11 * 11) div 60) % 1000000 AS tokens",
    )
    return counters.selectExpr(
        "event_id AS id",
        # a fifth of the users has another number from the cut on: subscribers without earlier readings
        "CASE WHEN event_id % 107 <> 0 THEN cast(user_id + CASE WHEN user_id % 5 = 0 AND ts >="
        f" {_ntz(CUT)} THEN 1000000000 ELSE 0 END AS string) END AS subscriber_number",
        "ts AS end_date",
        "clock",
        "CASE WHEN event_type IN ('view', 'purchase') THEN 'normal' WHEN event_type = 'click' THEN 'minor'"
        " WHEN event_type = 'signup' THEN 'suspended' ELSE 'critical' END AS terminal_status",
        "CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 97 = 0 THEN jitter % 50"
        " ELSE anytime END AS overall_usage_anytime",
        "CASE WHEN event_id % 103 = 0 OR event_id % 101 = 0 THEN NULL WHEN event_id % 97 = 0"
        " THEN jitter % 30 ELSE offpeak END AS overall_usage_offpeak",
        "CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 0 WHEN event_id % 97 = 0"
        " THEN jitter % 20 ELSE tokens END AS overall_available_tokens",
    )


def usage_state(spark: SparkSession, sf_dir: str, until: str | None = CUT) -> DataFrame:
    """Usable readings before the batch, or all of them."""
    log = usage_log(spark, sf_dir).where("terminal_status IN ('normal', 'minor')")
    if until is not None:
        log = log.where(f"end_date < {_ntz(until)}")
    return log.selectExpr("*", f"{_ntz(LOAD_TIME)} AS load_time").select(*COUNTER_STATE.names)


def usage_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage_log(spark, sf_dir).where(f"end_date >= {_ntz(CUT)}")


def full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with its usage columns: calculated before the cut, pending after it."""
    done = f"end_date < {_ntz(CUT)}"
    return usage_log(spark, sf_dir).selectExpr(
        "*",
        f"CASE WHEN {done} THEN id % 40 END AS usage_anytime",
        f"CASE WHEN {done} THEN id % 30 END AS usage_offpeak",
        f"CASE WHEN {done} THEN id % 20 END AS usage_available_tokens",
        f"CASE WHEN NOT ({done}) THEN 0 WHEN terminal_status IN ('normal', 'minor') THEN 1"
        " ELSE -1 END AS summary_flag",
        f"CASE WHEN {done} THEN {_ntz(LOAD_TIME)} END AS date_modified",
        f"CASE WHEN {done} THEN 'earlier' END AS modified_by",
    )


def meter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of the log in mixed case: some cut short, some lacking a key, some odd."""
    # to_json leaves out keys without a value
    json = """to_json(named_struct(
        'DeviceId', concat('DEV', coalesce(subscriber_number, 'X')),
        'lastPolledTime', CASE WHEN id % 41 = 0 THEN clock ELSE clock * 1000 + id % 1000 END,
        'overallCapacity', id % 4,
        'overallUsage', coalesce(overall_usage_anytime, 0),
        'offPeakOverallCapacity', id % 3,
        'offPeakOverallUsage', coalesce(overall_usage_offpeak, 0),
        'availTokens', CASE WHEN id % 33 <> 0 THEN coalesce(overall_available_tokens, 0) END,
        'fapStatus', 'OK',
        'terminalStatus', CASE WHEN id % 29 = 0 THEN 'Offline' ELSE initcap(terminal_status) END,
        'inPeakPeriod', CASE WHEN id % 2 = 0 THEN 'True' ELSE 'False' END,
        'esn', CASE WHEN id % 3 <> 0 THEN concat('E', id) END,
        'servicePlan', CASE WHEN id % 5 <> 0 THEN 'Plan A' END
    ))"""
    lines = usage_log(spark, sf_dir).selectExpr("id", "end_date", f"{json} AS json")
    return lines.selectExpr(
        "CASE WHEN id % 50 = 0 THEN substring(json, 1, 40) ELSE json END AS value",
        "concat('nms_', date_format(end_date, 'yyyyMMddHH'), '00.udr') AS udr_file_name",
    )


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder listing: one meter file per hour with polls, and files of other kinds beside it."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('/in/nms_', date_format(ts, 'yyyyMMddHH'), '00', CASE WHEN event_id % 7 = 0 THEN '.tmp'"
        " WHEN event_id % 11 = 0 THEN '.udr.gz' ELSE '.udr' END) AS path"
    ).distinct()


# --- sessions from orders ----------------------------------------------------------------


def _snapshot(spark: SparkSession, sf_dir: str, extract: str, plus: str, keep: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(keep).selectExpr(
        "*",
        f"cast({plus} AS bigint) AS plus",
        "CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE o_orderkey % 7200 END AS length",
    )
    return orders.selectExpr(
        "concat('s', o_orderkey) AS acctsessionid",
        "cast(o_orderkey AS string) AS acctuniqueid",
        "CASE WHEN o_orderkey % 211 <> 0 THEN cast(o_custkey AS string) END AS username",
        "o_orderpriority AS groupname",
        "o_orderstatus AS realm",
        "o_orderdate AS acctstarttime",
        "o_orderdate AS acctupdatetime",
        "CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN o_orderdate - INTERVAL '1' HOUR"
        " ELSE o_orderdate + make_dt_interval(0, 0, 0, cast(length AS decimal(18,6))) END AS acctstoptime",
        "600L AS acctinterval",
        "length AS acctsessiontime",
        "cast(floor(o_totalprice) AS bigint) + plus AS acctinputoctets",
        "cast(floor(o_totalprice / 2) AS bigint) + plus div 2 AS acctoutputoctets",
        "'ap' AS calledstationid",
        "0L AS acctstartdelay",
        "0L AS acctstopdelay",
        f"{_ntz(extract)} AS extract_date",
        f"{_ntz(extract)} AS etl_date",
    )


def session_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every session at 02:00: some as before, some grown, some reset, some new."""
    plus = (
        "CASE WHEN o_orderkey % 10 IN (2, 3) THEN 1000 WHEN o_orderkey % 10 = 4 THEN -500"
        " WHEN o_orderkey % 10 = 6 THEN 900 ELSE 0 END"
    )
    return _snapshot(spark, sf_dir, "2024-01-01 02:00:00", plus, "true")


def first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir, "2024-01-01 00:00:00", "0", "o_orderkey % 10 < 7")


def session_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven tenths of the sessions at 00:00, two of these again at 01:00 with more octets."""
    again = _snapshot(spark, sf_dir, "2024-01-01 01:00:00", "500", "o_orderkey % 10 IN (5, 6)")
    both = session_stage(first_snapshot(spark, sf_dir)).unionByName(session_stage(again))
    second = "extract_date = timestamp_ntz'2024-01-01 01:00:00'"
    return both.selectExpr(
        "*",
        "stg_hashdiff AS hashdiff",
        f"CASE WHEN {second} THEN acctstarttime END AS prev_acctstarttime",
        f"CASE WHEN {second} THEN adj_acctstoptime END AS prev_adj_acctstoptime",
        f"CASE WHEN {second} THEN acctinputoctets - 500 END AS prev_acctinputoctets",
        f"CASE WHEN {second} THEN acctoutputoctets - 250 END AS prev_acctoutputoctets",
        f"CASE WHEN {second} THEN 500L ELSE acctinputoctets END AS diff_acctinputoctets",
        f"CASE WHEN {second} THEN 250L ELSE acctoutputoctets END AS diff_acctoutputoctets",
    ).select(*SESSION_HISTORY.names)


def session_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-session log from orders; columns the orders have nothing for are empty."""
    rows = session_snapshot(spark, sf_dir).selectExpr(
        "*", "cast(acctuniqueid AS bigint) AS radacctid", "acctstarttime AS created_date", "1 AS flag"
    )
    return rows.selectExpr(
        *[c if c in rows.columns else f"cast(NULL AS string) AS {c}" for c in SESSION_LOG_COLUMNS]
    )


# --- telemetry from events ---------------------------------------------------------------


def process_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").selectExpr("*", f"{_CLOCK} AS clock")
    return ev.selectExpr(
        "concat('db', event_id % 5) AS server",
        f"{_steps(600)} AS snapshot_ts",
        "event_id AS id",
        "CASE WHEN event_id % 19 <> 0 THEN concat('u', cast(floor(sqrt(user_id)) AS bigint)) END AS user",
        "concat('10.0.0.', user_id % 7) AS host",
        "CASE WHEN event_id % 31 <> 0 THEN 'billing' END AS db",
        "CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'Binlog Dump'"
        " WHEN event_id % 13 = 0 THEN 'Daemon' WHEN event_type IN ('view', 'purchase') THEN 'Query'"
        " WHEN event_type = 'click' THEN 'Execute' WHEN event_type = 'signup' THEN 'Sleep'"
        " ELSE 'Killed' END AS command",
        "CASE WHEN event_id % 37 <> 0 THEN cast(floor(value * 10) AS bigint) END AS time",
        "CASE WHEN event_id % 11 = 0 THEN 'User sleep' WHEN event_id % 3 <> 0"
        " THEN 'executing query' END AS state",
        "event_id * 3 AS query_id",
        "cast(0 AS double) AS progress",
    )


def disk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly disk reports of four hosts, with header lines and cut lines among them."""
    ev = table(spark, sf_dir, "events").selectExpr(
        "*",
        f"{_CLOCK} AS clock",
        "(cast(floor(value) AS bigint) * 7 + event_id) % 101 AS pct",
        "CASE WHEN event_type IN ('view', 'purchase') THEN '/' WHEN event_type = 'click' THEN '/data'"
        " WHEN event_type = 'signup' THEN '/backup' ELSE '/home' END AS mount",
    )
    return ev.selectExpr(
        "concat('HOST', user_id % 4, ' - 10.0.0.', user_id % 4) AS host",
        f"{_steps(3600)} AS report_ts",
        "event_id AS line_no",
        "CASE WHEN event_id % 59 = 0 THEN 'Filesystem      Size  Used Avail Use% Mounted on'"
        " WHEN event_id % 61 = 0 THEN '/dev/sdz 100G 50G'"
        r" ELSE concat('/dev/sd', event_id % 4, '  100G   50G\t50G  ', pct, '% ', mount) END AS line",
    )


def disk_rules(spark: SparkSession) -> DataFrame:
    return small_table(spark, [dict(zip(DISK_RULES.names, rule)) for rule in RULES], DISK_RULES)
