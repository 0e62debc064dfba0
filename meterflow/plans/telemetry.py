"""Rules over process lists and disk reports. Alerts are output rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.expr import duration_text, not_in_keep_null
from meterflow.operators.rollup import joined_text

IDLE_COMMANDS = ["Sleep", "Daemon"]
IDLE_STATES = ["User sleep"]
NOT_A_QUERY = ["Sleep", "Daemon", "Binlog Dump", "Killed"]
MIN_COMMANDS = 50
MIN_SECONDS = 1800
STATE_WIDTH = 12
MAX_LINES = 1000
REPORT = ["server", "snapshot_ts"]


def proc_active(snapshots: DataFrame) -> DataFrame:
    """Processes that are at work. The source filter drops a missing command, the others keep it."""
    source = ~F.lower("command").like("binlog dump")
    return snapshots.where(
        source
        & not_in_keep_null(F.col("command"), IDLE_COMMANDS)
        & not_in_keep_null(F.col("state"), IDLE_STATES)
    )


def user_counts(active: DataFrame, by: list[str], min_commands: int = MIN_COMMANDS) -> DataFrame:
    """Users with many commands."""
    return (
        active.where(F.col("user").isNotNull())
        .groupBy(*by, "user")
        .agg(F.count("command").alias("commands"))
        .where(F.col("commands") >= min_commands)
    )


def long_running(active: DataFrame, by: list[str], min_seconds: int = MIN_SECONDS) -> DataFrame:
    """Queries that run for long, with their time. The state is cut after the grouping."""
    queries = active.where(
        (F.coalesce("time", F.lit(0)) > min_seconds)
        & not_in_keep_null(F.col("command"), NOT_A_QUERY)
        & not_in_keep_null(F.col("state"), IDLE_STATES)
    )
    texts = ["user", "host", "db", "command", "state", "query_id"]
    named = queries.withColumn("query_id", F.col("query_id").cast("string")).fillna("-", subset=texts)
    total = named.groupBy(*by, "id", *texts).agg(F.sum("time").alias("time"))
    return total.withColumn("state", F.substring("state", 1, STATE_WIDTH))


def captions(long: DataFrame) -> DataFrame:
    """One caption per long-running query."""
    text = F.concat_ws(
        "\n",
        F.col("id").cast("string"),
        *[
            F.concat(F.lit(f"{label}: "), F.col(column))
            for label, column in (
                ("Server", "server"), ("User", "user"), ("Host", "host"), ("DB", "db"),
                ("Command", "command"), ("State", "state"), ("Query ID", "query_id"),
            )
        ],
        F.concat(F.lit("Time: "), duration_text(F.col("time"))),
    )
    return long.withColumn("caption", text)


def caption_texts(long: DataFrame, by: list[str], max_lines: int = MAX_LINES) -> DataFrame:
    """The captions of each report as one text; very long reports come in parts."""
    order = ["id", "state", "caption"]
    return joined_text(captions(long), by, order, "caption", max_lines)


def proc_report(
    snapshots: DataFrame,
    min_commands: int = MIN_COMMANDS,
    min_seconds: int = MIN_SECONDS,
    by: list[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """User counts, long-running queries and their captions, per server and snapshot."""
    by = by or REPORT
    active = proc_active(snapshots)
    long = long_running(active, by, min_seconds)
    return user_counts(active, by, min_commands), long, caption_texts(long, by)


# --- disks -----------------------------------------------------------------------------


def disk_parse(lines: DataFrame) -> DataFrame:
    """Columns of disk report lines; headers and broken lines have no percentage and are left out."""
    # Splitting by a pattern is the costly step. The one-element explode keeps filters on
    # its results above it, so that it happens once per line.
    parts = F.explode(F.array(F.split(F.trim("line"), r"\s+"))).alias("_parts")
    cols = {
        name: F.get("_parts", F.lit(i))
        for i, name in enumerate(("device", "size", "used", "available", "use", "mount"))
    }
    pct = F.rtrim("use", F.lit("%")).try_cast("int").alias("used_pct")
    names = [c for c in lines.columns if c != "line"]
    parsed = lines.select("*", parts).withColumns(cols).withColumn("used_pct", pct)
    known = F.col("used_pct").isNotNull() & F.col("mount").isNotNull()
    return parsed.where(known).select(*names, "device", "size", "used", "available", "mount", "used_pct")


def disk_breaches(parsed: DataFrame, rules: DataFrame, hosts: DataFrame | None = None) -> DataFrame:
    """Watched mounts at or over their limit. Of several rules the longest host suffix counts.

    Rules are looked up for the distinct hosts only (``hosts`` has them where they can be read without parsing lines): each host is turned into all its suffixes, which
    meet the rules in an equi join, and for every mount the longest suffix stays.
    """
    hosts = (parsed if hosts is None else hosts).select("host").where("host IS NOT NULL").distinct()
    ends = F.explode(F.transform(F.sequence(F.lit(0), F.length("host")), lambda n: F.right("host", n)))
    named = hosts.select("host", ends.alias("host_suffix"))
    rule = F.struct(F.length("host_suffix").alias("width"), "min_pct")
    found = named.join(rules.select("mount", "host_suffix", "min_pct"), "host_suffix").groupBy("host", "mount").agg(
        F.max(rule)["min_pct"].alias("min_pct")
    )
    joined = parsed.join(found, ["host", "mount"])
    return joined.where(F.col("used_pct") >= F.col("min_pct")).select(*parsed.columns, "min_pct")


def disk_texts(breaches: DataFrame, by: list[str], order: list[str], max_lines: int = MAX_LINES) -> DataFrame:
    """One message per host report; very long reports come in parts."""
    line = F.format_string("Disk usage on %s is %d%% %s", "device", "used_pct", "mount")
    return joined_text(breaches.withColumn("_line", line), by, order, "_line", max_lines)


def disk_report(lines: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Breaches, and their text per host and report.

    Lines carry ``host``, ``report_ts``, ``line_no`` and ``line``.
    """
    breaches = disk_breaches(disk_parse(lines), rules, lines)
    return breaches, disk_texts(breaches, ["host", "report_ts"], ["line_no"])
