"""Change capture over full snapshots of a session-accounting table.

A snapshot row is *unchanged* when its id, user and both octet counts are in the history
already, *new* when its (user, start, id) is not, *changed* when its content hash differs
from the latest version there. New and changed rows get octet deltas and join the history.

Copies are reduced on the map side before every join (``latest_by``, ``distinct``, ``max``),
so both sides of the history join have one row per key. The anti join on the session id
comes last and is left to adaptive skew handling, which splits its left side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.expr import (
    add_seconds,
    concat_skip_null,
    counter_delta,
    far_future,
    seconds_between,
)
from meterflow.operators.skew import KeyChunks, lag_by_key, latest_by, plan_chunks
from meterflow.schemas import SESSION_ANALYSIS_COLUMNS, SESSION_HISTORY

SESSION = ["username", "acctstarttime", "acctuniqueid"]
CONTENT = ["acctuniqueid", "username", "acctinputoctets", "acctoutputoctets"]
STAGE_COLUMNS = (
    "acctsessionid", "acctuniqueid", "adj_acctuniqueid", "username", "groupname", "realm",
    "acctstarttime", "acctupdatetime", "acctstoptime", "adj_acctstoptime", "is_time_adjusted",
    "acctinterval", "acctsessiontime", "adj_acctsessiontime", "is_sessiontime_adjusted",
    "acctinputoctets", "acctoutputoctets", "calledstationid", "acctstartdelay", "acctstopdelay",
    "extract_date", "stg_hashdiff",
)


def session_stage(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows with repaired stop and session times and a content hash."""
    start, stop = F.col("acctstarttime"), F.col("acctstoptime")
    length = F.col("acctsessiontime")
    backwards = start >= far_future(stop)
    fix_stop = backwards & (length > 0)
    fix_length = backwards & (length == 0)
    semi = F.lit(";")
    zero = F.lit(0)
    return snapshot.withColumns({
        "adj_acctuniqueid": concat_skip_null(F.col("acctuniqueid"), semi, F.col("username"), semi, start),
        "adj_acctstoptime": F.when(fix_stop, add_seconds(start, length)).otherwise(stop),
        "is_time_adjusted": F.when(fix_stop, 1).otherwise(0),
        "adj_acctsessiontime": F.when(fix_length, F.abs(seconds_between(stop, start))).otherwise(
            length.cast("double")
        ),
        "is_sessiontime_adjusted": F.when(fix_length, 1).otherwise(0),
        "stg_hashdiff": F.md5(
            concat_skip_null(
                far_future(start), semi,
                F.coalesce(length, zero), semi,
                F.coalesce("acctinputoctets", zero), semi,
                F.coalesce("acctoutputoctets", zero), semi,
                F.col("username"), semi,
                F.col("acctuniqueid"),
            )
        ),
    }).select(*STAGE_COLUMNS)


def _latest_version(history: DataFrame) -> DataFrame:
    order = [far_future(F.col("extract_date")).desc(), F.desc_nulls_last("hashdiff")]
    return latest_by(history, SESSION, *order)


def session_unchanged(stage: DataFrame, history: DataFrame, latest_only: bool = False) -> DataFrame:
    """Snapshot rows whose id, user and octets the history has; one per session.

    Any version in the history counts; with ``latest_only`` just the latest one.
    """
    seen = _latest_version(history) if latest_only else history
    seen = seen.groupBy(*CONTENT).agg(F.max(far_future(F.col("extract_date"))).alias("_seen"))
    matched = stage.join(seen, CONTENT)
    one = latest_by(
        matched, SESSION, F.desc("_seen"), F.desc_nulls_last("extract_date"),
        F.desc_nulls_last("acctinputoctets"), F.desc_nulls_last("acctoutputoctets"),
    )
    return one.select(*CONTENT, "extract_date")


def _unchanged_ids(stage: DataFrame, history: DataFrame, latest_only: bool) -> DataFrame:
    seen = _latest_version(history) if latest_only else history
    # both sides distinct on the same four columns: a small, even semi join
    unchanged = stage.select(*CONTENT).distinct().join(
        seen.select(*CONTENT).distinct(), CONTENT, "left_semi"
    )
    return unchanged.select("acctuniqueid").distinct()


def session_cleaned(stage: DataFrame, history: DataFrame, latest_only: bool = False) -> DataFrame:
    """The snapshot without the sessions that are unchanged. One unchanged row clears its id."""
    unchanged = _unchanged_ids(stage, history, latest_only)
    return stage.join(unchanged, "acctuniqueid", "left_anti").select(*stage.columns)


def session_track(stage: DataFrame, history: DataFrame, latest_only: bool = False) -> DataFrame:
    """One row per session that is not unchanged, marked new or changed, with its version before.

    Ids are part of the session key, so clearing unchanged ids may as well come last. Then
    copies are gone before any join, a filter on the marks takes out almost all rows before
    the anti join, and nothing above that join needs its partitioning, which leaves
    adaptive execution free to split a hot id.
    """
    one = latest_by(
        stage, SESSION, F.desc_nulls_last("extract_date"), F.desc_nulls_last("stg_hashdiff")
    )
    before = _latest_version(history).select(
        *SESSION,
        F.lit(1).alias("_known"),
        F.col("hashdiff").alias("h_hashdiff"),
        F.col("adj_acctstoptime").alias("h_adj_acctstoptime"),
        F.col("acctinputoctets").alias("h_acctinputoctets"),
        F.col("acctoutputoctets").alias("h_acctoutputoctets"),
    )
    known = F.col("_known").isNotNull()
    differs = known & (F.col("stg_hashdiff") != F.col("h_hashdiff"))
    marked = one.join(before, SESSION, "left").withColumns({
        "new_ind": F.when(known, 0).otherwise(1),
        "track_ind": F.when(differs, 1).otherwise(0),
    })
    unchanged = _unchanged_ids(stage, history, latest_only)
    return marked.join(unchanged, "acctuniqueid", "left_anti").drop("_known")


def plan_users(stage: DataFrame) -> KeyChunks:
    """Users with very many sessions, found on the snapshot, before any join."""
    return plan_chunks(stage, ["username"], ["acctstarttime", "extract_date", "acctuniqueid"])


def session_delta(track: DataFrame, plan: KeyChunks) -> DataFrame:
    """New and changed sessions as history rows, with the column ``new_ind``.

    A new session looks back at the user's session before it and has no octets before its own; a
    changed one looks at its own latest version. Both kinds share one pass.
    """
    rows = track.where((F.col("new_ind") == 1) | (F.col("track_ind") == 1))
    within = ("new_ind",)
    by_user = {"_start": "acctstarttime", "_stop": "adj_acctstoptime"}
    rows = lag_by_key(rows, plan, by_user, within)

    is_new = F.col("new_ind") == 1
    previous = {
        "prev_acctstarttime": F.when(is_new, F.col("_start")).otherwise(F.col("acctstarttime")),
        "prev_adj_acctstoptime": F.when(is_new, F.col("_stop")).otherwise(F.col("h_adj_acctstoptime")),
        "prev_acctinputoctets": F.when(~is_new, F.col("h_acctinputoctets")),
        "prev_acctoutputoctets": F.when(~is_new, F.col("h_acctoutputoctets")),
        "hashdiff": F.col("stg_hashdiff"),
    }
    delta = {
        f"diff_{c}": counter_delta(F.col(c), F.col(f"prev_{c}"))
        for c in ("acctinputoctets", "acctoutputoctets")
    }
    return rows.withColumns(previous).withColumns(delta).select(*SESSION_HISTORY.names, "new_ind")


def changes_delta(
    stage: DataFrame, history: DataFrame, latest_only: bool = False, plan: KeyChunks | None = None
) -> DataFrame:
    """All new and changed sessions of a snapshot, ready to append to the history."""
    track = session_track(stage, history, latest_only)
    return session_delta(track, plan or plan_users(stage))


def session_changes(
    stage: DataFrame, history: DataFrame, latest_only: bool = False, plan: KeyChunks | None = None
) -> tuple[DataFrame, DataFrame]:
    """New sessions and changed sessions."""
    delta = changes_delta(stage, history, latest_only, plan)
    new = delta.where(F.col("new_ind") == 1).drop("new_ind")
    changed = delta.where(F.col("new_ind") == 0).drop("new_ind")
    return new, changed


def append_history(history: DataFrame, *parts: DataFrame) -> DataFrame:
    """History with further rows, matched by column name."""
    for part in parts:
        history = history.unionByName(part.select(*SESSION_HISTORY.names))
    return history


def analysis_view(*parts: DataFrame) -> DataFrame:
    """The columns that analysis gets, of all changes."""
    out = parts[0].select(*SESSION_ANALYSIS_COLUMNS)
    for part in parts[1:]:
        out = out.unionByName(part.select(*SESSION_ANALYSIS_COLUMNS))
    return out


def snapshot_series_delta(
    snapshots: DataFrame,
    keys: list[str],
    order_cols: list[str],
    counters: list[str],
    plan: KeyChunks | None = None,
) -> DataFrame:
    """Counter growth from snapshot to snapshot of each key."""
    plan = plan or plan_chunks(snapshots, keys, order_cols)
    rows = lag_by_key(snapshots, plan, {f"prev_{c}": c for c in counters})
    rows = rows.withColumns(
        {f"diff_{c}": counter_delta(F.col(c), F.col(f"prev_{c}")) for c in counters}
    )
    new = [f"{kind}_{c}" for kind in ("prev", "diff") for c in counters]
    return rows.select(*snapshots.columns, *new)
