"""URL filter with lists that change over time, with DataFrame functions only.

A list is a log of dated entries: from a time on, a pattern is blocked, allowed, or no longer listed. Entries become
validity intervals, and an as-of join finds for every capture the entries that were active when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What an entry may say. Of entries of one list and pattern with one date the later one in this order counts.
ACTIONS = ["removed", "allowed", "blocked"]

HOST = "nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@|:[0-9]*$|[.]$', ''), '')"
SEGMENT = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1)"


def validity(entries: DataFrame) -> DataFrame:
    """list, pattern, action, valid_from, valid_to of entries (list, pattern, action, effective).

    An entry holds until the next one of its list and pattern; valid_to is missing for the last. Entries that say "removed" only end
    others. Entries without pattern, date or known action do not count; repeated ones count once.
    """
    place = F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col("action"))
    known = entries.select("list", "pattern", "action", "effective", place.alias("place")).where("pattern IS NOT NULL AND effective IS NOT NULL AND place > 0")
    last = known.groupBy("list", "pattern", "effective").agg(F.max("place").alias("place"))
    following = Window.partitionBy("list", "pattern").orderBy("effective")
    dated = last.select("*", F.lead("effective").over(following).alias("valid_to"))
    action = F.element_at(F.array(*[F.lit(a) for a in ACTIONS]), F.col("place").cast("int"))
    return dated.select("list", "pattern", action.alias("action"), F.col("effective").alias("valid_from"), "valid_to").where("action <> 'removed'")


def active_entries(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """The distinct captures (url, fetched_at) with the entries active for them: url, fetched_at, list, pattern, action.

    A pattern is a host (for it and all hosts below it) or a host with the first part of a path ("a.example.com/en"). Intervals are cut into months, so
    that both sides meet on (pattern, month) and no capture is held against a pattern's whole past.
    """
    wanted = captures.select("url", "fetched_at").where("url IS NOT NULL AND fetched_at IS NOT NULL").distinct()
    hosts = wanted.selectExpr("*", f"{HOST} AS host", f"{SEGMENT} AS segment").where("host IS NOT NULL").selectExpr("*", "split(host, '[.]') AS labels")
    keys = hosts.selectExpr(
        "url",
        "fetched_at",
        "date_trunc('MONTH', fetched_at) AS month",
        "explode(concat(transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.')),"
        " if(segment = '', array(), array(concat(host, '/', segment))))) AS pattern",
    )
    months = (
        validity(entries)
        .withColumn("low", captures.agg(F.date_trunc("MONTH", F.min("fetched_at"))).scalar())
        .withColumn("high", captures.agg(F.date_trunc("MONTH", F.max("fetched_at"))).scalar())
        .selectExpr("*", "greatest(low, date_trunc('MONTH', valid_from)) AS a", "least(high, date_trunc('MONTH', coalesce(valid_to, high))) AS b")
        .where("a <= b")
        .selectExpr("list", "pattern", "action", "valid_from", "valid_to", "explode(sequence(a, b, INTERVAL 1 MONTH)) AS month")
    )
    met = keys.join(months, ["pattern", "month"])
    return met.where("fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)").select("url", "fetched_at", "list", "pattern", "action")


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """All rows and columns of ``captures`` (url, fetched_at) with n_active, pattern, action and blocked.

    n_active counts the active entries. The longest active pattern decides; if lists disagree on it, "blocked" wins. Hosts are compared in small letters, without
    user, port and last dot; paths as they are. Without url, host or time nothing is active: n_active 0, pattern and action missing, not
    blocked. Repeated rows stay. Columns with the names of the new ones are replaced.
    """
    captures = captures.drop("n_active", "pattern", "action", "blocked")
    best = active_entries(captures, entries).groupBy("url", "fetched_at").agg(
        F.count("*").alias("n_active"), F.max(F.struct(F.length("pattern").alias("length"), "pattern", "action")).alias("best")
    )
    return captures.join(best, ["url", "fetched_at"], "left").select(
        *captures.columns,
        F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.action").alias("action"),
        F.coalesce(F.col("best.action") == "blocked", F.lit(False)).alias("blocked"),
    )


# The tables have neither dates of fetching nor lists. A page's number dates its capture. Lists come from the pages' own hosts: a digest of the host decides what
# is listed (the host, its last three labels, or its first path) and when.
FETCHED = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(page_id * 37 % 525600 AS int), 0)"


def dated_lists(pages: DataFrame) -> DataFrame:
    """list, pattern, action, effective: three entries for each distinct host and first path of the pages."""
    hosts = pages.selectExpr(f"{HOST} AS host", f"{SEGMENT} AS segment").where("host IS NOT NULL").distinct()
    coded = hosts.selectExpr("*", "cast(conv(substr(md5(concat(host, '/', segment)), 1, 7), 16, 10) AS bigint) AS code", "split(host, '[.]') AS labels")
    rows = coded.selectExpr(
        "CASE code % 3 WHEN 0 THEN host WHEN 1 THEN array_join(slice(labels, greatest(1, size(labels) - 2), size(labels)), '.')"
        " ELSE concat(host, '/', segment) END AS pattern",
        "code",
        "explode(sequence(0, 2)) AS k",
    )
    return rows.selectExpr(
        "concat('list', code div 3 % 2) AS list",
        "pattern",
        "CASE WHEN k = 0 AND code % 5 < 4 OR k = 2 AND code % 5 = 4 THEN 'blocked' WHEN k = 1 AND code % 7 < 3 THEN 'allowed' ELSE 'removed' END AS action",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(code div 10 % 120 + k * (code div 1000 % 90) AS int), 0, 0, 0) AS effective",
    )


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.selectExpr("page_id", "url", f"{FETCHED} AS fetched_at")
    return filter_captures(captures, dated_lists(pages)).select("page_id", "url", "fetched_at", "n_active", "pattern", "action", "blocked")


_SQL_HOST = "nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@|:[0-9]*$|[.]$', '', 'g'), '')"
_SQL_SEGMENT = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1)"

OP5_SQL = f"""
WITH p AS (
    SELECT page_id, url, {_SQL_HOST} AS host, {_SQL_SEGMENT} AS segment,
           TIMESTAMP '2024-01-01' + to_minutes(page_id * 37 % 525600) AS fetched_at
    FROM pages
), coded AS (
    SELECT host, segment, ('0x' || substr(md5(concat(host, '/', segment)), 1, 7))::BIGINT AS code, string_split(host, '.') AS labels
    FROM (SELECT DISTINCT host, segment FROM p WHERE host IS NOT NULL)
), entries AS (
    SELECT 'list' || (code // 3 % 2) AS list,
           CASE code % 3 WHEN 0 THEN host WHEN 1 THEN array_to_string(labels[greatest(1, len(labels) - 2):], '.')
                ELSE concat(host, '/', segment) END AS pattern,
           CASE WHEN k = 0 AND code % 5 < 4 OR k = 2 AND code % 5 = 4 THEN 2 WHEN k = 1 AND code % 7 < 3 THEN 1 ELSE 0 END AS weight,
           TIMESTAMP '2024-01-01' + to_days((code // 10 % 120 + k * (code // 1000 % 90))::INT) AS effective
    FROM coded, range(3) AS r(k)
), dated AS (
    SELECT list, pattern, effective, max(weight) AS weight,
           lead(effective) OVER (PARTITION BY list, pattern ORDER BY effective) AS valid_to
    FROM entries GROUP BY list, pattern, effective
), hits AS (
    SELECT c.page_id, c.url, d.pattern, d.weight,
           row_number() OVER (PARTITION BY c.page_id ORDER BY length(d.pattern) DESC, d.pattern DESC, d.weight DESC) AS place,
           count(*) OVER (PARTITION BY c.page_id) AS n_active
    FROM p AS c JOIN dated AS d
      ON d.weight > 0 AND (c.host = d.pattern OR ends_with(c.host, '.' || d.pattern) OR (c.segment <> '' AND c.host || '/' || c.segment = d.pattern))
     AND c.fetched_at >= d.effective AND (d.valid_to IS NULL OR c.fetched_at < d.valid_to)
)
SELECT p.page_id, p.url, p.fetched_at, coalesce(h.n_active, 0)::BIGINT AS n_active, h.pattern,
       CASE h.weight WHEN 2 THEN 'blocked' WHEN 1 THEN 'allowed' END AS action, coalesce(h.weight = 2, false) AS blocked
FROM p LEFT JOIN hits AS h ON h.page_id = p.page_id AND h.place = 1
"""
